"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

``build_index`` reads every text once and writes postings per shard: consecutive
documents of a task, up to ``SHARD_TERMS`` terms together. A row holds one term's list in
one shard, cut into blocks of ``BLOCK`` postings: gaps and counts packed in one, two or
four bytes, and beside them, readable without unpacking, where each block begins and its
*front* (the (count, text length) pairs that no other posting of the block beats both
ways), from which the block's greatest score follows for any corpus totals. One more row
a shard, of the empty term, holds its documents' ids and lengths. So shards need no
totals when they are made, and new ones can be added beside them.

A query is a bag of terms. In a shard its lists are taken by falling upper bounds.
Lists are *essential*, and read whole, until the bounds of those left no longer sum to
the score of the k-th best document known (of this shard or of shards that the task
searched before): no document without an essential term can get into the result.
The others are only looked up for the documents found: a document goes as soon as its
score, its block's greatest score and the bounds of the lists after it can't reach the
k-th best, and a block is unpacked only if a document of it is still there. What
is left is scored in full; the k best of each shard are merged by a windowed rank.

A document's score is the sum over the query's terms, repeats included, of
``w * ((10^9 tf) div (1000 tf + 12 m))`` in 64-bit integers, with
``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and ``m = 75 + (25 n N) div L``.

Defined results: a null or empty text has no terms and isn't counted; rows that repeat a
doc_id are documents of their own, each item row has its own ranking, also where item ids
repeat or are null; equal scores by ascending doc_id, null ids last (rows with equal ids
and scores are interchangeable); items without terms, or whose terms are in no document,
have no rows; extra columns are ignored; empty tables give an empty result. Queries are
taken in blocks of bounded size, each against all shards.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import scan, utf8
from stratum.session import scratch

#: Terms of one shard (it ends after the text that reaches this), documents of one shard,
#: and postings of one block.
SHARD_TERMS, SHARD_DOCS, BLOCK = 1 << 21, 1 << 16, 64
#: Bytes of item texts that are searched together.
QUERY_BYTES = 1 << 22
#: A-Z to lower case; ASCII other than letters and digits to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
DOCS = b""  # the "term" of the row with a shard's documents
INDEX = "shard string, term binary, df long, n_terms long, heads binary, fronts binary, packed binary"
HEAD = np.dtype([("first", "<u4"), ("gap_at", "<u4"), ("tf_at", "<u4"), ("front_at", "<u4"), ("n", "u1"), ("gap_w", "u1"), ("tf_w", "u1")])
FRONT = np.dtype([("tf", "<u4"), ("n", "<u4")])
RESULT = "item_id long, rank int, doc_id long, score long"
NO_ID = np.iinfo(np.int64).max  # stands for a null id


def terms_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(FOLD).split()


# ---- index -----------------------------------------------------------------

def packed_ints(values: np.ndarray, block: np.ndarray, widths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``values`` in the width of their block, and each block's place."""
    counts = np.bincount(block, minlength=len(widths))
    at = np.concatenate([[0], np.cumsum(counts * widths)])
    out = np.zeros(int(at[-1]), np.uint8)
    inside = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
    where = at[block] + inside * widths[block]
    for byte in range(4):
        has = widths[block] > byte
        out[where[has] + byte] = (values[has] >> (8 * byte)) & 255
    return out.tobytes(), at[:-1]


def width_of(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4)).astype(np.int64)


def shard_rows(name: str, ids: list, counts: list[int], terms: dict[bytes, int], found: list[np.ndarray]) -> Iterator[tuple]:
    """The index rows of one shard, from the term numbers of each text."""
    docs = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    keys, tf = np.unique((np.concatenate(found) << 16) | docs, return_counts=True)
    term, doc = keys >> 16, keys & 0xFFFF
    lengths = np.array(counts, np.int64)
    stored = np.array([NO_ID if i is None else i for i in ids], np.int64)
    yield name, DOCS, len(ids), int(lengths.sum()), None, None, stored.tobytes() + lengths.astype("<u4").tobytes()
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    df = np.diff(np.append(first, len(term)))
    # blocks: BLOCK postings of a list each
    place = np.arange(len(term)) - np.repeat(first, df)
    starts = np.flatnonzero(place % BLOCK == 0)
    sizes = np.diff(np.append(starts, len(term)))
    block = np.repeat(np.arange(len(starts)), sizes)
    gaps = doc - doc[starts][block]
    gap_w, tf_w = width_of(np.maximum.reduceat(gaps, starts)), width_of(np.maximum.reduceat(tf, starts))
    gap_bytes, gap_at = packed_ints(gaps, block, gap_w)
    tf_bytes, tf_at = packed_ints(tf, block, tf_w)
    # fronts: by length, those whose count exceeds all counts of shorter texts
    n = lengths[doc]
    order = np.lexsort((-tf, n, block))
    lifted = tf[order] + block[order] * (1 << 32)  # running maxima start anew in each block
    beats = np.concatenate([[True], lifted[1:] > np.maximum.accumulate(lifted)[:-1]])
    chosen = order[beats]
    fronts = np.zeros(len(chosen), FRONT)
    fronts["tf"], fronts["n"] = tf[chosen], n[chosen]
    # of each list: its first block, and where its bytes begin and end
    own = np.flatnonzero(place[starts] == 0)
    ends = np.append(own[1:], len(starts))
    gap_at, tf_at = np.append(gap_at, len(gap_bytes)), np.append(tf_at, len(tf_bytes))
    front_at = np.append(np.searchsorted(block[chosen], np.arange(len(starts))), len(chosen))
    list_of = np.repeat(np.arange(len(own)), ends - own)
    heads = np.zeros(len(starts), HEAD)
    heads["first"], heads["n"], heads["gap_w"], heads["tf_w"] = doc[starts], sizes, gap_w, tf_w
    heads["gap_at"] = gap_at[:-1] - gap_at[own][list_of]
    heads["tf_at"] = tf_at[:-1] - tf_at[own][list_of] + (gap_at[ends] - gap_at[own])[list_of]
    heads["front_at"] = front_at[:-1] - front_at[own][list_of]
    head_bytes, front_bytes, names = heads.tobytes(), fronts.tobytes(), list(terms)
    places = zip(
        term[first].tolist(), df.tolist(), np.add.reduceat(tf, first).tolist(), own.tolist(), ends.tolist(),
        *(at[edge].tolist() for at in (front_at, gap_at, tf_at) for edge in (own, ends)),
    )
    for t, size, times, a, b, f0, f1, g0, g1, t0, t1 in places:
        yield (
            name, names[t], size, times, head_bytes[a * HEAD.itemsize : b * HEAD.itemsize],
            front_bytes[f0 * FRONT.itemsize : f1 * FRONT.itemsize], gap_bytes[g0:g1] + tf_bytes[t0:t1],
        )


def build_index(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_terms: int = SHARD_TERMS,
) -> DataFrame:
    """The written index of all texts, at ``path`` or in the shared scratch folder."""
    build = uuid.uuid4().hex[:12]  # shards of later builds can lie beside these
    schema = pa.schema([
        ("shard", pa.string()), ("term", pa.binary()), ("df", pa.int64()), ("n_terms", pa.int64()),
        ("heads", pa.binary()), ("fronts", pa.binary()), ("packed", pa.binary()),
    ])

    def step(batches):
        from pyspark import TaskContext

        part = f"{build}-{TaskContext.get().partitionId()}"
        made = 0
        ids, counts, found, size = [], [], [], 0
        terms: dict[bytes, int] = {}

        def flush():
            rows = shard_rows(f"{part}-{made}", ids, counts, terms, found)
            while some := [r for _, r in zip(range(20_000), rows)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), schema.types)], schema=schema)

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = terms_of(text)
                if not words:
                    continue
                ids.append(doc)
                counts.append(len(words))
                found.append(np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int64, len(words)))
                size += len(words)
                if size >= shard_terms or len(ids) >= SHARD_DOCS:
                    yield from flush()
                    made += 1
                    ids, counts, found, size, terms = [], [], [], 0, {}
        if ids:
            yield from flush()

    spark = docs.sparkSession
    path = path or scratch(spark, "lexical-index")
    scan(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")), ["id", "text"], step, INDEX).write.mode("append").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


# ---- search ----------------------------------------------------------------

def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Postings:
    """One list of a shard: block bounds at hand, postings unpacked by need."""

    def __init__(self, heads: bytes, fronts: bytes, packed: bytes, norm):
        h = np.frombuffer(heads, HEAD)
        f = np.frombuffer(fronts, FRONT)
        self.first, self.n = h["first"].astype(np.int64), h["n"].astype(np.int64)
        self.at = {"gap": h["gap_at"].astype(np.int64), "tf": h["tf_at"].astype(np.int64)}
        self.width = {"gap": h["gap_w"], "tf": h["tf_w"]}
        self.packed = np.frombuffer(packed, np.uint8)
        tops = impact(f["tf"].astype(np.int64), norm(f["n"].astype(np.int64)))
        self.tops = np.maximum.reduceat(tops, h["front_at"].astype(np.int64))
        self.top = int(self.tops.max())

    def ints(self, kind: str, blocks: np.ndarray) -> np.ndarray:
        counts = self.n[blocks]
        total = int(counts.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        width = np.repeat(self.width[kind][blocks], counts).astype(np.int64)
        where = np.repeat(self.at[kind][blocks], counts) + inside * width
        out = self.packed[where].astype(np.int64)
        for byte in range(1, int(width.max(initial=1))):
            has = width > byte
            out[has] |= self.packed[where[has] + byte].astype(np.int64) << (8 * byte)
        return out

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents (ascending, for ascending blocks) and counts."""
        return np.repeat(self.first[blocks], self.n[blocks]) + self.ints("gap", blocks), self.ints("tf", blocks)


class Shard:
    """The lists that the queries of a block need, of one shard."""

    def __init__(self, rows: pa.Table, n_docs: int, n_terms: int):
        norm = lambda n: 75 + (25 * n * n_docs) // n_terms
        self.lists: dict[bytes, Postings] = {}
        for term, heads, fronts, packed in zip(*(rows.column(c).to_pylist() for c in ("term", "heads", "fronts", "packed"))):
            if term == DOCS:
                size = len(packed) // 12
                self.ids = np.frombuffer(packed, np.int64, size)
                self.m = norm(np.frombuffer(packed, "<u4", size, 8 * size).astype(np.int64))
            else:
                self.lists[term] = Postings(heads, fronts, packed, norm)

    def search(self, query: list[tuple[bytes, int]], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (local numbers) and scores that are at least ``bar`` and among the k best here.

        ``query``: terms and their factors (weight times repeats).
        """
        lists = [(p, w) for t, w in query if w > 0 and (p := self.lists.get(t))]
        lists.sort(key=lambda x: -x[1] * x[0].top)
        rest = np.append(np.cumsum([w * p.top for p, w in reversed(lists)])[::-1], 0).tolist()
        score = np.zeros(len(self.ids), np.int64)
        bar = max(bar, 1)
        i = 0
        while i < len(lists) and rest[i] >= bar:  # essential: read whole
            p, w = lists[i]
            docs, tf = p.read(np.arange(len(p.n)))
            score[docs] += w * impact(tf, self.m[docs])
            i += 1
            if np.count_nonzero(score > max(rest[i], bar)) >= k:
                bar = max(bar, kth(score[score > rest[i]], k))
        found = np.flatnonzero(score >= max(bar - rest[i], 1))
        for j in range(i, len(lists)):  # the others: looked up for what is left
            if not len(found):
                break
            p, w = lists[j]
            block = np.searchsorted(p.first, found, side="right") - 1
            most = np.where(block >= 0, w * p.tops[block], 0)
            live = score[found] + most + rest[j + 1] >= bar
            found, block = found[live], block[live]
            # unpacked only where a document's whole score still matters
            blocks = np.unique(block[block >= 0])
            if len(blocks):
                docs, tf = p.read(blocks)
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                hit = docs[at] == found
                score[found[hit]] += w * impact(tf[at[hit]], self.m[found[hit]])
            if len(found) >= k:
                bar = max(bar, kth(score[found], k))
            found = found[score[found] + rest[j + 1] >= bar]
        found = found[score[found] >= bar]
        best = found[np.lexsort((self.ids[found], -score[found]))[:k]]
        return best, score[best]


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k])


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, Counter]]]:
    """The items' bags of terms, ``QUERY_BYTES`` of text together, a partition at a time."""
    block: list = []
    size = 0
    for item, text in items.select(id_col, text_col).toLocalIterator():
        block.append((item, Counter(terms_of(text))))
        size += len(text or "") + 1
        if size >= QUERY_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search_block(index: DataFrame, block: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``number, item_id, doc_id, score``: the best of each task's shards, for the items of a block."""
    spark = index.sparkSession
    words = pa.table({"term": pa.array(sorted({t for _, bag in block for t in bag}), pa.binary())})
    wanted = F.broadcast(spark.createDataFrame(words))  # the terms of QUERY_BYTES of text
    lists = index.join(wanted, "term", "left_semi")
    df = {bytes(r.term): r.df for r in lists.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator()}
    weights = {t: weight(n, n_docs) for t, n in df.items()}
    bags = [(item, [(t, n * weights[t]) for t, n in bag.items() if t in weights]) for item, bag in block]
    given = spark.sparkContext.broadcast(bags)
    bars: dict[int, list[int]] = {}  # per query, the k best scores of this task's shards so far

    def search(rows: pa.Table) -> pa.Table:
        shard = Shard(rows, n_docs, n_terms)
        out: list[tuple[int, int | None, int, int]] = []
        for number, (item, query) in enumerate(given.value):
            best = bars.get(number, [])
            docs, scores = shard.search(query, k, best[-1] if len(best) == k else 1)
            if len(docs):
                bars[number] = sorted([*best, *scores.tolist()], reverse=True)[:k]
                out += zip([number] * len(docs), [item] * len(docs), shard.ids[docs].tolist(), scores.tolist())
        columns = list(zip(*out)) or [[]] * 4
        names = ("number", "item_id", "doc_id", "score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    shards = lists.unionByName(index.where(F.col("term") == F.lit(DOCS)))
    return shards.groupBy("shard").applyInArrow(search, "number long, item_id long, doc_id long, score long")


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    index: DataFrame | None = None,
    shard_terms: int = SHARD_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    index = build_index(docs, None, id_col, text_col, shard_terms) if index is None else index
    totals = index.where(F.col("term") == F.lit(DOCS)).agg(F.sum("df"), F.sum("n_terms")).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 0
    order = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
    results = scratch(spark, "lexical-results")
    spark.createDataFrame([], RESULT).write.parquet(results)
    for block in query_blocks(items, item_col, item_text_col) if n_docs else ():
        part = search_block(index, block, n_docs, n_terms, k).withColumn("rank", F.row_number().over(order))
        part.where(F.col("rank") <= k).select(
            "item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score"
        ).write.mode("append").parquet(results)
    return spark.read.schema(RESULT).parquet(results)
