"""Benchmark decontamination by spaced seeds.

A mask is a fixed pattern of positions that count (1) and positions that are
ignored (0). The words of every benchmark item and of every document are hashed
under each mask; a document window whose hash equals an item's is a hit, even
where words at ignored positions were replaced. Each hit fixes an alignment
(document position minus item position). Alignments with too few equal words in all
are left out; along the others the words are compared one by one, and the longest
stretch in which at most ``tolerance`` of the words differ is the overlap. Overlaps of ``min_words`` (or of the whole item, if shorter) are
reported, the longest for each document and item.

The masks lose nothing: no way to replace 30 % of the words of a stretch that begins
and ends with an equal word escapes all of them (``least_escape``, asserted in a
test for stretches of up to 400 words). A larger ``tolerance`` has no such guarantee.

The benchmark is the query set: it is read in blocks of bounded size, each block
goes to the tasks as sorted hash arrays, and every document is compared with
every block. Documents are never shuffled.

Defined results: null or empty texts on either side have no overlap; items of
fewer than ``MIN_ITEM`` words are never matched; extra columns are ignored; null
ids are carried as null; of overlaps of equal length the first in the document,
then in the item, is reported; repeated rows are reported once each; an empty
table on either side gives an empty result. Whole texts are searched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import WordHashes, by_ids, mix, scan, utf8, where_text

#: Masks of weight 4 that together hit every stretch of ``LONG`` words or more with 30 % replaced.
MASKS = ("11101", "1101001", "111001")
#: Masks of weight 3 that do so for shorter stretches, from ``MIN_ITEM`` words on.
SHORT_MASKS = ("111", "1101", "1011")
LONG, MIN_ITEM = 13, 4
#: Hits that are expanded at once.
HITS = 2_000_000
#: Characters of benchmark text in a block: bounds what is broadcast at once.
BLOCK_CHARS = 8_000_000
#: Bits of the table that turns most windows away before the exact lookup.
FILTER_BITS = 24
OUT = "doc_id long, item_id long, n_span long, n_matched long, doc_start long, item_start long"
SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in OUT.split(", ")])


#: ASCII punctuation and controls to spaces: quotes and marks added to a passage don't hide it.
PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return utf8(text and text.lower()).translate(PLAIN).split()


@dataclass
class Seeds:
    """One block of items: word hashes by item, and the sorted seeds of each mask."""

    ids: list[int | None]
    words: list[np.ndarray]
    flat: np.ndarray  # all words
    begin: np.ndarray  # where each item begins among them
    tables: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def window_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window under the mask (empty if the text is shorter)."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, counts in enumerate(mask):
        if counts == "1":
            total += h[k : k + n] * np.uint64(2 * (k * 0x9E3779B97F4A7C15 % 2**62) + 1)
    return mix(total)


def masks_for(n_words: int, min_words: int = LONG) -> tuple[str, ...]:
    """The masks that hit every overlap that counts for an item of so many words."""
    return tuple(m for m in (MASKS if min(n_words, min_words) >= LONG else SHORT_MASKS) if len(m) <= n_words)


def least_escape(masks: tuple[str, ...], n_words: int) -> int:
    """The least number of replaced words with which a stretch of so many words, the
    first and last one equal, escapes all masks (over 10**6 if none does)."""
    states = np.arange(1 << max(map(len, masks)))  # equality of the last words
    cost = np.full(len(states), 10**7)
    cost[1] = 0
    for n in range(2, n_words + 1):
        longer = np.full(len(states), 10**7)
        for same in (0, 1):
            np.minimum.at(longer, (states << 1 | same) % len(states), cost + (1 - same))
        for m in masks:
            if len(m) <= n:
                longer[states & int(m, 2) == int(m, 2)] = 10**7
        cost = longer
    return int(cost[states & 1 == 1].min())


def seeds_of(rows: list[tuple[int | None, str | None]], min_words: int = LONG) -> Seeds:
    hashes = WordHashes()
    ids, words, by_mask = [], [], {}
    for item, text in rows:
        h = hashes.of(words_of(text))
        if len(h) < MIN_ITEM:
            continue
        for mask in masks_for(len(h), min_words):
            s = window_hashes(h, mask)
            by_mask.setdefault(mask, []).append((s, np.full(len(s), len(ids)), np.arange(len(s))))
        ids.append(item)
        words.append(h)
    tables = []
    for mask, parts in by_mask.items():
        seed, which, at = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(seed, kind="stable")
        bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
        slots = seed >> np.uint64(64 - FILTER_BITS)
        np.bitwise_or.at(bits, slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8))
        tables.append((mask, seed[order], which[order], at[order], bits))
    begin = np.cumsum([0, *map(len, words)])[:-1].astype(np.int64)
    return Seeds(ids, words, np.concatenate(words) if words else np.empty(0, np.uint64), begin, tables)


def spread(times: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each number of ``times``, one after the other."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def promising(found: np.ndarray, h: np.ndarray, starts: np.ndarray, seeds: Seeds, min_words: int, tolerance: tuple[int, int]) -> np.ndarray:
    """The alignments with as many equal words as the shortest overlap that counts has."""
    doc, item, diagonal = found.T
    sizes = np.diff(np.append(seeds.begin, len(seeds.flat)))[item]
    need = np.minimum(min_words, sizes)
    a = np.maximum(0, diagonal)
    long = np.minimum(np.diff(starts)[doc], diagonal + sizes) - a
    need_same = need - need * tolerance[0] // tolerance[1]
    keep = np.zeros(len(found), bool)
    fits = np.flatnonzero(long >= np.maximum(need, 1))
    cuts = np.flatnonzero(np.diff(np.cumsum(long[fits]) // HITS)) + 1
    for part in np.split(fits, cuts):
        if len(part):
            times = long[part]
            at = np.repeat(starts[doc[part]] + a[part], times) + spread(times)
            its = np.repeat(seeds.begin[item[part]] + a[part] - diagonal[part], times) + spread(times)
            same = np.add.reduceat((h[at] == seeds.flat[its]).astype(np.int64), np.cumsum(times) - times)
            keep[part] = same >= need_same[part]
    return found[keep]


def alignments(h: np.ndarray, starts: np.ndarray, seeds: Seeds, min_words: int, tolerance: tuple[int, int]) -> np.ndarray:
    """Distinct (document, item, diagonal) rows of all promising hits in concatenated
    texts; ``starts`` ends with the number of words."""
    found = [np.empty((0, 3), np.int64)]
    for mask, seed, which, at, bits in seeds.tables:
        w = window_hashes(h, mask)
        slots = w >> np.uint64(64 - FILTER_BITS)
        near = np.flatnonzero(bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1)
        lo, hi = np.searchsorted(seed, w[near]), np.searchsorted(seed, w[near], "right")
        doc = np.searchsorted(starts[:-1], near, "right") - 1
        within = (hi > lo) & (doc == np.searchsorted(starts[:-1], near + len(mask) - 1, "right") - 1)
        near, lo, hi, doc = near[within], lo[within], hi[within], doc[within]
        cuts = np.flatnonzero(np.diff(np.cumsum(hi - lo) // HITS)) + 1
        for part in np.split(np.arange(len(near)), cuts):
            times = (hi - lo)[part]
            k = np.repeat(lo[part], times) + spread(times)
            pos = np.repeat((near - starts[doc])[part], times)
            hits = np.unique(np.stack([np.repeat(doc[part], times), which[k], pos - at[k]], 1), axis=0)
            found.append(promising(hits, h, starts, seeds, min_words, tolerance))
    return np.unique(np.concatenate(found), axis=0)


def longest_overlap(same: np.ndarray, tolerance: tuple[int, int]) -> tuple[int, int]:
    """Start and end of the longest stretch that begins and ends with an equal word
    and in which at most ``tolerance`` (a fraction) of the words differ; the first
    of equals."""
    part, whole = tolerance
    # prefix sums that don't fall from start to end exactly where the fraction holds
    sums = [0, *np.cumsum(np.where(same, part, part - whole)).tolist()]
    starts: list[int] = []  # falling sums: no other start can be better than these
    for k in np.flatnonzero(same).tolist():
        if not starts or sums[k] < sums[starts[-1]]:
            starts.append(k)
    best = (0, 0)
    for end in np.flatnonzero(same)[::-1].tolist():
        while starts and sums[starts[-1]] <= sums[end + 1]:
            start = starts.pop()
            if end + 1 - start >= best[1] - best[0]:
                best = (start, end + 1)
    return best


def overlaps(docs: list[tuple[int | None, str | None]], hashes: WordHashes, seeds: Seeds, min_words: int, tolerance: tuple[int, int]):
    """Rows of ``OUT`` for a few texts."""
    words = [words_of(text) for _, text in docs]
    h = hashes.of([w for ws in words for w in ws])
    starts = np.cumsum([0, *map(len, words)]).astype(np.int64)
    best: dict[tuple[int, int], tuple] = {}
    for doc, item, diagonal in alignments(h, starts, seeds, min_words, tolerance).tolist():
        mine, its = h[starts[doc] : starts[doc + 1]], seeds.words[item]
        a = max(0, diagonal)
        b = min(len(mine), diagonal + len(its))
        same = mine[a:b] == its[a - diagonal : b - diagonal]
        start, end = longest_overlap(same, tolerance)
        if end - start < min(min_words, len(its)):
            continue
        row = (end - start, -(a + start), -(a + start - diagonal), int(same[start:end].sum()))
        if row > best.get((doc, item), (0,)):
            best[doc, item] = row
    return [(docs[d][0], seeds.ids[i], n, m, -p, -q) for (d, i), (n, p, q, m) in best.items()]


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int, min_words: int):
    """Broadcast seeds of each block of the benchmark that has any."""
    spark = benchmark.sparkSession
    items = benchmark.select(benchmark[id_col].cast("long").alias("item"), benchmark[text_col].alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        seeds = spark.sparkContext.broadcast(seeds_of([tuple(r) for r in rows], min_words))
        if seeds.value.tables:
            yield seeds


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    min_words: int = 13,
    tolerance: tuple[int, int] = (3, 10),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item that overlap: the longest overlap's length,
    equal words and starts (in words)."""
    result = docs.sparkSession.createDataFrame([], OUT)
    for n, seeds in enumerate(blocks_of(benchmark, item_id_col, item_text_col, block_chars, min_words)):

        def step(batches, seeds=seeds):
            hashes = WordHashes()
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    pairs = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
                    found = overlaps(pairs, hashes, seeds.value, min_words, tolerance)
                    columns = list(zip(*found)) or [[]] * len(SCHEMA)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=SCHEMA)

        part = scan(docs, [id_col, text_col], step, OUT)
        result = result.unionByName(part) if n else part
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without an overlap, with all their columns (null ids stay)."""
    hit = find_overlaps(docs, benchmark, id_col=id_col, **options).select("doc_id")
    return by_ids(docs, hit, id_col, "left_anti")


def clean_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    min_words: int = 13,
    tolerance: tuple[int, int] = (3, 10),
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows whose own text has no overlap, whatever their ids, with all their columns."""
    for seeds in blocks_of(benchmark, item_id_col, item_text_col, block_chars, min_words):

        def judge(texts, seeds=seeds):
            found = overlaps(list(enumerate(texts)), WordHashes(), seeds.value, min_words, tolerance)
            hit = {row[0] for row in found}
            return [k not in hit for k in range(len(texts))]

        docs = where_text(docs, text_col, judge)
    return docs
