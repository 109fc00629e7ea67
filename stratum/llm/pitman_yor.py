"""Scoring texts under a hierarchical Pitman-Yor model.

A text is its words and one end token; the token before the first is an end token
too. Every token has a restaurant of its own for the tokens that follow it (discount
``PAIR_D``, strength ``PAIR_THETA``). All of these share one parent, the word
restaurant (``WORD_D``, ``WORD_THETA``): each table of a token's restaurant is a customer
there. A new table of the word restaurant draws its word from the spelling model: the
word's UTF-8 bytes and a stop, each byte served by the restaurant of the two bytes
before it. Those letter restaurants share their parents in turn: two bytes of context,
one byte, none, then uniform over bytes.

The seating is sampled by Gibbs. In a sweep each dish's number of tables is drawn
from its conditional given all the rest: for c customers and base weight
a = (theta + d * T) * P_parent(dish), p(t) is proportional to a^t * S_d(c, t) with
generalised Stirling numbers S_d. They are a table up to ``EXACT`` customers, beyond it
the closed form that they have for d = 1/2, so the draw is from the conditional at
every count. Restaurants within a level are sampled side by side from the totals
T of the sweep before. After ``BURN`` sweeps the predictive probabilities of
``KEPT`` sweeps are averaged, and perplexity follows from the averages.

How it runs: one pass over the texts deals every token, with the one before it and its
text, to a grid of cells by context and word, and every word to groups of neighbouring
hashes; Spark shuffles them packed, a few bytes a token, and the merged cells and groups
are written once, a cell's texts in pieces, so that batches and row groups stay at a few
megabytes (the texts of one pair stay together, and a cell's hashes and seats), and workers
hand back what they have freed. A sweep is two exchanges: cells tell the groups how many
tables their pairs have by word and by context, groups answer with what the next draw needs.
A pair that occurs once has one table whatever the rest, so sweeps only carry the pairs that
occur more often; the others are counted by word and by context once. In the end every cell scores
its own pairs, adds them up by text, and the sums of a text meet. What comes to the driver
per sweep is the histogram of letter trigrams, at most 2^24 entries whatever the corpus, and the letter
restaurants (a bounded table too) are seated there. Randomness is a hash of word or pair and
sweep, so a repeated task draws alike. Pairs name their words by 64-bit hashes.

A word that training never saw is scored as the one event "a new word", as the
smoothed unigram beside it does; ``open_score`` has its spelling's probability
instead. A context that training never saw leaves the word restaurant's probability.

Defined results: null or empty text has only its end token; extra columns are
ignored; null ids count as training rows and are scored together; rows that
repeat an id are scored as one longer text with one end token each (no pair reaches from
one row into another); an empty table gives an empty result. Without training tokens every
word is new for certain (score 0), and ``open_score`` is the untrained spelling model's.
Whole texts are read.
"""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import WordHashes, mix, release_shuffles, scan, words_of
from stratum.session import scratch

PAIR_D, PAIR_THETA = 0.5, 5.0
WORD_D, WORD_THETA = 0.5, 20.0
LETTER_D, LETTER_THETA = (0.5, 0.5, 0.5), (1.0, 1.0, 1.0)
EXACT = 256
BURN, KEPT = 2, 2
#: The end token's key: no word is empty.
END = ""
STOP = 0x20  # closes a spelled word: no word holds a space
#: Tokens that a task gathers before it hands words or pairs on.
CHUNK = 1_800_000
#: Tokens of a text that stay in one chunk.
PIECE = 500_000
#: Pairs and tokens of a cell that are stored and scored at a time.
SLICE = 300_000
#: Bytes of an Arrow batch or a Parquet row group, about: larger ones grow by copies on
#: either side of a Python worker's pipe.
BATCH_BYTES = 4 << 20
#: Bytes of text to a cell, on average.
CELL_BYTES = 16_000_000


# -- counts ------------------------------------------------------------------


def vocabulary(docs: DataFrame, text_col: str, held_col: str) -> DataFrame:
    """``word, c``: every distinct token of the corpus and its training count."""

    def flush(train: Counter):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(train), pa.string()), pa.array(list(train.values()), pa.int64())], names=["word", "c"]
        )

    def step(batches):
        train: Counter = Counter()
        for batch in batches:
            for text, held in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                words.append(b"")
                train.update(dict.fromkeys(words, 0) if held else words)
                if len(train) > CHUNK // 4:
                    yield flush(train)
                    train.clear()
        if train:
            yield flush(train)

    return scan(docs, [text_col, held_col], step, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def neighbours(batches):
    """Per batch of (first column, text): the row, the context and the word of each token."""
    hashes = WordHashes()
    end = np.uint64(hashes[b""])
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            tokens = [words_of(text) for text in part.column(1).to_pylist()]
            words = hashes.of([w for t in tokens for w in (*t, b"")])
            lengths = np.array([len(t) + 1 for t in tokens])
            context = np.concatenate([[end], words[:-1]])  # a text follows on the end before it
            yield part, np.repeat(np.arange(len(tokens)), lengths), context, words


def pair_counts(docs: DataFrame, text_col: str, held_col: str) -> DataFrame:
    """``u, w, c``: every distinct pair of neighbours and its training count."""

    def flush(parts):
        u, w, n = (np.concatenate(x) for x in zip(*parts))
        key = mix(u * np.uint64(0x9E3779B97F4A7C15) + mix(w))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        c = np.bincount(which, n, len(first)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (u[first].view(np.int64), w[first].view(np.int64), c)], names=["u", "w", "c"])

    def step(batches):
        parts, size = [], 0
        for part, row, u, w in neighbours(batches):
            held = np.array(part.column(0).to_pylist(), bool)
            parts.append((u, w, (~held)[row]))
            size += len(u)
            if size > CHUNK:
                yield flush(parts)
                parts, size = [], 0
        if parts:
            yield flush(parts)

    return scan(docs, [held_col, text_col], step, "u long, w long, c long").groupBy("u", "w").agg(F.sum("c").alias("c"))


# -- cells and types -----------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one value: whole numbers as narrow as they go, bytes of equal weight together."""
    heads, bodies = [], []
    for a in arrays:
        if a.dtype.kind in "iu" and len(a) and a.min() >= 0:
            a = a.astype(np.min_scalar_type(a.max()))
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        bodies.append(pa.compress(raw, codec="zstd", asbytes=True))
        heads.append(f"{a.dtype.str} {len(a)} {len(bodies[-1])}")
    return b"".join([";".join(heads).encode() + b"\n", *bodies])


def unpack(value: bytes, wide: bool = True) -> list[np.ndarray]:
    """The arrays of ``pack``; whole numbers come as int64, or as narrow as they were packed."""
    head, at = value[: value.index(b"\n")].decode(), value.index(b"\n") + 1
    out = []
    for kind, n, size in (x.split() for x in head.split(";")):
        dtype, n, size = np.dtype(kind), int(n), int(size)
        raw = pa.decompress(value[at : at + size], decompressed_size=n * dtype.itemsize, codec="zstd", asbytes=True)
        a = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n)
        out.append(a.astype(np.int64) if wide and dtype.kind in "iu" else a)
        at += size
    return out


def gaps(keys: np.ndarray) -> np.ndarray:
    """Ascending hashes as differences; ``np.cumsum`` gives them back."""
    return np.diff(keys, prepend=np.uint64(0))


def keys_of(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a.astype(np.uint64), dtype=np.uint64)


def spans(counts: np.ndarray) -> np.ndarray:
    """Starts of consecutive lists of these lengths, and the end of the last."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


@dataclass(frozen=True)
class Grid:
    """Pairs are dealt to ``rows`` x ``columns`` cells by their context and their word, so
    neither a common context nor a common word fills a cell; words (types) are dealt to
    ``groups`` of neighbouring hashes."""

    rows: int
    columns: int

    @classmethod
    def over(cls, parts: int) -> Grid:
        rows = max(1, int(np.ceil(np.sqrt(parts))))
        return cls(rows, max(1, -(-parts // rows)))

    @property
    def groups(self) -> int:
        return self.rows * self.columns

    def cell(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self.row(u) * self.columns + self.column(w)

    def row(self, u: np.ndarray) -> np.ndarray:
        return (mix(u) >> np.uint64(33)).astype(np.int64) % self.rows

    def column(self, w: np.ndarray) -> np.ndarray:
        return (mix(~w) >> np.uint64(33)).astype(np.int64) % self.columns

    @property
    def bounds(self) -> np.ndarray:
        return np.array([(g << 64) // self.groups for g in range(1, self.groups)], np.uint64)

    def cuts(self, keys: np.ndarray) -> np.ndarray:
        """Where each group begins among ascending hashes, and their end."""
        return np.concatenate([[0], np.searchsorted(keys, self.bounds), [len(keys)]]).astype(np.int64)


#: What travels: to a cell or group ``at``, from ``src``.
MESSAGE = "at int, kind int, src int, blob binary"
TYPES, TOLD, TABLES, STATE, LETTERS_USED, ANSWER, BODY = range(7)


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["at", "kind", "src", "blob"])


@contextmanager
def small_batches(spark):
    """Spark's limit for batches that go to Python, 64 MB, lowered for a while."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)


@lru_cache(maxsize=1)
def c_library():
    import ctypes

    return ctypes.CDLL(None)


def hand_back() -> None:
    """Memory that a step has freed goes back to the system: workers are reused, and
    what they keep for themselves is missing in their executor."""
    pa.default_memory_pool().release_unused()
    if hasattr(c_library(), "malloc_trim"):  # of glibc
        c_library().malloc_trim(0)


def met(frames: list[DataFrame], step, schema: str = MESSAGE) -> DataFrame:
    """``step(at, {kind: {src: arrays}})`` for every cell or group that messages go to; bodies
    come packed, as there may be many."""

    def one(key, table):
        got: dict[int, dict[int, list[np.ndarray]]] = {}
        for kind, src, blob in sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "src", "blob"))), key=lambda x: x[:2]):
            got.setdefault(kind, {})[src] = blob if kind == BODY else unpack(blob)
        del table
        out = step(key[0].as_py(), got)
        got.clear()
        hand_back()
        return out

    return reduce(DataFrame.unionByName, frames).groupBy("at").applyInArrow(one, schema)


def each(frame: DataFrame, step, schema: str = MESSAGE) -> DataFrame:
    """``step(row)`` gives the messages or the table of every row, its blobs as bytes."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from step(row).combine_chunks().to_batches()
        hand_back()

    return frame.mapInArrow(run, schema)


class Numbers(dict):
    """word -> its number in order of coming."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def dealt(docs: DataFrame, id_col: str, text_col: str, held_col: str, grid: Grid) -> DataFrame:
    """One pass over the texts: to each cell its tokens by context, word and text, to each
    group its words with their training counts. ``kind`` is 1 for a cell, 0 for a group."""

    def rows(words: Numbers, first: bytes, tokens: list[np.ndarray], ids: list, held: list[bool]):
        import xxhash

        n_first = words[first]
        spelled = list(words)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, spelled), np.uint64, len(spelled))
        order = np.argsort(h)
        h = h[order]
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        held, lengths = np.array(held, bool), [len(t) for t in tokens]
        key = rank[np.concatenate(tokens)]
        c = np.bincount(key[np.repeat(~held, lengths)].astype(np.int64), minlength=len(h))
        of_u = np.concatenate([[rank[n_first]], key[:-1]])  # a text follows on the end before it
        key <<= np.uint64(20)
        key |= np.repeat(np.arange(len(tokens), dtype=np.uint64), lengths)
        of_u <<= np.uint64(42)
        key |= of_u
        del of_u
        key.sort()
        low, narrow = np.uint64((1 << 22) - 1), np.min_scalar_type(grid.groups)
        cell = (grid.row(h) * grid.columns).astype(narrow)[key >> np.uint64(42)]
        cell += grid.column(h).astype(narrow)[key >> np.uint64(20) & low]
        key = key[np.argsort(cell, kind="stable")]
        ends = spans(np.bincount(cell, minlength=grid.groups))
        del cell
        numbers = pa.array(ids, pa.int64())
        for at in np.flatnonzero(np.diff(ends)):
            k = key[ends[at] : ends[at + 1]]
            pair = k >> np.uint64(20)
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            of_u, of_w = (pair[first] >> np.uint64(22)).astype(np.int64), (pair[first] & low).astype(np.int64)
            us, n_pairs = np.unique(of_u, return_counts=True)
            ws, wi = np.unique(of_w, return_inverse=True)
            texts, di = np.unique((k & np.uint64((1 << 20) - 1)).astype(np.int64), return_inverse=True)
            own = numbers.take(pa.array(texts))
            yield 1, int(at), pack(
                gaps(h[us]), gaps(h[ws]), n_pairs, wi, np.diff(first, append=len(k)), di,
                np.diff(own.fill_null(0).to_numpy(), prepend=0), own.is_null().to_numpy(zero_copy_only=False), held[texts],
            )
        cuts = grid.cuts(h)
        for at, lo, hi in zip(range(grid.groups), cuts, cuts[1:]):
            if lo < hi:
                part = [spelled[i] for i in order[lo:hi]]
                yield 0, at, pack(gaps(h[lo:hi]), np.array([len(x) for x in part]), np.frombuffer(b"".join(part), np.uint8), c[lo:hi])

    def batch_of(out):
        kinds, ats, blobs = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(ats, pa.int32()), pa.array(blobs, pa.binary())], names=["kind", "at", "blob"])

    def batches_of(*chunk):
        out, size = [], 0
        for row in rows(*chunk):
            out.append(row)
            size += len(row[2])
            if size >= BATCH_BYTES:
                yield batch_of(out)
                out, size = [], 0
        if out:
            yield batch_of(out)

    def step(batches):
        words, last, first, tokens, ids, held, size = Numbers(), b"", b"", [], [], [], 0
        for batch in batches:
            rows_of = (zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)) for at in range(0, batch.num_rows, 500))
            for doc, out, text in chain.from_iterable(rows_of):
                every = words_of(text)
                every.append(b"")
                for at in range(0, len(every), PIECE):  # a long text may go on in the next chunk
                    part = every[at : at + PIECE]
                    tokens.append(np.fromiter(map(words.__getitem__, part), np.int32, len(part)))
                    ids.append(doc)
                    held.append(bool(out))
                    last, size = part[-1], size + len(part)
                    if size >= CHUNK or len(tokens) >= 1 << 19:
                        yield from batches_of(words, first, tokens, ids, held)
                        words, first, tokens, ids, held, size = Numbers(), last, [], [], [], 0
                        hand_back()
        if tokens:
            yield from batches_of(words, first, tokens, ids, held)
        del words, tokens, ids, held
        hand_back()

    rows_in = docs.select(docs[id_col].cast("long").alias("id"), docs[held_col].alias("held"), docs[text_col].alias("text"))
    return scan(rows_in, ["id", "held", "text"], step, "kind int, at int, blob binary")


#: Of a group (kind 0): hashes, training counts, none, spellings. Of a cell (1): its hashes,
#: what each says of its pairs, the pairs seated in sweeps, its texts. Of a cell's pieces
#: (from 2 on): all pairs with their texts, as bodies.
STORED = "kind int, at int, keys binary, counts binary, seated binary, body binary"


def stored(kind: int, at: int, *blobs: bytes) -> pa.Table:
    return pa.table([pa.array([kind], pa.int32()), pa.array([at], pa.int32()), *[pa.array([b], pa.binary()) for b in blobs]], names=["kind", "at", "keys", "counts", "seated", "body"])


def cell_row(at: int, us, ws, ui, wi, c, *texts: np.ndarray) -> pa.Table:
    """A cell of pairs in order of ``ui``, ``wi`` (places in the ascending hashes); of its
    ``texts`` the places of each pair's, where these begin, then ids and nulls."""
    once = c == 1
    more = np.flatnonzero(c > 1)
    su, u_at = np.unique(ui[more], return_inverse=True)
    sw, w_at = np.unique(wi[more], return_inverse=True)
    cell = stored(
        1, at, pack(gaps(us), gaps(ws)),
        pack(np.bincount(wi[once], minlength=len(ws)), np.bincount(ui[once], minlength=len(us)), np.bincount(ui, c, len(us)).astype(np.int64)),
        pack(gaps(us[su]), gaps(ws[sw]), np.bincount(u_at, minlength=len(su)), w_at, c[more]),
        pack(*texts[2:]) if texts else b"",
    )
    if not texts:
        return cell
    doc, begin = texts[:2]
    ends, many = np.append(begin, len(doc)), spans(c > 1)
    piece = (begin + np.arange(len(c))) // SLICE
    cuts = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(c))
    pieces = [
        stored(2 + k, at, b"", b"", b"", pack(
            np.array([ui[lo], many[lo]]), np.bincount(ui[lo:hi] - ui[lo]), wi[lo:hi], c[lo:hi], np.diff(ends[lo : hi + 1]), doc[ends[lo] : ends[hi]],
        ))
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
    ]
    return pa.concat_tables([cell, *pieces])  # a batch each


def gathered(key, table):
    """What the chunks of the pass sent to a cell or a group, as it is stored."""
    kind, at = (k.as_py() for k in key)
    blobs = sorted(table.column("blob").to_pylist())
    del table
    out = merged(kind, at, [unpack(b, wide=False) for b in blobs])
    hand_back()
    return out


def merged(kind: int, at: int, parts: list[list[np.ndarray]]) -> pa.Table:
    if kind == 0:
        h = np.concatenate([keys_of(x[0]) for x in parts])
        h, first, which = np.unique(h, return_index=True, return_inverse=True)
        c = np.bincount(which, np.concatenate([x[3] for x in parts]), len(h)).astype(np.int64)
        spelled = spellings(np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts])).take(pa.array(first))
        data = np.frombuffer(b"".join(spelled.to_pylist()), np.uint8)
        return stored(0, at, pack(gaps(h)), pack(c), b"", pack(np.diff(np.frombuffer(spelled.buffers()[1], np.int64, len(h) + 1, spelled.offset * 8)), data))
    us, ws = (np.unique(np.concatenate([keys_of(x[i]) for x in parts])) for i in (0, 1))
    pair = np.concatenate([np.repeat(np.searchsorted(us, keys_of(x[0])) << 32, x[2]) | np.searchsorted(ws, keys_of(x[1]))[x[3]] for x in parts])
    n = np.concatenate([x[4] for x in parts])
    doc = np.concatenate([x[5].astype(np.uint32) + np.uint32(s) for x, s in zip(parts, spans([len(x[6]) for x in parts]))])
    ids = np.concatenate([np.cumsum(x[6].astype(np.int64)) for x in parts])
    null, held = (np.concatenate([x[i] for x in parts]) for i in (7, 8))
    parts.clear()
    order = np.argsort(pair, kind="stable")
    pair, starts, n = pair[order], spans(n)[:-1][order], n[order]
    del order
    begin = spans(n)
    starts -= begin[:-1]
    take = np.repeat(starts, n)
    take += np.arange(len(take))
    doc = doc[take]
    del take, starts, n
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    pair, begin = pair[first], begin[first]
    c = np.add.reduceat((~held)[doc], begin, dtype=np.int64)
    return cell_row(at, us, ws, pair >> 32, pair & 0xFFFFFFFF, c, doc, begin, np.diff(ids, prepend=0), null)


def spellings(lengths: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(spans(lengths)), pa.py_buffer(np.ascontiguousarray(data).astype(np.uint8))])


# -- seating -----------------------------------------------------------------


@lru_cache(maxsize=4)
def log_stirling(d: float, size: int = EXACT) -> np.ndarray:
    """log S_d(c, t) for c, t up to ``size``: S(c+1, t) = S(c, t-1) + (c - t d) S(c, t)."""
    table = np.full((size + 1, size + 1), -np.inf)
    table[0, 0] = 0.0
    t = np.arange(size + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(size):
            stay = np.log(np.maximum(c - t * d, 0.0)) + table[c]
            opened = np.concatenate([[-np.inf], table[c][:-1]])
            table[c + 1] = np.logaddexp(stay, opened)
    return table


def window(c: int, a: float) -> tuple[int, np.ndarray]:
    """For d = 1/2, a^t S(c, t) around its mode, cumulated, from a first t on: S(c, t) =
    (2c - t - 1)! / ((c - t)! (t - 1)! 4^(c - t)). What is left out on either side is
    below e^-60 of the mode's weight, as the weights are log-concave in t."""
    # at the mode the ratio of neighbours 4 a (c - t) / (t (2c - t - 1)) passes 1
    half = c + 2 * a - 0.5
    mode = 4 * a * c / (half + np.sqrt(max(half * half - 4 * a * c, 0.0)))
    mode = min(max(mode, 1.0), c - 0.5)
    spread = 1 / np.sqrt(max(1 / (c - mode) - 1 / (2 * c - mode - 0.5) + 1 / mode, 1e-18))
    lo, hi = max(1, int(mode - 12 * spread - 60)), min(c, int(mode + 12 * spread + 60))
    t = np.arange(lo, hi, dtype=float)
    step = np.log(4 * a) + np.log((c - t) / (t * (2 * c - t - 1)))
    logits = np.concatenate([[0.0], np.cumsum(step)])
    p = np.exp(logits - logits.max()).cumsum()
    return lo, p / p[-1]


def seat(c: np.ndarray, a: np.ndarray, d: float, u: np.ndarray, z: np.ndarray | None = None) -> np.ndarray:
    """Tables of dishes with ``c`` customers and base weights ``a``: one Gibbs draw by
    the uniform numbers ``u`` (``z`` is no longer needed)."""
    t = np.minimum(c, 1).astype(float)
    first = np.minimum(c, EXACT)
    stirling = log_stirling(d)
    a = np.maximum(a, 1e-300)
    log_a = np.log(a)
    order = np.argsort(first, kind="stable")
    order = order[: len(c) - (c > EXACT).sum()]
    edges = np.searchsorted(first[order], np.arange(2, EXACT + 2))
    for size, lo, hi in zip(range(2, EXACT + 1), edges, edges[1:]):
        for at in range(lo, hi, 1 << 14):  # cells held at once stay bounded
            rows = order[at : min(hi, at + (1 << 14))]
            logits = np.arange(1, size + 1) * log_a[rows, None] + stirling[size, 1 : size + 1]
            p = np.exp(logits - logits.max(1, keepdims=True)).cumsum(1)
            t[rows] = 1 + (p < (u[rows] * p[:, -1])[:, None]).sum(1)
    many = np.flatnonzero(c > EXACT)
    if len(many) and d != 0.5:
        raise ValueError(f"more than {EXACT} customers of a dish need a discount of 1/2")
    for i in many:
        start, p = window(int(c[i]), float(a[i]))
        t[i] = start + np.searchsorted(p, u[i])
    return t


def uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def draws(words: list[bytes], sweep: int) -> np.ndarray:
    """A uniform number per word, the same wherever the word is."""
    import xxhash

    return uniform(np.fromiter((xxhash.xxh3_64_intdigest(w, seed=sweep) for w in words), np.uint64, len(words)))


# -- the spelling model ------------------------------------------------------


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes ``b2 b1 byte`` of all bytes of spelled words, and each word's length.

    A word is closed by ``STOP``; before its first byte the context is ``STOP`` twice.
    """
    return trigram_codes(np.array([len(w) for w in words], np.int64), np.frombuffer(b"".join(words), np.uint8))


def trigram_codes(sizes: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``trigrams`` of words that lie one after the other in ``data``."""
    b = np.full(2 + len(data) + 3 * len(sizes), STOP, np.int32)
    b[2 + np.arange(len(data)) + 3 * np.repeat(np.arange(len(sizes)), sizes)] = data
    codes = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    keep = np.ones(len(codes), bool)
    ends = np.cumsum(sizes + 3)
    keep[ends - 1] = keep[ends - 2] = False  # the two positions between words
    return codes[keep], sizes + 1


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ascending distinct codes, and the place of each among them."""
    there = np.zeros(1 << 24, bool)
    there[codes] = True
    seen = np.flatnonzero(there)
    place = np.empty(1 << 24, np.int32)
    place[seen] = np.arange(len(seen), dtype=np.int32)
    return seen, place[codes]


@dataclass
class Letters:
    """Sorted trigram codes with log probabilities, and the backed-off ones below."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # codes, seen mass, contexts, back-off mass

    def log_prob(self, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), 1 / 256)
        for k, (grams, mass, contexts, rest) in enumerate(self.levels):
            own = codes & ((1 << 8 * (k + 1)) - 1)
            above = own >> 8
            at = np.minimum(np.searchsorted(contexts, above), max(len(contexts) - 1, 0))
            back = np.where(contexts[at] == above, rest[at], 1.0) if len(contexts) else 1.0
            at = np.minimum(np.searchsorted(grams, own), max(len(grams) - 1, 0))
            seen = np.where(grams[at] == own, mass[at], 0.0) if len(grams) else 0.0
            p = seen + back * p
        return np.log(p)

    def spelling(self, words: list[bytes]) -> np.ndarray:
        """log probability of each spelled word."""
        if not words:
            return np.empty(0)
        codes, lengths = trigrams(words)
        return np.add.reduceat(self.log_prob(codes), np.concatenate([[0], np.cumsum(lengths)[:-1]]))


def seat_letters(codes: np.ndarray, counts: np.ndarray, last: Letters, totals: list[dict[int, float]], rng) -> tuple[Letters, list[dict[int, float]]]:
    """One sweep over the letter restaurants, from the longest contexts up.

    Customers of a context's parent are the tables of its children. ``last`` and
    ``totals`` (tables by context) are the sweep before; new ones are returned.
    """
    levels, now = [], []
    for k in (2, 1, 0):
        d, theta = LETTER_D[k], LETTER_THETA[k]
        above = codes >> 8
        parent = Letters(last.levels[:k])
        base = np.exp(parent.log_prob(codes & ((1 << 8 * k) - 1))) if k else np.full(len(codes), 1 / 256)
        tables = np.array([totals[k].get(x, 0.0) for x in above.tolist()]) if totals[k] else np.zeros(len(codes))
        t = seat(counts, (theta + d * tables) * base, d, rng.random(len(codes)))
        contexts, which = np.unique(above, return_inverse=True)
        c_all = np.bincount(which, counts, len(contexts))
        t_all = np.bincount(which, t, len(contexts))
        levels.append((codes, (counts - d * t) / (theta + c_all[which]), contexts, (theta + d * t_all) / (theta + c_all)))
        now.append(dict(zip(contexts.tolist(), t_all.tolist())))
        codes, which = np.unique(codes & ((1 << 8 * k) - 1), return_inverse=True) if k else (codes, None)
        counts = np.bincount(which, t) if k else counts
    return Letters(levels[::-1]), now[::-1]


# -- the word restaurant -----------------------------------------------------


@dataclass
class Sweep:
    """What a sweep's predictive probabilities need besides the words' customers."""

    number: int
    letters: Letters
    tables: float  # T of the word restaurant, as the sweep's draws used it
    customers: float = 0.0  # of the word restaurant, after the sweep
    total: float = 0.0  # its tables after the sweep
    mass: float = 0.0  # of the spelling model on the seen words

    def probability(self, c: np.ndarray, t: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Of words with ``c`` customers at ``t`` tables, a new table serving them by ``new``."""
        return (c - WORD_D * t + (WORD_THETA + WORD_D * self.total) * new) / (WORD_THETA + self.customers)


def word_batches(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 16):
            part = batch.slice(at, 1 << 16)
            words = [w.encode("utf-8", "surrogatepass") for w in part.column(0).to_pylist()]
            yield part, words, part.column(1).to_numpy(zero_copy_only=False)


def named(words: DataFrame) -> DataFrame:
    """``words`` with the hash ``w`` by which pairs name them."""

    def step(batches):
        import xxhash

        for part, spelled, _ in word_batches(batches):
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, spelled), np.uint64, len(spelled))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(h.view(np.int64))], names=["word", "c", "w"])

    return scan(words, ["word", "c"], step, "word string, c long, w long")


def seat_types(types: DataFrame, told: DataFrame, s: Sweep, keep: bool, last: bool) -> tuple[DataFrame, np.ndarray, np.ndarray, Sweep]:
    """One sweep over the word restaurant, given the tables that the cells have told of.

    The messages: answers to the cells, but after the ``last`` sweep, and, with ``keep``,
    the state of every group. Then
    the letters that the tables were spelled with, as trigram codes and counts, and the
    sweep with its totals. In the first sweep each word has one table.
    """
    shared = types.sparkSession.sparkContext.broadcast(s)

    def step(at, got):
        if TYPES not in got:
            return messages([])
        s = shared.value
        keys, _, sizes, data, n, tables, _ = got[TYPES][0]
        keys, places = keys_of(keys), {}
        for src, (ws, of_w, us, of_u) in got.get(TOLD, {}).items():
            places[src] = w, u = np.searchsorted(keys, keys_of(ws)), np.searchsorted(keys, keys_of(us))
            n[w] += of_w
            tables[u] += of_u
        codes, lengths = trigram_codes(sizes, data)
        seen, which = distinct(codes)
        h = np.exp(np.add.reduceat(s.letters.log_prob(seen)[which], spans(lengths)[:-1]))
        t = np.minimum(n, 1).astype(float)
        if s.number:
            many = np.flatnonzero(n > 1)
            spelled = spellings(sizes, data).take(pa.array(many)).to_pylist()
            t[many] = seat(n[many], (WORD_THETA + WORD_D * s.tables) * h[many], WORD_D, draws(spelled, s.number))
        used = np.bincount(which, np.repeat(t, lengths), len(seen))
        t = t.astype(np.int64)
        sums = np.array([t.sum(), h[n > 0].sum(), n.sum()])
        out = [(at, LETTERS_USED, 0, pack(seen[used > 0], used[used > 0], sums))]
        if keep:
            out.append((at, STATE, s.number, pack(n, t, h, tables)))
        if not last:
            out += [(src, ANSWER, at, pack(n[w], t[w], h[w], tables[u])) for src, (w, u) in places.items()]
        return messages(out)

    sent = met([types, told], step).checkpoint()

    def letters(row):
        codes, n, sums = unpack(row["blob"])
        return pa.table([pa.array(np.append(codes, [-1, -2, -3])), pa.array(np.append(n, sums))], names=["code", "n"])

    # table counts are whole numbers: their sums are the same in any order
    counted = each(of_kind(sent, LETTERS_USED), letters, "code long, n double").groupBy("code").agg(F.sum("n").alias("n"))
    gathered = counted.toPandas().sort_values("code")
    shared.unpersist()
    code, n = gathered.code.to_numpy(np.int64), gathered.n.to_numpy()
    total, mass, customers = (float(n[code == -k].sum()) for k in (1, 2, 3))
    s = Sweep(s.number, s.letters, s.tables, customers, total, min(mass, 1.0))
    return sent, code[code >= 0], n[code >= 0], s


def of_kind(frame: DataFrame, kind: int) -> DataFrame:
    return frame.where(F.col("kind") == kind)


# -- the restaurants of contexts ---------------------------------------------


def tell(at: int, grid: Grid, us: np.ndarray, ws: np.ndarray, of_u: tuple = (), of_w: tuple = ()) -> list[tuple]:
    """Messages of a cell to the groups of its contexts and words, with a number for each."""
    u, w = grid.cuts(us), grid.cuts(ws)
    return [
        (g, TOLD, at, pack(gaps(ws[w[g] : w[g + 1]]), *[x[w[g] : w[g + 1]] for x in of_w], gaps(us[u[g] : u[g + 1]]), *[x[u[g] : u[g + 1]] for x in of_u]))
        for g in range(grid.groups)
        if w[g] < w[g + 1] or u[g] < u[g + 1]
    ]


def answers(got: dict) -> list[np.ndarray]:
    """What the groups answered, in the order of the cell's hashes: groups are ranges of them."""
    return [np.concatenate(x) for x in zip(*got.get(ANSWER, {}).values())]


def seats_told(at: int, grid: Grid, seats: list[np.ndarray], t: np.ndarray) -> list[tuple]:
    us, ws, n_pairs, w, _ = seats
    u = np.repeat(np.arange(len(us)), n_pairs)
    of_u, of_w = (np.bincount(i, t, len(x)).astype(np.int64) for i, x in ((u, us), (w, ws)))
    return tell(at, grid, keys_of(us), keys_of(ws), (of_u,), (of_w,))


def seat_pairs(seated: DataFrame, sent: DataFrame, grid: Grid, s: Sweep) -> DataFrame:
    """The next sweep over the cells' pairs, given the contexts' tables and the words'
    probabilities of ``s``: what the cells tell, and their tables."""
    shared, sweep = replace(s, letters=None), s.number + 1

    def step(at, got):
        if TYPES not in got or not len(got[TYPES][0][4]):
            return messages([])
        us, ws, n_pairs, w_at, c = got[TYPES][0]
        n, t, h, tables = answers(got)
        p = shared.probability(n, t, h)
        u_at = np.repeat(np.arange(len(us)), n_pairs)
        draw = uniform(mix(mix(keys_of(us)[u_at] + np.uint64(sweep)) + keys_of(ws)[w_at]))
        t = seat(c, (PAIR_THETA + PAIR_D * tables[u_at]) * p[w_at], PAIR_D, draw).astype(np.int64)
        return messages([*seats_told(at, grid, got[TYPES][0], t), (at, TABLES, sweep, pack(t))])

    return met([seated, of_kind(sent, ANSWER)], step).checkpoint()


def sample(store: DataFrame, grid: Grid, burn: int, kept: int, seed: int) -> tuple[DataFrame, list[tuple[Sweep, DataFrame, DataFrame]]]:
    """Sample the seating of stored cells and groups. The groups' hashes with their training
    counts and customers; per kept sweep its totals, the groups' states and the cells' tables."""
    spark = store.sparkSession
    cells, groups = of_kind(store, 1), of_kind(store, 0)

    def counts(row):
        (us, ws), (once_w, once_u, customers) = unpack(row["keys"]), unpack(row["counts"])
        return messages(tell(row["at"], grid, keys_of(us), keys_of(ws), (once_u, customers), (once_w,)))

    def words(row):
        return messages([(row["at"], TYPES, 0, pack(*(a for x in ("keys", "counts", "body") for a in unpack(row[x]))))])

    def census(at, got):
        if TYPES not in got:
            return messages([])
        keys, c, sizes, data = got[TYPES][0]
        own, once_w, once_u, customers = keys_of(keys), *(np.zeros(len(keys), np.int64) for _ in range(3))
        for ws, n_w, us, n_u, n in got.get(TOLD, {}).values():
            once_w[np.searchsorted(own, keys_of(ws))] += n_w
            at_u = np.searchsorted(own, keys_of(us))
            once_u[at_u] += n_u
            customers[at_u] += n
        return messages([(at, TYPES, 0, pack(keys, c, sizes, data, once_w, once_u, customers))])

    def first(row):  # one table each at first
        seats = unpack(row["seated"])
        return messages(seats_told(row["at"], grid, seats, np.ones(len(seats[4]))))

    types = met([each(groups.select("at", "keys", "counts", "body"), words), each(cells.select("at", "keys", "counts"), counts)], census).checkpoint()
    seated = cells.select("at", F.lit(TYPES).alias("kind"), F.lit(0).alias("src"), F.col("seated").alias("blob"))
    release_shuffles(spark)
    rng = np.random.default_rng(seed)
    letters, totals = Letters([(np.empty(0, np.int64),) * 4] * 3), [{}, {}, {}]
    s, out = Sweep(0, letters, 0.0), []
    told = each(cells.select("at", "seated"), first)
    for number in range(burn + kept):
        if number:
            told = seat_pairs(seated, sent, grid, s)
            s = Sweep(number, letters, s.total)
        sent, code, n, s = seat_types(types, of_kind(told, TOLD), s, number >= burn, number == burn + kept - 1)
        if number >= burn:  # alone, so that the messages can go
            tables = of_kind(told, TABLES) if number else told.limit(0)
            out.append((replace(s, letters=None), of_kind(sent, STATE).checkpoint(), tables.checkpoint()))
        letters, totals = seat_letters(code, n, s.letters, totals, rng)
        release_shuffles(spark)

    def known(row):
        keys, c, _, _, _, _, customers = unpack(row["blob"])
        return messages([(row["at"], TYPES, 0, pack(keys, c, customers))])

    types = each(types, known).checkpoint()
    told = sent = None
    release_shuffles(spark)
    return types, out


def train(words: DataFrame, pairs: DataFrame, burn: int = BURN, kept: int = KEPT, seed: int = 1) -> list[tuple]:
    """Sample the seating of given counts. Per kept sweep: the words' probabilities (w, p, q),
    with unseen words as one event and spelled out, the contexts' customers and tables
    (u, customers, tables) and the tables of the pairs that occur more than once (u, w, t).

    ``words`` (word, c, w) holds each distinct word once, the end token included;
    ``pairs`` (u, w, c) each distinct pair of the training texts.
    """
    grid = Grid.over(-(-pairs.count() // CHUNK))
    places = {1: lambda u, w: grid.cell(u, w), 0: lambda _, w: np.searchsorted(grid.bounds, w, "right")}

    def placed(kind: int):
        def step(batches):
            for batch in batches:
                u, w = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
                yield batch.append_column("at", pa.array(places[kind](u, w).astype(np.int32)))

        return step

    def cell(key, table):
        u, w = (table.column(k).to_numpy().view(np.uint64) for k in ("u", "w"))
        order = np.lexsort((w, u))
        us, ui = np.unique(u[order], return_inverse=True)
        ws, wi = np.unique(w[order], return_inverse=True)
        return cell_row(key[0].as_py(), us, ws, ui, wi, table.column("c").to_numpy()[order])

    def group(key, table):
        w = table.column("w").to_numpy().view(np.uint64)
        order = np.argsort(w)
        spelled = [x.encode("utf-8", "surrogatepass") for x in table.column("word").take(pa.array(order)).to_pylist()]
        sizes, data = np.array([len(x) for x in spelled]), np.frombuffer(b"".join(spelled), np.uint8)
        return stored(0, key[0].as_py(), pack(gaps(w[order])), pack(table.column("c").to_numpy()[order]), b"", pack(sizes, data))

    cells = scan(pairs, ["u", "w", "c"], placed(1), "u long, w long, c long, at int").groupBy("at").applyInArrow(cell, STORED)
    groups = scan(words.withColumn("u", F.lit(0).cast("long")), ["u", "w", "word", "c"], placed(0), "u long, w long, word string, c long, at int").groupBy("at").applyInArrow(group, STORED)
    store = cells.unionByName(groups).checkpoint()
    types, model = sample(store, grid, burn, kept, seed)

    def exported(s: Sweep, state: DataFrame, tables: DataFrame) -> tuple:
        def probabilities(at, got):
            keys, n, t, h = keys_of(got[TYPES][0][0]), *got[STATE][s.number][:3]
            p, q = s.probability(n, t, np.where(n > 0, h, 1 - s.mass)), s.probability(n, t, h)
            return pa.table([pa.array(keys.view(np.int64)), pa.array(p), pa.array(q)], names=["w", "p", "q"])

        def contexts(at, got):
            keys, customers, tables = keys_of(got[TYPES][0][0]), got[TYPES][0][2], got[STATE][s.number][3]
            there = customers > 0
            return pa.table([pa.array(keys.view(np.int64)[there]), pa.array(customers[there]), pa.array(tables[there])], names=["u", "customers", "tables"])

        def seats(at, got):
            us, ws, n_pairs, w_at, _ = got[TYPES][0]
            t = got[TABLES][s.number][0] if TABLES in got else np.empty(0, np.int64)
            u, w = np.repeat(keys_of(us), n_pairs).view(np.int64), keys_of(ws).view(np.int64)[w_at]
            return pa.table([pa.array(u), pa.array(w), pa.array(t)], names=["u", "w", "t"])

        seated = of_kind(store, 1).select("at", F.lit(TYPES).alias("kind"), F.lit(0).alias("src"), F.col("seated").alias("blob"))
        return (
            met([types, state], probabilities, "w long, p double, q double"),
            met([types, state], contexts, "u long, customers long, tables long"),
            met([seated, tables], seats, "u long, w long, t long"),
        )

    return [exported(*part) for part in model]


def score(docs: DataFrame, held_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows with a false ``held_col`` and score every text."""
    with small_batches(docs.sparkSession):
        return scored(docs, held_col, id_col, text_col)


def scored(docs: DataFrame, held_col: str, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(docs[text_col])), F.lit(0))).first()[0]
    grid = Grid.over(-(-size // CELL_BYTES))
    path = scratch(spark, "word-pairs")
    # sizes are looked at after every row, as few rows are many bytes
    small = {"parquet.block.size": BATCH_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    dealt(docs, id_col, text_col, held_col, grid).groupBy("kind", "at").applyInArrow(gathered, STORED).write.options(**small).parquet(path)
    release_shuffles(spark)
    store = spark.read.schema(STORED).parquet(path)
    types, model = sample(store, grid, BURN, KEPT, 1)
    sweeps = [s for s, _, _ in model]

    def totals(row):
        c = unpack(row["blob"])[1]
        return pa.table([pa.array([int(c.sum())]), pa.array([int((c > 0).sum())])], names=["n", "types"])

    n_train, n_types = each(types, totals, "n long, types long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()

    def asked(row):
        us, ws = unpack(row["keys"])
        return messages(tell(row["at"], grid, keys_of(us), keys_of(ws)))

    def answer(at, got):
        if TYPES not in got:
            return messages([])
        keys, c, customers = got[TYPES][0]
        keys, state = keys_of(keys), [(s.probability(n, t, h), tables) for s, (n, t, h, tables) in zip(sweeps, got[STATE].values())]
        out = []
        for src, (ws, us) in got.get(TOLD, {}).items():
            w, u = np.searchsorted(keys, keys_of(ws)), np.searchsorted(keys, keys_of(us))
            out.append((src, ANSWER, at, pack(c[w], customers[u], *(a for q, tables in state for a in (q[w], tables[u])))))
        return messages(out)

    def scores(at, got):
        ids, null = unpack(got[BODY].pop(0), wide=False)
        seen, customers, *state = answers(got)
        base = np.log10((seen + 0.5) / (n_train + 0.5 * (n_types + 1)))
        sums = np.zeros((5, len(ids)))
        for blob in got[BODY].values():
            (first, seated), n_pairs, w, c, n, texts = unpack(blob, wide=False)
            u, c, n = first.astype(np.int64) + np.repeat(np.arange(len(n_pairs)), n_pairs), c.astype(np.int64), n.astype(np.int64)
            more = c > 1
            mean, mean_open = np.zeros(len(c)), np.zeros(len(c))
            for s, q, tables in zip(sweeps, state[::2], state[1::2]):
                p = np.where(seen[w] > 0, q[w], s.probability(0, 0, 1 - s.mass))  # unseen words are one event
                t = np.minimum(c, 1)
                if TABLES in got:
                    t[more] = got[TABLES][s.number][0][seated : int(seated) + more.sum()]
                own, new = c - PAIR_D * t, PAIR_THETA + PAIR_D * tables[u]
                below = (PAIR_THETA + customers[u]) * len(sweeps)
                mean += (own + new * p) / below
                mean_open += (own + new * q[w]) / below
            logs = (np.log10(np.maximum(x, 1e-300)) for x in (mean, mean_open))
            for k, x in enumerate((np.ones(len(c)), seen[w] > 0, base[w], *logs)):
                sums[k] += np.bincount(texts, np.repeat(x, n), len(ids))
        ids = np.cumsum(ids.astype(np.int64))
        group, (n, known), (base, scored, opened) = ids % grid.groups, sums[:2].astype(np.int64), sums[2:]
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(grid.groups + 1))
        parts = ((g, order[lo:hi]) for g, lo, hi in zip(range(grid.groups), cuts, cuts[1:]) if lo < hi)
        # mostly no word is new, so that the difference of both scores is 0
        return messages([(g, BODY, at, pack(np.diff(ids[i], prepend=0), null[i], n[i], known[i], base[i], scored[i], (opened - scored)[i])) for g, i in parts])

    def summed(at, got):
        parts = [[np.cumsum(ids.astype(np.int64)), *rest] for ids, *rest in (unpack(x, wide=False) for x in got[BODY].values())]
        ids, null, n, known, base, scored, more = (np.concatenate(x) for x in zip(*parts))
        texts, which = np.unique(np.stack([ids, null.astype(np.int64)]), axis=1, return_inverse=True)
        n, known = (np.bincount(which, x).astype(np.int64) for x in (n, known))
        base, scored, more = (np.bincount(which, x) for x in (base, scored, more))
        train = np.full(len(n), n_train, np.int64)
        columns = [pa.array(texts[0], mask=texts[1] > 0), *map(pa.array, (n, known, train, base, scored, scored + more))]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "open_score"])

    cells = of_kind(store, 1)
    replies = met([types, *(state for _, state, _ in model), each(cells.select("at", "keys"), asked)], answer)
    bodies = store.where("kind > 0").select("at", F.lit(BODY).alias("kind"), (F.col("kind") - 1).alias("src"), F.col("body").alias("blob"))
    parts = met([bodies, replies, *(tables for _, _, tables in model)], scores)
    # at once, while batches are small, in no more files than there are groups
    return met([parts], summed, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, open_score double").coalesce(grid.groups).checkpoint()


def perplexity(scored: DataFrame) -> DataFrame:
    """Per-token perplexity of the scored texts, by held-out or not."""
    return scored.groupBy("held_out").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"),
    )
