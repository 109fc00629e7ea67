"""Byte-level BPE: boundaries from a scan of transition functions, cached pair merging.

The split pattern of the rank file is run as a finite automaton. Every code point gets a
symbol: its class (letter, number, white space, other), and, where the pattern looks
ahead, what follows (an apostrophe by the length of the ending after it; white space by
whether it is the last before something else). A symbol is a function from state to
state, and functions compose associatively: the texts of a batch, end to end with a
resetting symbol between them, are cut into equal chunks, the functions of all chunks
are composed side by side, the chunks' results are chained, and each chunk is then
walked from its known first state. A position starts a piece if its state and symbol
say so. No regex takes part, and no loop over the positions of a text.

Pieces are slices of the text. Each new piece is merged exactly, lowest rank first and
the leftmost of equals, by a heap over linked neighbours (so a piece of a million bytes
is no quadratic case), and remembered. Decoding gathers the vocabulary's bytes by the
offsets kept for each id.

The rank file is a parameter, read once per worker. Defined results: null text counts as
empty (no ids, empty decoding); repeated rows give a row each; a null id gives a row with
a null id; extra columns are ignored; an empty table gives an empty result. Whole texts
are encoded; memory holds one text, or ``GROUP`` code points of short ones, and a bounded
table of pieces.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratum.llm.common import scan

#: Code points of short texts that are split together.
GROUP = 1 << 20
#: Pieces remembered by a worker at most, and the longest of them.
PIECES, PIECE_CHARS = 500_000, 64
#: Length of a chunk of the scan.
CHUNK = 512

# Symbols. White space: SPACE_LAST and OTHER_LAST stand before something else.
LETTER, NUMBER, OTHER, END_1, END_2, INNER, SPACE_LAST, OTHER_LAST, RESET = range(9)
# States: what the piece so far is. OPEN: none (begin, or the piece is whole); PREFIX: a
# space that joins what follows; LEFT_1, LEFT_2: letters still to come of an ending.
OPEN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, PREFIX, LEFT_1, LEFT_2 = range(8)
#: Endings that the pattern splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, both by [symbol, state]."""
    to = np.zeros((9, 8), np.uint8)
    starts = np.ones((9, 8), bool)
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS), (INNER, IN_SPACE)):
        to[symbol] = state
        starts[symbol, state] = False
        if symbol != INNER:
            starts[symbol, PREFIX] = False
    to[LETTER, LEFT_1], to[LETTER, LEFT_2] = OPEN, LEFT_1
    starts[LETTER, [LEFT_1, LEFT_2]] = False
    for symbol, left in ((END_1, LEFT_1), (END_2, LEFT_2)):
        to[symbol] = left
        to[symbol, [IN_OTHERS, PREFIX]] = IN_OTHERS  # the apostrophe belongs to these
        starts[symbol, [IN_OTHERS, PREFIX]] = False
    to[SPACE_LAST], to[OTHER_LAST], to[RESET] = PREFIX, OPEN, OPEN
    return to, starts


TO, STARTS = automaton()


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """code point -> LETTER, NUMBER, OTHER, or INNER for white space.

    By the Unicode tables of the tiktoken library itself, which drops what its pattern
    does not match: the standard library's tables are of another Unicode version.
    """
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = np.full(0x110000, OTHER, np.uint8)
    for symbol, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (INNER, r"\s")):
        enc = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        table[codes(enc.decode_bytes(enc.encode_ordinary(every)).decode())] = symbol
    return table


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols(points: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """Symbols of the texts' code points; ``resets`` are the places between texts."""
    out = classes()[points]
    out[resets] = RESET
    space = out == INNER
    # white space before something that is neither white space nor the end
    last = np.flatnonzero(space[:-1] & ~space[1:] & (out[1:] != RESET))
    out[last] = np.where(points[last] == 32, SPACE_LAST, OTHER_LAST)
    marks = np.flatnonzero((points == ord("'")) & (out == OTHER))
    padded = np.concatenate([points, np.zeros(2, np.uint32)])
    padded[resets] = 0
    one, two = padded[marks + 1], padded[marks + 2]
    for ending in ENDINGS:
        hit = one == ord(ending[0])
        if len(ending) == 2:
            hit &= two == ord(ending[1])
        out[marks[hit]] = END_1 if len(ending) == 1 else END_2
    return out


def piece_starts(syms: np.ndarray) -> np.ndarray:
    """Where pieces start, by the scan; the first text starts in OPEN."""
    n = len(syms)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, RESET, np.uint8)
    grid[:n] = syms
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)  # one row per step of all chunks
    flat = TO.ravel()
    # the function of each chunk, composed step by step for all chunks together
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8))
    for step in grid:
        whole = flat[(step.astype(np.intp) << 3)[:, None] + whole]
    state = np.empty(rows, np.intp)
    now = OPEN
    for row, f in enumerate(whole.tolist()):
        state[row] = now
        now = f[now]
    starts = np.empty(grid.shape, bool)
    begins = STARTS.ravel()
    for k, step in enumerate(grid):
        at = (step.astype(np.intp) << 3) + state
        starts[k] = begins[at]
        state = flat[at].astype(np.intp)
    return starts.T.reshape(-1)[:n]


class ByteBpe:
    """Ranks of one file, and the pieces merged so far."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks: dict[bytes, int] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        token = [b""] * size
        for t, i in self.ranks.items():
            token[i] = t
        self.lengths = np.fromiter(map(len, token), np.int64, size)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.known: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece by exact merging."""
        ranks, n = self.ranks, len(piece)
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        after = list(range(1, n + 1))  # end of the part that starts here
        before = list(range(-1, n - 1))  # start of the part before
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or after[j] != end:
                continue  # one of the two parts has been merged since
            alive[j] = 0
            after[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:end])) is not None:
                heapq.heappush(heap, (r, h, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def ids_of(self, piece: str) -> bytes:
        """Ids of a piece as little-endian unsigned 32-bit integers."""
        found = self.known.get(piece)
        if found is None:
            found = np.array(self.merged(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            if len(piece) <= PIECE_CHARS:
                if len(self.known) >= PIECES:
                    self.known.clear()
                self.known[piece] = found
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        joined = "\0".join(texts)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        if not joined:
            yield from (b"" for _ in texts)
            return
        starts = piece_starts(symbols(codes(joined), ends[:-1]))
        starts[ends[:-1]] = True  # a place between texts ends the piece before it
        cut = np.flatnonzero(starts)
        known, ids_of = self.known, self.ids_of
        first = 0
        for end, last in zip(ends.tolist(), np.searchsorted(cut, ends).tolist()):
            at = cut[first:last].tolist()
            pieces = map(joined.__getitem__, map(slice, at, [*at[1:], end]))
            yield b"".join([known.get(p) or ids_of(p) for p in pieces])
            first = last + 1  # past the place between

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered by their offsets."""
        return self.bytes[self.places(ids)].tobytes()

    def places(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        shift = self.offsets[ids] - (np.cumsum(lengths) - lengths)
        return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of up to ``GROUP`` code points together; longer ones alone."""
    group: list[str] = []
    size = 0
    for text in texts:
        text = text or ""
        if group and size + len(text) > GROUP:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield group


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``offsets``: where in the text's UTF-8 each id's bytes start."""

    def step(batches):
        bpe = load(path)
        for batch in batches:
            doc = batch.column(0).cast(pa.int64())
            at = 0
            for group in groups(batch.column(1).to_pylist()):
                ids = [np.frombuffer(b, "<u4") for b in bpe.encode(group)]
                offsets = [np.cumsum(bpe.lengths[i]) - bpe.lengths[i] for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(at, len(group)), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                     pa.array(offsets, pa.list_(pa.int64()))],
                    names=["doc_id", "ids", "offsets"],
                )
                at += len(group)

    return scan(docs, [id_col, text_col], step, "doc_id long, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the decoded ``bytes`` of a column ``ids`` (null: empty)."""

    def step(batches):
        bpe = load(path)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            out = [bpe.decode(np.array(i or [], np.int64)) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "bytes"]
            )

    return scan(encoded, ["doc_id", "ids"], step, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: what a table of ids
    would hold, as digests, without moving the ids."""

    def step(batches):
        bpe = load(path)
        for batch in batches:
            doc = batch.column(0).cast(pa.int64())
            at = 0
            for group in groups(batch.column(1).to_pylist()):
                got = list(bpe.encode(group))
                decoded = (bpe.decode(np.frombuffer(b, "<u4")) for b in got)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(at, len(group)),
                        pa.array([len(b) // 4 for b in got], pa.int64()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in got], pa.string()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in decoded], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(group)

    return scan(docs, [id_col, text_col], step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
