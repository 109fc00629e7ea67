"""Periodic runs of words: seeds on equal k-grams, extended along diagonals.

A run of period q and length l is a stretch in which words q apart are equal; on the
diagonal of lag q it is l - q matches in a row. A wanted run (l >= 24 and l >= 3q) has
at least ``max(24 - q, 2q)`` matches, so each class of lags has a k-gram length that
every wanted run of the class is guaranteed to hold:

    lags 1..15: k = 16        lags Q..2Q-1 (Q = 16, 32, ...): k = 2Q

Equal k-grams get equal numbers, exactly, by pairing the numbers of their halves. The
pairs of occurrences that are seeds: of each occurrence the next one; and where that
one is p <= k/2 words on (the k-gram has period p, so each lag up to k - p in which it
recurs is a multiple of p and no smallest period), the first one beyond lag k - p. Any
others would lie closer together than the k-gram's smallest period, so a run has a seed
in its class and a k-gram of a thousand occurrences has at most two thousand seeds.
A table of the furthest position covered on each lag drops seeds inside what has been
extended before; the rest are extended both ways until words differ.

Words are split at ASCII white space and compared as they are. Defined results: null
or empty text has no words and no runs; repeated rows give a row each; a null id gives
a row with a null id; extra columns are ignored; an empty table gives an empty result.
Whole texts are searched; one text is in memory at a time.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratum.llm.common import row_step, scan, utf8

#: Least length, and least number of periods, of a run.
MIN_LENGTH, MIN_PERIODS = 24, 3
#: k-gram length of the first class, whose lags are all below it.
FIRST_K = 16


class Run(NamedTuple):
    start: int
    length: int
    period: int


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def paired(grams: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the (2 width)-grams from those of the width-grams."""
    pairs = grams[:-width] * (len(grams) + width) + grams[width:]
    return np.unique(pairs, return_inverse=True)[1]


def seeds(grams: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and lags in [low, high) of pairs of equal k-grams that may start a run."""
    n = len(grams)
    key = grams * n + np.arange(n)
    order = np.argsort(key)  # occurrences of each k-gram together, in order
    gram, key = grams[order], key[order]
    again = np.flatnonzero(gram[1:] == gram[:-1])
    at, lag = order[again], order[again + 1] - order[again]
    wanted = (lag >= low) & (lag < high)
    # periodic k-grams: the first occurrence that isn't a plain repetition of the period
    inner = again[lag <= k // 2]
    period = order[inner + 1] - order[inner]
    far = np.searchsorted(key, key[inner] + k - period, side="right")
    there = far < n
    inner, far, period = inner[there], far[there], period[there]
    jump = order[far] - order[inner]
    good = (gram[far] == gram[inner]) & (jump >= low) & (jump < high) & (jump % period != 0)
    return np.concatenate([at[wanted], order[inner][good]]), np.concatenate([lag[wanted], jump[good]])


def matches(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of ``a`` and ``b``, read in growing pieces."""
    done, size, end = 0, 64, min(len(a), len(b))
    while done < end:
        differ = a[done : min(end, done + size)] != b[done : min(end, done + size)]
        if differ.any():
            return done + int(differ.argmax())
        done, size = done + size, size * 4
    return end


def smallest(words: np.ndarray, start: int, q: int) -> bool:
    """Whether no divisor of ``q`` is a period too. (Over two periods long, only divisors can be.)"""
    unit, rest, f = words[start : start + q], q, 2
    while rest > 1:
        if rest % f == 0:
            if np.array_equal(unit, np.roll(unit, q // f)):
                return False
            while rest % f == 0:
                rest //= f
        f = f + 1 if f * f <= rest else max(rest, f + 1)
    return True


def extend(words: np.ndarray, at: np.ndarray, lag: np.ndarray) -> list[Run]:
    """The runs around the seeds, each once."""
    found = []
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    lags, first = np.unique(lag, return_index=True)
    for q, lo, hi in zip(lags.tolist(), first.tolist(), [*first[1:].tolist(), len(at)]):
        covered, k = 0, lo  # on this lag, all matches before ``covered`` are known
        while k < hi:
            i = int(at[k])
            back = matches(words[covered:i][::-1], words[covered + q : i + q][::-1])
            end = i + matches(words[i:], words[i + q :])
            start, covered = i - back, end
            length = end + q - start
            if length >= max(MIN_LENGTH, MIN_PERIODS * q) and smallest(words, start, q):
                found.append(Run(start, length, q))
            k = lo + int(np.searchsorted(at[lo:hi], end))
    return found


def runs_of(words: np.ndarray) -> list[Run]:
    """All runs, by start, then period."""
    n = len(words)
    found: list[Run] = []
    grams, k = words, 1
    low, high = 1, FIRST_K
    while MIN_PERIODS * low <= n and len(grams) and int(grams.max()) + 1 < len(grams):  # some k-gram occurs twice
        if k >= FIRST_K:
            found += extend(words, *seeds(grams, k, low, high))
            low, high = high, 2 * high
        if len(grams) <= k:
            break
        grams, k = paired(grams, k), 2 * k
    return sorted(found, key=lambda r: (r.start, r.period))


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those after the first period of any run go."""
    edge = np.zeros(n + 1, np.int64)
    for r in runs:
        edge[r.start + r.period] += 1
        edge[r.start + r.length] -= 1
    return np.cumsum(edge[:n]) == 0


def best(runs: list[Run]) -> Run | None:
    """Greatest exponent; of equals the smallest start, then period."""
    top = None
    for r in runs:  # sorted, so the first of equals stays
        if top is None or r.length * top.period > top.length * r.period:
            top = r
    return top


COLUMNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prepare=None,
) -> DataFrame:
    """``doc_id``, the number of runs, the one of greatest exponent, and digests of all
    runs and of the text without repetitions.

    ``prepare(id, words)`` may replace a text's words before the search.
    """
    own = pa.schema(
        [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")),
         ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
    )

    def one(doc, text):
        words = utf8(text).split()
        if prepare:
            words = prepare(doc, words)
        runs = runs_of(numbered(words))
        top = best(runs)
        stay = [w for w, k in zip(words, kept(len(words), runs)) if k] if runs else words
        listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
        shown = (top.start, top.length, top.period, 1000 * top.length // top.period) if top else (None,) * 4
        return doc, len(runs), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(stay)).hexdigest()

    return scan(docs, [id_col, text_col], row_step(lambda: one, own), COLUMNS)


def run_list(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: ``doc_id, start, length, period``."""
    own = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def step(batches):
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [(doc, *r) for r in runs_of(numbered(utf8(text).split()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=own)

    return scan(docs, [id_col, text_col], step, "doc_id long, start long, length long, period long")
