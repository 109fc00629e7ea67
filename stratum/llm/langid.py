"""Language identification by nearest centroids.

A text becomes a vector of its letter n-grams (one to three bytes of the
lower-cased UTF-8 letters, hashed into ``DIMS`` places): (1 + log tf) * idf, of
unit length. Each language has several centroids, found by spherical k-means
among its sampled training vectors; a text gets the language of the centroid
with the largest cosine. A text is marked as rejected if it is farther from its
centroid than that centroid's radius, or if it is farther than nearly all texts of
the language are and another language is nearly as similar (a text in two known
languages is similar to both and stays). The bounds come from held-out similarities:
the sample is cut into ``FOLDS`` parts, and each part is compared with centroids of
its language that were fitted without it. A language of one text has radius 0.

Document frequencies count every training text. The centroids are fitted on a
bounded sample: about ``SAMPLE`` texts a language, chosen by a hash of their id
and content, never more than twice as many; each language is clustered in a task
of its own and only its centroids come to the driver.

Defined results: null text, or text without a letter, gives ``und``, score 0 and
rejected; with no training rows every text is ``und``. Ties go to the first
language in code-point order. Extra columns are ignored; null ids give a row with
a null id; repeated rows give a row each; an empty table gives an empty result.
Whole texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import scan, utf8, where_text

DIMS = 4096
CENTROIDS = 3
#: Training texts that a language's centroids are fitted on, about; at most twice as many.
SAMPLE = 600
#: Parts of the sample that are held out in turn.
FOLDS = 3
#: The share of held-out texts that defines a bound, and how far below their
#: similarity the radius lies: clean texts of unusual kinds are to stay.
LOW, SLACK = 0.01, 0.7
#: Held-out texts of a centroid that a radius of its own needs.
ENOUGH = 50
#: ASCII other than letters becomes a space.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray  # (n, DIMS), unit rows
    radius: np.ndarray  # least similarity that isn't rejected
    rival: np.ndarray  # largest similarity of another language, as a share of the own, that isn't rejected
    idf: np.ndarray


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def term_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text."""
    raw = b" " + b" ".join(utf8(text and text.lower()).translate(LETTERS).split()) + b" "
    total = np.zeros(DIMS, np.int64)
    # long texts in overlapping pieces: bounded memory, the same counts
    for at in range(0, len(raw), 1 << 20):
        b = np.frombuffer(raw[at : at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        two = b[:-1] * np.uint32(257) + b[1:]
        three = two[:-1] * np.uint32(65599) + b[2:]
        own = min(len(b), 1 << 20)
        one = b[:own]
        for k, grams in enumerate((one[one != 32], two[:own], three[:own])):
            places = (grams + np.uint32(k)) * np.uint32(2654435761) >> np.uint32(20)
            total += np.bincount(places, minlength=DIMS)
    return total


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows (a zero row stays zero)."""
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def cluster(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids by spherical k-means from far-apart starts."""
    starts = [int(np.argmin(v @ v.mean(0)))]
    while len(starts) < min(k, len(v)):
        starts.append(int(np.argmin((v @ v[starts].T).max(1))))
    c = v[starts]
    for _ in range(rounds):
        own = (v @ c.T).argmax(1)
        c = np.stack([v[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def rivals(similar: np.ndarray, langs: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The largest similarity to a centroid of another language than ``own`` (0 without one)."""
    return np.where(langs[None, :] == own[:, None], 0.0, similar).max(1, initial=0.0)


def bounds(langs: np.ndarray, measured: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Radius and rival share of each centroid from held-out texts
    (``place`` of the nearest centroid of its language, ``similar``, ``share``)."""
    radius, rival = np.zeros(len(langs)), np.ones(len(langs))
    for j, lang in enumerate(langs):
        of_lang = measured[langs[measured.place] == lang]
        own = of_lang[of_lang.place == j]
        if not len(of_lang):
            continue
        # a centroid of copies alone would reject too much: never above the language's radius
        low = [np.quantile(x.similar, LOW) for x in (of_lang, own) if x is of_lang or len(x) >= ENOUGH]
        radius[j] = SLACK * min(low)
        rival[j] = (1 + min(1.0, np.quantile(of_lang.share, 1 - LOW))) / 2
    return radius, rival


def fit(training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows with a text and a language."""
    rows = training.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())

    def frequencies(batches):
        df: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(text):
                    seen = df.setdefault(lang, np.zeros(DIMS + 1, np.int64))
                    seen[:DIMS] += term_counts(text) > 0
                    seen[DIMS] += 1  # texts
        for lang, seen in df.items():
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())],
                names=["lang", "place", "n"],
            )

    # at most languages * DIMS rows, each summed over all training texts
    found = (
        scan(rows, [text_col, lang_col], frequencies, "lang string, place int, n long")
        .groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    )
    texts = {r.lang: int(r.n) for r in found[found.place == DIMS].itertuples()}
    if not texts:
        return Model([], np.empty((0, DIMS)), np.empty(0), np.empty(0), np.zeros(DIMS))
    df = np.zeros(DIMS)
    np.add.at(df, found.place[found.place < DIMS].to_numpy(), found.n[found.place < DIMS].to_numpy())
    idf = np.log((1 + sum(texts.values())) / (1 + df)) + 1

    ticket = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, n in sorted(texts.items()) for x in (lang, int(min(1.0, SAMPLE / n) * (1 << 30)))])
    sample = rows.where(ticket < share[F.col(lang_col)])

    def vectorised(batches):
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(text):
                    v = vectors(term_counts(text)[None], idf)[0].astype(np.float32)
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([v.tobytes()], pa.binary())], names=["lang", "v"])

    def clustered(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        v = np.stack([np.frombuffer(x, np.float32) for x in sorted(group.v)[: 2 * SAMPLE]]).astype(float)
        fold = np.arange(len(v)) % FOLDS
        every = cluster(v, CENTROIDS)
        order = np.argsort([x.tobytes().hex() for x in every])
        every = every[order]
        near = (v @ every.T).argmax(1)
        similar = np.zeros(len(v))
        for f in range(FOLDS):
            if (fold == f).any() and (fold != f).any():
                similar[fold == f] = (v[fold == f] @ cluster(v[fold != f], CENTROIDS).T).max(1)
        # the measured texts travel with the centroids: at most 2 * SAMPLE a language
        return pd.DataFrame({
            "lang": key[0], "c": [x.tobytes() for x in every] + [None] * len(v), "v": [None] * len(every) + [x.astype(np.float32).tobytes() for x in v],
            "near": [*range(len(every)), *near.tolist()], "similar": [0.0] * len(every) + similar.tolist(),
        })

    fitted = (
        scan(sample, [text_col, lang_col], vectorised, "lang string, v binary")
        .groupBy("lang").applyInPandas(clustered, "lang string, c binary, v binary, near int, similar double").checkpoint()
    )
    cs = fitted.where("c IS NOT NULL").select("lang", "near", "c").toPandas().sort_values(["lang", "near"])
    if not len(cs):
        return Model([], np.empty((0, DIMS)), np.empty(0), np.empty(0), idf)
    langs, centroids = cs.lang.to_numpy(), np.stack([np.frombuffer(x) for x in cs.c])

    def shares(batches):
        """Place of the nearest centroid, similarity, and the rival's share of it."""
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = np.array(batch.column(0).to_pylist(), object)
            v = np.stack([np.frombuffer(x.as_py(), np.float32) for x in batch.column(1)]).astype(float)
            similar = batch.column(3).to_numpy()
            place = np.array([np.flatnonzero(langs == x)[0] for x in lang]) + batch.column(2).to_numpy()
            share = rivals(v @ centroids.T, langs, lang) / np.maximum(similar, 1e-12)
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(similar), pa.array(share)], names=["place", "similar", "share"])

    measured = scan(fitted.where("v IS NOT NULL"), ["lang", "v", "near", "similar"], shares, "place int, similar double, share double").toPandas()
    return Model(langs.tolist(), centroids, *bounds(langs, measured), idf)


def judged(texts: list[str | None], m: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether rejected, of a few texts."""
    known = np.array([bool(m.langs) and has_letter(t) for t in texts], bool)
    best, score, rival = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts))
    if known.any():
        v = vectors(np.stack([term_counts(t) for t, ok in zip(texts, known) if ok]), m.idf)
        similar = v @ m.centroids.T
        best[known] = similar.argmax(1)
        score[known] = np.clip(similar.max(1), 0, 1)
        names = np.array(m.langs, object)
        rival[known] = rivals(similar, names, names[best[known]])
    langs = [m.langs[b] if ok else "und" for b, ok in zip(best, known)]
    rejected = ~known
    if m.langs:
        rejected = rejected | (score < m.radius[best])
        rejected |= (score < m.radius[best] / SLACK) & (rival > m.rival[best] * score)
    return langs, score, rejected


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (the cosine) and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs, score, rejected = judged(part.column(1).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    return scan(docs, [id_col, text_col], step, "doc_id long, lang_pred string, score double, rejected boolean")


def recognised(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose own text isn't rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return where_text(docs, text_col, lambda texts: (~judged(texts, shared.value)[2]).tolist())


def held_out(id_col: str | Column = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))
