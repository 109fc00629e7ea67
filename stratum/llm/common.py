"""Helpers shared by the operators: table access, tokens, hashes, batch scans."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed 64-bit odd multipliers of the mixing function below.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, which is exactly this
    definition; other Unicode spaces and capitals stay inside the words.
    """
    return utf8(text).lower().split()


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bijection on uint64 (xor-shift-multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(27))
    h = h * MIX_B
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, remembered for at most ``limit`` words at a time."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scan(
    df: DataFrame,
    columns: list[str],
    step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Arrow-batched pass over the named columns alone; other columns never travel."""
    return df.select(*[df[c] for c in columns]).mapInArrow(step, schema)


def row_step(make: Callable[[], Callable[..., tuple]], schema: pa.Schema):
    """A scan step from a per-row helper; ``make`` builds the helper once per task."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            rows = [one(*values) for values in zip(*(c.to_pylist() for c in batch.columns))]
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return step


def where_text(df: DataFrame, text_col: str, judge: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text ``judge`` keeps, row by row: the text alone goes to Python,
    and no id takes part."""

    @F.arrow_udf("boolean")
    def kept(texts: pa.Array) -> pa.Array:
        found: list[bool] = []
        for at in range(0, len(texts), 256):
            found += judge(texts.slice(at, 256).to_pylist())
        return pa.array(found, pa.bool_())

    return df.where(kept(df[text_col]))


#: Ids that are broadcast at most (8 bytes each); more are joined by shuffling.
BROADCAST_IDS = 1_000_000


def by_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str, stored: bool = False) -> DataFrame:
    """The rows whose id is (``left_semi``) or isn't (``left_anti``) among ``ids``.

    Up to ``BROADCAST_IDS`` ids go to the tasks, so the texts stay where they are;
    beyond that both sides are shuffled by id. Null ids are in no list. ``stored`` says
    that ids come from tables that are written already: they are read from there, once
    to count and once to join, and no further files are written.
    """
    ids = ids.toDF(id_col).distinct()
    if not stored:
        ids = ids.checkpoint()
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, id_col, how).select(*docs.columns)


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark's cleaner delete the shuffle files of finished steps now: it acts
    when the driver collects garbage, which a quiet driver seldom does by itself.
    Files that a live DataFrame can still ask for stay."""
    gc.collect()  # Python's handles first, they keep the plans alive
    spark.sparkContext._jvm.System.gc()  # noqa: SLF001


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For local sessions started from another folder; on a cluster the package is
    shipped with ``--py-files`` and the extra path simply doesn't exist there.
    """
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
