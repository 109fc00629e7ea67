"""Line dedup over levelled sorted runs of line hashes (DataFrame operations only).

A line's key is the line without the ASCII white space at its ends, A-Z
lower-cased; keys of fewer than ``min_chars`` code points are left alone. The
store holds runs: Parquet files of (128-bit key hash, number of documents,
keeper), bucketed and sorted by hash. Batches arrive from the largest ids down. A new batch is
reduced to its own distinct keys, merge-anti-joined with the runs to find the keys
not seen before (their keeper is their largest id in this batch, as no larger id
can follow), and written as a run of level 0. When a level has ``fanout`` runs
they are merged into one of the next level and deleted; reading merges what is
there. A key in ``min_docs`` or more documents loses its lines except in its keeper.

Counting is partial before every shuffle, so a line that a third of all documents
share moves as one row a task; the last join is salted by id for the same lines.

Defined results: null or empty text is one empty line; rows that repeat an id are
documents of their own, and all rows with the keeper's id keep the line; a null id
is smaller than any id; extra columns are ignored; an empty table gives an empty
result. Whole texts are split; every line of a document with a key counts once.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import delete_path, ensure_dir, list_dirs, path_exists, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENDS = " \t\n\r\x0b\x0c"
RUN = "h1 long, h2 long, n_docs long, keeper long"
#: Parts that the lines of one hot key are spread over in the last join.
SALTS = 8


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(ENDS))
    # lower() knows all of Unicode, so it serves lines of ASCII only (and is much faster there)
    ascii_only = F.octet_length(line) == F.length(line)
    return F.when(ascii_only, F.lower(trimmed)).otherwise(F.translate(trimmed, UPPER, LOWER))


def key_hash(line: Column) -> Column:
    """128 bits: the second hash starts from another seed than the first."""
    key = line_key(line)
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def key_hashes(text: Column, min_chars: int) -> Column:
    """Distinct hashes of a text's keys that are long enough."""
    # a key is no longer than its line, so most short lines are skipped unread
    long = F.filter(lines(text), lambda x: (F.length(x) >= min_chars) & (F.length(F.btrim(x, F.lit(ENDS))) >= min_chars))
    return F.array_distinct(F.transform(long, key_hash))


class LineRuns:
    """The levelled store under a folder; what it holds is read from there.

    A run is the folder ``level=<l>/run=<k>[-of-<k>.<k>...]``: its number, and for a
    merged run the numbers of those that it replaces. It counts once Spark's job has
    marked it whole, and from then on those it names count no more, so a store is right
    after a crash at any step and can be opened by a later session. All runs are
    bucketed by the hash alike: a batch is shuffled once and meets each run where it is.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = 3, min_chars: int = 40, buckets: int = 0):
        self.spark, self.fanout, self.min_chars = spark, fanout, min_chars
        self.root = root or scratch(spark, "line-runs")
        made = next((int(n.split("=")[1]) for n in list_dirs(spark, self.root) if n.startswith("buckets=")), 0)
        self.buckets = made or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not made:
            ensure_dir(spark, f"{self.root}/buckets={self.buckets}")

    def _whole(self) -> tuple[list[tuple[int, str, str]], set[int]]:
        """(level, name, path) of the finished runs, and the numbers that a merged one replaces."""
        whole = [
            (int(level.split("=")[1]), name, f"{self.root}/{level}/{name}")
            for level in list_dirs(self.spark, self.root) if level.startswith("level=")
            for name in list_dirs(self.spark, f"{self.root}/{level}")
            if path_exists(self.spark, f"{self.root}/{level}/{name}/_SUCCESS")
        ]
        return whole, {int(k) for _, name, _ in whole for k in name.partition("-of-")[2].split(".") if k}

    @property
    def levels(self) -> list[list[str]]:
        """Paths of the runs that count, by level."""
        whole, gone = self._whole()
        out: list[list[str]] = [[] for _ in range(max((x[0] for x in whole), default=-1) + 1)]
        for level, name, path in sorted(whole, key=lambda x: number(x[1])):
            if number(name) not in gone:
                out[level].append(path)
        return out

    def sweep(self) -> None:
        """Delete replaced runs that a crash left: before the run that names them goes."""
        whole, gone = self._whole()
        for _, name, path in whole:
            if number(name) in gone:
                delete_path(self.spark, path)

    def _next(self) -> int:
        """A number that no run has, whole or not."""
        names = [n for level in list_dirs(self.spark, self.root) if level.startswith("level=") for n in list_dirs(self.spark, f"{self.root}/{level}")]
        return max(map(number, names), default=-1) + 1

    def _write(self, run: DataFrame, level: int, replaced: list[str] = []) -> None:  # noqa: B006 - only read
        of = "-of-" + ".".join(str(number(p.rsplit("/", 1)[1])) for p in replaced) if replaced else ""
        path = f"{self.root}/level={level}/run={self._next()}{of}"
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        dealt = run.select("h1", "h2", "n_docs", "keeper").repartition(self.buckets, "h1", "h2")
        dealt.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet").option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name only; the files are the store's

    def read(self, path: str) -> DataFrame:
        """A run, known to Spark as bucketed until :meth:`forget`."""
        name = table_name(path)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (h1 BIGINT, h2 BIGINT, n_docs BIGINT, keeper BIGINT) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(name)

    def forget(self, paths: list[str]) -> None:
        """Take the runs' names out of the catalog; their files stay."""
        for path in paths:
            self.spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")

    def _read(self, paths: list[str]) -> DataFrame:
        """Several runs as plain files: Spark 4.1 adds up a union of bucketed tables
        without an exchange, but then misses keys that are in several."""
        return self.spark.read.schema(RUN).parquet(*paths) if paths else self.spark.createDataFrame([], RUN)

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def unseen(self, keys: DataFrame, paths: list[str]) -> DataFrame:
        """``keys`` that no run has: one anti-join a run, on the buckets as they lie."""
        for path in paths:
            keys = keys.join(self.read(path).select("h1", "h2"), ["h1", "h2"], "left_anti")
        return keys

    def ingest(self, docs: DataFrame) -> None:
        """Add a batch (``id``, ``text``) whose ids are all smaller than those before."""
        keys = (
            docs.select("id", F.explode(key_hashes(F.col("text"), self.min_chars)).alias("k"))
            .groupBy("k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        )
        if paths := self.paths():
            keys = keys.checkpoint()
            fresh = self.unseen(keys, paths).checkpoint()
            self.forget(paths)
            again = keys.join(fresh.select("h1", "h2"), ["h1", "h2"], "left_anti").withColumn("keeper", F.lit(None).cast("long"))
            keys = fresh.unionByName(again)
        self._write(keys, 0)
        self.compact()

    def compact(self) -> None:
        """Merge each full level into one run of the next."""
        self.sweep()
        level = 0
        while level < len(levels := self.levels):
            full = levels[level]
            if len(full) >= self.fanout:
                self._write(merged(self._read(full)), level + 1, full)
                for path in full:
                    delete_path(self.spark, path)
            level += 1

    def counts(self) -> DataFrame:
        """One row per key. A single run needs no merging."""
        paths = self.paths()
        return self._read(paths) if len(paths) == 1 else merged(self._read(paths))


def table_name(path: str) -> str:
    return "line_run_" + hashlib.md5(path.encode()).hexdigest()[:16]


def number(name: str) -> int:
    return int(name.partition("-of-")[0].removeprefix("run="))


def merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def batches_down(docs: DataFrame, count: int) -> list[DataFrame]:
    """The table as ``count`` ranges of its ids, the largest first; null ids in the last."""
    lo, hi = docs.agg(F.min("id"), F.max("id")).first()
    if lo is None:
        return [docs]
    edges = [lo + (hi - lo + 1) * k // count for k in range(count)]
    out, top = [], None
    for edge in reversed(edges):
        low = F.col("id") >= edge if edge > lo else F.lit(True) if top is None else F.col("id").isNull() | (F.col("id") < top)
        out.append(docs.where(low if top is None or edge == lo else low & (F.col("id") < top)))
        top = edge
    return out


def drop_repeated(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 3,
    fanout: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_columns: bool = False,
) -> DataFrame:
    """``doc_id, kept_text, n_lines, n_dropped`` of every row; with ``keep_columns``
    the row's own columns as one struct ``row`` too."""
    whole = F.struct(*[docs[c] for c in docs.columns if c != text_col])
    docs = docs.select(
        docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"), *[whole.alias("row")] * keep_columns
    )
    runs = LineRuns(docs.sparkSession, fanout=fanout, min_chars=min_chars)
    for batch in batches_down(docs, batches):
        runs.ingest(batch)
    hot = runs.counts().where(F.col("n_docs") >= min_docs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    drops = (
        docs.select("id", F.explode(key_hashes(F.col("text"), min_chars)).alias("k"))
        .select("id", "k.h1", "k.h2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(hot, ["h1", "h2", "salt"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id").agg(F.collect_set(F.struct("h1", "h2")).alias("drops"))
    )
    mine = docs.join(drops.withColumnRenamed("id", "drop_id"), F.col("id").eqNullSafe(F.col("drop_id")), "left")
    dropped = lambda x: (F.length(F.btrim(x, F.lit(ENDS))) >= min_chars) & F.array_contains("drops", key_hash(x))
    text = F.coalesce("text", F.lit(""))
    mine = mine.withColumn("left", F.when(F.col("drops").isNotNull(), F.filter(lines(F.col("text")), lambda x: ~dropped(x))))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return mine.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("left").isNull(), text).otherwise(F.array_join("left", "\n")).alias("kept_text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("left").isNull(), 0).otherwise(n_lines - F.size("left")).cast("long").alias("n_dropped"),
        *["row"] * keep_columns,
    )
