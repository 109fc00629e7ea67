"""Session construction and shared scratch locations.

The caller owns the session. Jobs only read two things from it: the session
time zone (pinned to UTC by :func:`build_session`) and the shared checkpoint
folder named by ``spark.checkpoint.dir``, under which every intermediate
table and stream checkpoint of a run is written. A machine-local temporary
folder is used only when the setting is absent (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Window state is bounded by the watermark (only windows not yet closed are
# kept), so the default state store suffices; pass these via ``conf`` when a
# job keeps many open (window, dimension) groups.
ROCKSDB_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "stratum",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC, AQE and no UI; shuffle width is left to the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Window bounds and timestamp casts are defined in UTC throughout."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_LOCAL_FALLBACK: dict[int, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application folder; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: jobs need a shared folder every executor can "
            "reach for stream checkpoints and intermediate tables"
        )
    key = id(sc)
    if key not in _LOCAL_FALLBACK:
        path = tempfile.mkdtemp(prefix="stratum-")
        sc.setCheckpointDir(path)
        _LOCAL_FALLBACK[key] = path
    return _LOCAL_FALLBACK[key]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared root for one run."""
    return f"{shared_root(spark)}/stratum/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, uri: str):
    jvm = spark._jvm  # noqa: SLF001 - classic (non-Connect) sessions only
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


# A storage error raises in all of these: it must never read as "missing".

def ensure_dir(spark: SparkSession, uri: str) -> None:
    """Create a directory through the Hadoop file system, so URIs work too."""
    path, fs = _fs(spark, uri)
    fs.mkdirs(path)


def path_exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _fs(spark, uri)
    return bool(fs.exists(path))


def is_dir(spark: SparkSession, uri: str) -> bool:
    path, fs = _fs(spark, uri)
    return bool(fs.exists(path) and fs.getFileStatus(path).isDirectory())


def list_dirs(spark: SparkSession, uri: str) -> list[str]:
    """Names of the sub-directories of ``uri`` (empty if it does not exist)."""
    path, fs = _fs(spark, uri)
    if not fs.exists(path):
        return []
    return [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]


def list_files(spark: SparkSession, uri: str) -> list[str]:
    """Names of the files in ``uri`` (empty if it does not exist)."""
    path, fs = _fs(spark, uri)
    if not fs.exists(path):
        return []
    return [st.getPath().getName() for st in fs.listStatus(path) if st.isFile()]


def create_file(spark: SparkSession, uri: str, text: str) -> None:
    """Write a small file; raises if there is one already."""
    path, fs = _fs(spark, uri)
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_file(spark: SparkSession, uri: str) -> str:
    path, fs = _fs(spark, uri)
    data = fs.open(path)
    try:
        return bytes(data.readAllBytes()).decode("utf-8", "replace")
    finally:
        data.close()


def delete_path(spark: SparkSession, uri: str) -> bool:
    """Recursively delete ``uri`` through the Hadoop file system."""
    path, fs = _fs(spark, uri)
    return bool(fs.delete(path, True))
