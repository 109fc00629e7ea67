"""Job settings: one frozen record, overridable from the environment.

Every environment variable uses the single prefix ``STRATUM_`` (for example
``STRATUM_WINDOW`` or ``STRATUM_ROWS_PER_SECOND``); the loader is table
driven so a new setting needs one line, and unknown or malformed values fail
loudly instead of being ignored.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace
from typing import Mapping

ENV_PREFIX = "STRATUM_"


@dataclass(frozen=True)
class Layer:
    """One storage layer: where its data lives and where its stream checkpoints."""

    name: str
    path: str
    checkpoint: str


@dataclass(frozen=True)
class Settings:
    """Parameters of the medallion jobs.

    ``root`` is a plain URI (local path, ``hdfs://``, ``s3a://``...); every
    layer and checkpoint location is derived from it unless given explicitly.
    """

    root: str = "data"
    landing: str = ""
    # --- Fixed values: the data product's default job parameters -----------
    rows_per_second: int = 5
    window: str = "10 seconds"
    watermark: str = "30 seconds"
    trigger: str = "5 seconds"
    runtime_seconds: int = 30
    # --- end of fixed values -------------------------------------------------
    # Files per micro-batch for the stateless stages (landing -> bronze ->
    # silver): a backfill commits progress in bounded batches, so a failure
    # only repeats the batch in flight. 0 = no cap.
    max_files_per_trigger: int = 1000
    # Alternative bound in bytes; when non-zero it replaces the file count on
    # those stages (Spark accepts one of the two).
    max_bytes_per_trigger: int = 0
    # Files per micro-batch for the watermarked gold stream, 0 = no cap. Which
    # late rows are dropped depends on batching (a row older than the previous
    # batch's watermark is dropped), so a cap over a backlog drops rows; it is
    # only for live runs whose files arrive in time order.
    gold_max_files_per_trigger: int = 0
    # Partitions of the window state (and its shuffle) of the stateful
    # streams; fixed by a checkpoint's first run. 0 = the session's
    # spark.sql.shuffle.partitions.
    state_partitions: int = 0
    # "default" (in-memory, checkpointed) or "rocksdb" (off-heap, for jobs
    # that keep many open windows); like the width, fixed at the first run.
    state_store: str = "default"
    gold_partitions: tuple[str, ...] = ("segment", "region", "vehicle_type")
    valid_partitions: tuple[str, ...] = ("region",)
    money: str = "exact"                     # "exact" (integer cents) or "double"
    strict_nulls: bool = False               # null dimension values violate rules
    jdbc_url: str = ""
    jdbc_table: str = "vehicle_financing_summary"   # fixed value: the warehouse table name
    jdbc_user: str = ""
    jdbc_password: str = field(default="", repr=False)
    jdbc_driver: str = ""
    s3_endpoint: str = ""
    s3_access_key: str = ""
    s3_secret_key: str = field(default="", repr=False)
    extra: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.state_store not in ("default", "rocksdb"):
            raise ValueError(f"state_store must be 'default' or 'rocksdb', got {self.state_store!r}")
        if self.money not in ("exact", "double"):
            raise ValueError(f"money must be 'exact' or 'double', got {self.money!r}")
        for name in ("rows_per_second", "runtime_seconds"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("max_files_per_trigger", "max_bytes_per_trigger", "gold_max_files_per_trigger",
                     "state_partitions"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must be >= 0")
        for name in ("window", "watermark", "trigger"):
            parts = getattr(self, name).split()
            if len(parts) != 2 or not parts[0].isdigit():
                raise ValueError(f"{name} must look like '10 seconds', got {getattr(self, name)!r}")

    # ---- layers -----------------------------------------------------------
    def _layer(self, name: str) -> Layer:
        root = self.root.rstrip("/")
        return Layer(name, f"{root}/{name}", f"{root}/_checkpoints/{name}")

    @property
    def landing_path(self) -> str:
        return self.landing or f"{self.root.rstrip('/')}/landing"

    @property
    def bronze(self) -> Layer:
        return self._layer("bronze")

    @property
    def silver(self) -> Layer:
        """Refined rows, partitioned by ``quality`` = valid / rejected."""
        return self._layer("silver")

    @property
    def gold_stream(self) -> Layer:
        # The stream's per-batch output is kept apart from the snapshot it
        # would otherwise be overwritten by.
        return self._layer("gold_stream")

    @property
    def gold(self) -> Layer:
        return self._layer("gold")

    @property
    def gold_partials(self) -> Layer:
        """Mergeable per-batch window sums for the incremental snapshot."""
        return self._layer("gold_partials")

    @property
    def gold_partials_base(self) -> str:
        """Compacted partials: ``upto=<n>`` folds every batch up to ``n``."""
        return f"{self.root.rstrip('/')}/gold_partials_base"

    @property
    def gold_closed(self) -> Layer:
        """Closed windows and late partials, partitioned by ``kind`` = closed / late."""
        return self._layer("gold_closed")

    @property
    def classified(self) -> Layer:
        """Counter events of the fan-out, partitioned by ``quality`` = valid / rejected."""
        return self._layer("events")

    @property
    def valid(self) -> Layer:
        return Layer("valid", f"{self.classified.path}/quality=valid", self.classified.checkpoint)

    @property
    def invalid(self) -> Layer:
        return Layer("invalid", f"{self.classified.path}/quality=rejected", self.classified.checkpoint)

    @property
    def summary(self) -> Layer:
        return self._layer("transaction_summary")

    def spark_conf(self) -> dict[str, str]:
        """Object-store settings passed straight through to Hadoop."""
        conf: dict[str, str] = {}
        if self.s3_endpoint:
            conf.update(
                {
                    "spark.hadoop.fs.s3a.endpoint": self.s3_endpoint,
                    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
                    "spark.hadoop.fs.s3a.path.style.access": "true",
                    "spark.hadoop.fs.s3a.connection.ssl.enabled": str(self.s3_endpoint.startswith("https:")).lower(),
                    "spark.hadoop.fs.s3a.aws.credentials.provider":
                        "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
                    "spark.hadoop.fs.s3a.access.key": self.s3_access_key,
                    "spark.hadoop.fs.s3a.secret.key": self.s3_secret_key,
                }
            )
        conf.update(self.extra)
        return conf

    def jdbc_properties(self) -> dict[str, str]:
        props = {"user": self.jdbc_user, "password": self.jdbc_password}
        if self.jdbc_driver:
            props["driver"] = self.jdbc_driver
        return props

    # ---- environment --------------------------------------------------------
    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> "Settings":
        env = os.environ if env is None else env
        base = cls()
        values = {}
        for f in fields(cls):
            if f.name == "extra":
                continue
            key = ENV_PREFIX + f.name.upper()
            if key not in env:
                continue
            values[f.name] = _parse(env[key], getattr(base, f.name), key)
        return replace(base, **values, **overrides)


def _parse(raw: str, default, key: str):
    if isinstance(default, bool):
        low = raw.strip().lower()
        if low not in {"1", "0", "true", "false", "yes", "no"}:
            raise ValueError(f"{key}: expected a boolean, got {raw!r}")
        return low in {"1", "true", "yes"}
    if isinstance(default, int):
        try:
            return int(raw)
        except ValueError as exc:
            raise ValueError(f"{key}: expected an integer, got {raw!r}") from exc
    if isinstance(default, tuple):
        return tuple(p.strip() for p in raw.split(",") if p.strip())
    return raw
