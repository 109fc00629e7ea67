"""Keyed SQL warehouse table over JDBC.

Rows never pass through the driver: Spark's JDBC writer inserts from every
task into a staging table, then one ``MERGE`` (upsert) or one
delete-and-insert transaction (reload) moves them into the keyed table, so
readers never observe a truncated table. Null key dimensions are replaced by
a sentinel before loading because a primary key cannot hold ``NULL``.

Only statement text and the staging write run through here; the database is
external and is not started by this library.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from stratum import schemas
from stratum.settings import Settings

NULL_KEY = "UNKNOWN"
# Fixed warehouse precision of the gold measures.
GOLD_DECIMALS = {
    "total_financed_amount": DecimalType(18, 2),
    "average_monthly_installment": DecimalType(18, 2),
    "average_interest_rate_monthly": DecimalType(10, 4),
}
_SQL_TYPES = {
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "string": "VARCHAR(100)",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE PRECISION",
}


def sql_types(schema: StructType, decimals: dict[str, DecimalType]) -> dict[str, str]:
    """Column -> SQL type for a schema record; ``decimals`` pin exact measures."""
    out = {}
    for f in schema.fields:
        if f.name in decimals:
            d = decimals[f.name]
            out[f.name] = f"NUMERIC({d.precision}, {d.scale})"
        else:
            out[f.name] = _SQL_TYPES[f.dataType.simpleString()]
    return out


GOLD_SQL_TYPES = sql_types(schemas.GOLD, GOLD_DECIMALS)


def create_table_sql(table: str, columns: dict[str, str], key: Sequence[str]) -> str:
    body = ",\n  ".join(f"{c} {t}" for c, t in columns.items())
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  {body},\n  PRIMARY KEY ({', '.join(key)})\n)"


def merge_sql(table: str, staging: str, columns: Sequence[str], key: Sequence[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in key)
    updates = ", ".join(f"{c} = s.{c}" for c in columns if c not in key)
    cols = ", ".join(columns)
    vals = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on}\n"
        f"WHEN MATCHED THEN UPDATE SET {updates}\n"
        f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
    )


def reload_sql(table: str, staging: str, columns: Sequence[str]) -> list[str]:
    cols = ", ".join(columns)
    return [f"DELETE FROM {table}", f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}"]


def to_warehouse(gold: DataFrame) -> DataFrame:
    """Gold rows in warehouse types: sentinel for null keys, exact decimals."""
    mapping = {c: F.coalesce(F.col(c), F.lit(NULL_KEY)) for c in schemas.GOLD_DIMENSIONS}
    mapping.update({c: F.col(c).cast(t) for c, t in GOLD_DECIMALS.items()})
    return gold.withColumns(mapping).select(*schemas.GOLD_COLUMNS)


def _execute(spark: SparkSession, settings: Settings, statements: Sequence[str]) -> None:
    """Run statements in one JDBC transaction on the driver (no data rows)."""
    jvm = spark._jvm  # noqa: SLF001
    props = jvm.java.util.Properties()
    for k, v in settings.jdbc_properties().items():
        props.setProperty(k, v)
    if settings.jdbc_driver:
        jvm.java.lang.Class.forName(settings.jdbc_driver)
    conn = jvm.java.sql.DriverManager.getConnection(settings.jdbc_url, props)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        for sql in statements:
            stmt.execute(sql)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def _stage(df: DataFrame, settings: Settings, staging: str) -> None:
    df.write.mode("overwrite").option("batchsize", 10000).jdbc(
        settings.jdbc_url, staging, properties=settings.jdbc_properties()
    )


def ensure_table(spark: SparkSession, settings: Settings) -> None:
    _execute(spark, settings, [create_table_sql(settings.jdbc_table, GOLD_SQL_TYPES, schemas.GOLD_KEY)])


def upsert(spark: SparkSession, gold: DataFrame, settings: Settings, tag: str = "merge") -> None:
    staging = f"{settings.jdbc_table}_stage_{tag}"
    _stage(to_warehouse(gold), settings, staging)
    ensure_table(spark, settings)
    _execute(spark, settings, [
        merge_sql(settings.jdbc_table, staging, schemas.GOLD_COLUMNS, schemas.GOLD_KEY),
        f"DROP TABLE {staging}",
    ])


def reload(spark: SparkSession, gold: DataFrame, settings: Settings) -> None:
    staging = f"{settings.jdbc_table}_stage_reload"
    _stage(to_warehouse(gold), settings, staging)
    ensure_table(spark, settings)
    _execute(spark, settings, reload_sql(settings.jdbc_table, staging, schemas.GOLD_COLUMNS)
             + [f"DROP TABLE {staging}"])


def batch_upsert_sink(settings: Settings) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` hook: merge one micro-batch; a replay re-merges the same rows."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, batch, settings, tag=f"b{batch_id}")

    return sink


def read_table(spark: SparkSession, settings: Settings, predicates: Sequence[str] | None = None) -> DataFrame:
    """Read the warehouse table; ``predicates`` (one per task) parallelise the read."""
    return spark.read.jdbc(settings.jdbc_url, settings.jdbc_table, predicates=predicates,
                           properties=settings.jdbc_properties())
