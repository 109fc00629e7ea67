"""Batch readers over the given Parquet tables and projections derived from them.

Every projection here is a narrow ``select`` over a single scan, so Catalyst
prunes the Parquet read to the referenced columns and pushes any later filter
on them into the scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.normalize import zero_padded


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if spread else df


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has task slots.

    A Parquet file splits only at row-group boundaries, so a small table
    written as one row group is read by one task and every narrow operator
    after it (rule chains, generators, JSON landing) runs on one core. Only
    then is a round-robin exchange added; a large table already has at least
    one split per slot and is left untouched (no shuffle). Column pruning
    and filter pushdown still reach the scan below the exchange.
    """
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - sessions without RDD access (Spark Connect)
        return df
    return df.repartition(slots) if splits < slots else df


def transactions(events: DataFrame) -> DataFrame:
    """The generic transaction shape over ``events``: id, time, category, amount."""
    return events.select(
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amount"),
    )


def counter_rows(events: DataFrame) -> DataFrame:
    """``(value, timestamp)`` counter rows - the rate-source shape - from ``events``."""
    return events.select(
        F.col("event_id").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# --- Fixed values: contract-shaped vehicles and locations -------------------
# (vehicle_type, vehicle_brand, vehicle_model, vehicle_year, segment)
VEHICLES = (
    ("CAR", "Toyota", "Corolla XEi", 2025, "premium"),
    ("MOTORCYCLE", "Honda", "CG 160 Titan", 2026, "mass_market"),
    ("CAR", "Volkswagen", "T-Cross Comfortline", 2024, "standard"),
    ("MOTORCYCLE", "Yamaha", "Fazer FZ25", 2025, "mass_market"),
)
# (region, state, city)
LOCATIONS = (
    ("SOUTHEAST", "SP", "Sao Paulo"),
    ("SOUTHEAST", "SP", "Campinas"),
    ("SOUTH", "PR", "Curitiba"),
    ("NORTHEAST", "BA", "Salvador"),
)
PRODUCER_STATUSES = ("APPROVED", "ACTIVE", "PENDING_APPROVAL")
# --- end of fixed values -----------------------------------------------------


def pick(index: Column, values) -> Column:
    """``values[index]`` for a small literal list, as a CASE over the index."""
    expr = F.when(index == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(index == i, F.lit(v))
    return expr


def cents(c: Column) -> Column:
    """Integer cents of a two-decimal double (exact for |x| < 2^53 / 100)."""
    return F.round(c * 100).cast("long")


def financing(orders: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """Financing events derived from ``orders``, with deterministic dirt.

    Clean values come from the order (id, customer, price, date); the vehicle
    and location are picked by ``o_custkey`` and the status/term by
    ``o_orderkey``. Keys whose ``o_orderkey % 50`` hits one of the dirt slots
    get a padded, mis-cased, null, out-of-domain, non-positive or three-decimal
    value, so every quality rule has rows to reject. All arithmetic is on integer cents, so the
    same projection written in SQL yields identical doubles.
    """
    k = F.col("o_orderkey")
    slot = F.pmod(k, F.lit(50))
    veh = F.pmod(F.col("o_custkey"), F.lit(len(VEHICLES)))
    loc = F.pmod(F.col("o_custkey"), F.lit(len(LOCATIONS)))
    term = (F.lit(24) + F.pmod(k, F.lit(4)) * 12).cast("int")
    price_cents = cents(F.col("o_totalprice"))
    monthly_cents = F.call_function(
        "div", price_cents * 125 + term * 50, term * 100
    )

    def dirt(clean: Column, *cases) -> Column:
        expr = None
        for s, value in cases:
            cond = slot == s
            expr = F.when(cond, value) if expr is None else expr.when(cond, value)
        return expr.otherwise(clean)

    null_s = F.lit(None).cast("string")
    down = F.call_function("div", price_cents * 2 + 5, F.lit(10)).cast("double") / 100.0
    vehicle_type = pick(veh, [v[0] for v in VEHICLES])
    financed = F.col("o_totalprice")
    return orders.select(
        dirt(F.concat(F.lit("FIN-"), zero_padded(k, 10)),
             (1, null_s)).alias("financing_id"),
        F.concat(F.lit("CUS-"), zero_padded(F.col("o_custkey"), 8)).alias("customer_id"),
        dirt(vehicle_type, (2, F.lit(" car ")), (3, F.lit("TRUCK")), (4, null_s),
             (5, F.lit("\tCAR"))).alias("vehicle_type"),
        F.concat(F.lit("VEH-"), zero_padded(k, 8)).alias("vehicle_id"),
        pick(veh, [v[1] for v in VEHICLES]).alias("vehicle_brand"),
        pick(veh, [v[2] for v in VEHICLES]).alias("vehicle_model"),
        dirt(pick(veh, [v[3] for v in VEHICLES]), (6, F.lit(1999))).cast("int").alias("vehicle_year"),
        dirt(pick(veh, [v[4] for v in VEHICLES]), (7, F.lit(" Premium "))).alias("segment"),
        dirt(pick(loc, [v[0] for v in LOCATIONS]), (8, F.lit("SP")), (9, F.lit(" south ")),
             (10, null_s), (11, F.lit(""))).alias("region"),
        dirt(pick(loc, [v[1] for v in LOCATIONS]), (12, F.lit("sp"))).alias("state"),
        pick(loc, [v[2] for v in LOCATIONS]).alias("city"),
        dirt(financed, (13, F.lit(None).cast("double")), (14, F.lit(0.0)),
             (15, -financed)).alias("financed_amount"),
        dirt(down, (23, down + 0.005)).alias("down_payment"),
        term.alias("installment_count"),
        dirt(monthly_cents.cast("double") / 100.0, (16, F.lit(0.0)),
             (17, F.lit(None).cast("double"))).alias("monthly_installment"),
        ((F.lit(129) + F.pmod(k, F.lit(71))).cast("double") / 100.0).alias("interest_rate_monthly"),
        dirt(pick(F.pmod(k, F.lit(3)), PRODUCER_STATUSES), (18, F.lit("FOO")),
             (19, F.lit(" active ")), (20, null_s)).alias("status"),
        dirt(F.lit("BRL"), (21, F.lit("brl"))).alias("currency"),
        dirt(F.col("o_orderdate"), (22, F.lit(None).cast("timestamp_ntz"))).alias("created_at"),
        *extra,
    )


def financing_landing(orders: DataFrame) -> DataFrame:
    """:func:`financing` as landing records with raw-text dirt.

    ``created_at`` is written as RFC 3339 text, except on slot 25, which gets
    a day/month/year text a typed reader cannot parse; slot 24 rows carry a
    ``promo_code`` key the contract does not declare (null fields are not
    written, so other rows have no such key).
    """
    slot = F.pmod(F.col("o_orderkey"), F.lit(50))
    fin = financing(orders, extra=[F.when(slot == 24, F.lit("X24")).alias("promo_code"),
                                   slot.alias("__slot")])
    created = F.when(F.col("__slot") == 25, F.date_format("created_at", "dd/MM/yyyy")).otherwise(
        F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    )
    return fin.withColumn("created_at", created).drop("__slot")
