"""Deterministic event generators, written as column expressions.

* :func:`from_counter` turns ``(value, timestamp)`` counter rows - a ``rate``
  stream, ``spark.range`` or any id/time projection of a table - into
  financing events with pure arithmetic on the counter.
* :func:`contract_events` draws contract-shaped events (four vehicles, four
  locations, three statuses, a share of negative amounts) from digests of
  each row's key. Every draw depends on that key alone, so the output does
  not depend on partitioning, task retries or executor count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import schemas
from stratum.functions.normalize import zero_padded
from stratum.sources.tables import LOCATIONS, PRODUCER_STATUSES, VEHICLES, pick

# --- Fixed values of the counter generator ----------------------------------
COUNTER_BRANDS = {"CAR": ("Toyota", "Corolla XEi"), "MOTORCYCLE": ("Honda", "CG 160 Titan")}
COUNTER_SEGMENTS = ("premium", "standard", "mass_market")
COUNTER_ID_DIGITS = 10             # FIN- + counter, zero-padded (longer numbers keep all their digits)
COUNTER_CUSTOMER_MODULUS = 100000000
COUNTER_CUSTOMER_DIGITS = 8        # CUS- + counter % modulus, zero-padded
COUNTER_YEAR = (2024, 3)           # (base, span): base + pmod(counter, span)
COUNTER_FINANCED = (15000, 120000)
COUNTER_DOWN = (3000, 20000)
COUNTER_INSTALLMENTS = (24, 37)
COUNTER_MONTHLY = (500, 3000)
COUNTER_RATE_CENTS = (120, 100)    # rate = (base + pmod(counter, span)) / 100
COUNTER_STATUS = "ACTIVE"
COUNTER_CURRENCY = "BRL"
# --- end of fixed values -----------------------------------------------------


def from_counter(rows: DataFrame, value: str = "value", timestamp: str = "timestamp") -> DataFrame:
    """Counter rows -> the 17-column financing event, one projection."""
    v = F.col(value)

    def spread(base_span: tuple[int, int]) -> Column:
        base, span = base_span
        return F.lit(base) + F.pmod(v, F.lit(span))

    is_car = F.pmod(v, F.lit(2)) == 0
    vehicle_type = F.when(is_car, F.lit("CAR")).otherwise(F.lit("MOTORCYCLE"))
    return rows.select(
        F.concat(F.lit("FIN-"), zero_padded(v, COUNTER_ID_DIGITS)).alias("financing_id"),
        F.concat(F.lit("CUS-"), zero_padded(v % COUNTER_CUSTOMER_MODULUS, COUNTER_CUSTOMER_DIGITS)).alias("customer_id"),
        vehicle_type.alias("vehicle_type"),
        F.when(is_car, F.lit(COUNTER_BRANDS["CAR"][0]))
        .otherwise(F.lit(COUNTER_BRANDS["MOTORCYCLE"][0])).alias("vehicle_brand"),
        F.when(is_car, F.lit(COUNTER_BRANDS["CAR"][1]))
        .otherwise(F.lit(COUNTER_BRANDS["MOTORCYCLE"][1])).alias("vehicle_model"),
        spread(COUNTER_YEAR).cast("int").alias("vehicle_year"),
        pick(F.pmod(v, F.lit(len(COUNTER_SEGMENTS))), COUNTER_SEGMENTS).alias("segment"),
        pick(F.pmod(v, F.lit(len(schemas.REGIONS))), schemas.REGIONS).alias("region"),
        spread(COUNTER_FINANCED).cast("double").alias("financed_amount"),
        spread(COUNTER_DOWN).cast("double").alias("down_payment"),
        spread(COUNTER_INSTALLMENTS).cast("int").alias("installment_count"),
        spread(COUNTER_MONTHLY).cast("double").alias("monthly_installment"),
        (spread(COUNTER_RATE_CENTS).cast("double") / 100.0).alias("interest_rate_monthly"),
        F.lit(COUNTER_STATUS).alias("status"),
        F.lit(COUNTER_CURRENCY).alias("currency"),
        F.col(timestamp).alias("created_at"),
        F.col(timestamp).alias("event_time"),
    )


def rate_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Live counter stream (``rate`` source); feed it to :func:`from_counter`."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


# ---------------------------------------------------------------------------
# Contract-shaped events
# ---------------------------------------------------------------------------

# --- Fixed values of the contract-shaped producer (inclusive ranges) --------
CONTRACT_FINANCED_CENTS = (1500000, 15000000)   # 15,000.00 .. 150,000.00
CONTRACT_NEGATIVE_CENTS = (10000, 500000)       # bad rows: -(100.00 .. 5,000.00)
CONTRACT_DOWN_BASIS_POINTS = (2000, 3500)       # down payment = 20% .. 35% of financed
CONTRACT_TERMS = (24, 36, 48, 60)
CONTRACT_RATE_CENTS = (129, 199)                # 1.29 .. 1.99 % a month
CONTRACT_MARKUP = (125, 100)                    # monthly = financed / term * 1.25
CONTRACT_ID_NUMBERS = (10000000, 99999999)      # 8-digit customer and vehicle numbers
CONTRACT_EVENT_DIGITS = 6                       # FIN-<yyyyMMdd>-<key, zero-padded>
CONTRACT_CURRENCY = "BRL"
# --- end of fixed values -----------------------------------------------------


def draw(key: Column, stream: int, seed: int) -> Column:
    """A uniform integer below 2^60 for (key, stream, seed): the first 15 hex digits
    of an MD5 digest, so streams are independent of one another for any key."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(stream)), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def contract_events(
    keys: DataFrame,
    key: str,
    day: str,
    *,
    seed: int = 42,
    bad_percent: int = 5,
) -> DataFrame:
    """One contract-shaped event per row of ``keys``.

    ``key`` is a unique non-negative id, ``day`` a timestamp the event falls
    on (a uniform second of that day is drawn). ``bad_percent`` of the rows get
    a negative financed amount, decided before the instalment is derived,
    so their instalment is negative too.
    """
    if bad_percent < 0 or bad_percent > 100:
        raise ValueError("bad_percent must be within 0..100")
    k = F.col(key)

    def d(stream: int) -> Column:
        return draw(k, stream, seed)

    def uniform(stream: int, low_high: tuple[int, int]) -> Column:
        low, high = low_high
        return F.lit(low) + F.pmod(d(stream), F.lit(high - low + 1))

    veh = F.pmod(d(1), F.lit(len(VEHICLES)))
    loc = F.pmod(d(2), F.lit(len(LOCATIONS)))
    good_cents = uniform(3, CONTRACT_FINANCED_CENTS)
    bad = F.pmod(d(7), F.lit(100)) < bad_percent
    financed_cents = F.when(bad, -uniform(8, CONTRACT_NEGATIVE_CENTS)).otherwise(good_cents)
    down_cents = F.call_function(
        "div", good_cents * uniform(4, CONTRACT_DOWN_BASIS_POINTS) + 5000, F.lit(10000)
    )
    count = pick(F.pmod(d(5), F.lit(len(CONTRACT_TERMS))), CONTRACT_TERMS).cast("int")
    up, down = CONTRACT_MARKUP
    monthly_abs = F.call_function("div", F.abs(financed_cents) * up + count * (down // 2), count * down)
    monthly_cents = F.when(financed_cents < 0, -monthly_abs).otherwise(monthly_abs)
    created = F.timestamp_add("SECOND", F.pmod(d(12), F.lit(86400)), F.col(day))
    return keys.select(
        F.concat(
            F.lit("FIN-"), F.date_format(F.col(day), "yyyyMMdd"), F.lit("-"),
            F.format_string(f"%0{CONTRACT_EVENT_DIGITS}d", k),
        ).alias("financing_id"),
        F.concat(F.lit("CUS-"), uniform(10, CONTRACT_ID_NUMBERS).cast("string")).alias("customer_id"),
        pick(veh, [v[0] for v in VEHICLES]).alias("vehicle_type"),
        F.concat(F.lit("VEH-"), uniform(11, CONTRACT_ID_NUMBERS).cast("string")).alias("vehicle_id"),
        pick(veh, [v[1] for v in VEHICLES]).alias("vehicle_brand"),
        pick(veh, [v[2] for v in VEHICLES]).alias("vehicle_model"),
        pick(veh, [v[3] for v in VEHICLES]).cast("int").alias("vehicle_year"),
        pick(veh, [v[4] for v in VEHICLES]).alias("segment"),
        pick(loc, [v[0] for v in LOCATIONS]).alias("region"),
        pick(loc, [v[1] for v in LOCATIONS]).alias("state"),
        pick(loc, [v[2] for v in LOCATIONS]).alias("city"),
        (financed_cents.cast("double") / 100.0).alias("financed_amount"),
        (down_cents.cast("double") / 100.0).alias("down_payment"),
        count.alias("installment_count"),
        (monthly_cents.cast("double") / 100.0).alias("monthly_installment"),
        (uniform(6, CONTRACT_RATE_CENTS).cast("double") / 100.0).alias("interest_rate_monthly"),
        pick(F.pmod(d(9), F.lit(len(PRODUCER_STATUSES))), PRODUCER_STATUSES).alias("status"),
        F.lit(CONTRACT_CURRENCY).alias("currency"),
        created.alias("created_at"),
    )


def contract_events_for_range(spark: SparkSession, n: int, day: str, *, seed: int = 42,
                              bad_percent: int = 5) -> DataFrame:
    """``n`` contract-shaped events with ids ``1..n`` on ``day`` (landing-file producer)."""
    if n <= 0:
        raise ValueError("the number of events must be positive")
    keys = spark.range(1, n + 1).select(
        F.col("id").alias("event_key"), F.lit(day).cast("timestamp_ntz").alias("event_day")
    )
    return contract_events(keys, "event_key", "event_day", seed=seed, bad_percent=bad_percent)
