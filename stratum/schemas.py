"""Declared schemas and the fixed domains of the financing data product.

File sources force every column nullable, so nullness is enforced by the
rule sets in :mod:`stratum.functions.rules`, never by these schemas.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# --- Fixed values (must equal the data product's contract) -----------------
VEHICLE_TYPES = ("CAR", "MOTORCYCLE")
REGIONS = ("NORTH", "NORTHEAST", "MIDWEST", "SOUTHEAST", "SOUTH")
# The transaction validator also accepts the 27 Brazilian state codes as regions.
STATE_CODES = (
    "SP", "RJ", "MG", "ES", "PR", "SC", "RS", "BA", "PE", "CE", "MA", "PI", "RN",
    "PB", "AL", "SE", "PA", "AM", "RO", "AC", "RR", "AP", "TO", "MT", "MS", "GO", "DF",
)
STATUSES = (
    "SIMULATION",
    "PENDING_APPROVAL",
    "APPROVED",
    "ACTIVE",
    "PAID_OFF",
    "CANCELLED",
    "DEFAULTED",
)
SEGMENTS = ("mass_market", "standard", "premium")
CURRENCIES = ("BRL",)

# One financing contract event (the JSON-lines landing record).
FINANCING = StructType([
    StructField("financing_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("vehicle_type", StringType()),
    StructField("vehicle_id", StringType()),
    StructField("vehicle_brand", StringType()),
    StructField("vehicle_model", StringType()),
    StructField("vehicle_year", IntegerType()),
    StructField("segment", StringType()),
    StructField("region", StringType()),
    StructField("state", StringType()),
    StructField("city", StringType()),
    StructField("financed_amount", DoubleType()),
    StructField("down_payment", DoubleType()),
    StructField("installment_count", IntegerType()),
    StructField("monthly_installment", DoubleType()),
    StructField("interest_rate_monthly", DoubleType()),
    StructField("status", StringType()),
    StructField("currency", StringType()),
    StructField("created_at", TimestampType()),
])
# Business dimensions of the gold summary, and gold itself.
GOLD_DIMENSIONS = ("segment", "region", "vehicle_type", "vehicle_brand", "vehicle_model")
GOLD = StructType([
    StructField("window_start", TimestampNTZType()),
    StructField("window_end", TimestampNTZType()),
    *[StructField(c, StringType()) for c in GOLD_DIMENSIONS],
    StructField("financing_count", LongType()),
    StructField("total_financed_amount", DoubleType()),
    StructField("average_monthly_installment", DoubleType()),
    StructField("average_interest_rate_monthly", DoubleType()),
])
# --- end of fixed values ----------------------------------------------------

FINANCING_COLUMNS = tuple(f.name for f in FINANCING.fields)

# Bronze keeps the raw event plus provenance.
BRONZE = StructType([
    *FINANCING.fields,
    StructField("source_file", StringType()),
    StructField("ingestion_time", TimestampType()),
])

# Raw JSON text of lines that did not parse is kept next to the typed columns.
CORRUPT_COLUMN = "_corrupt_record"
BRONZE_COLUMNS = FINANCING_COLUMNS + ("source_file", "ingestion_time", CORRUPT_COLUMN)

# The refined layer keeps accepted and rejected rows side by side, told
# apart by the ``quality`` partition (``valid`` / ``rejected``).
REASON_COLUMN = "validation_reason"
QUALITY_COLUMN = "quality"
QUALITY_VALID = "valid"
QUALITY_REJECTED = "rejected"
REFINED = StructType(
    [*BRONZE.fields, *[StructField(c, StringType()) for c in (CORRUPT_COLUMN, REASON_COLUMN, QUALITY_COLUMN)]]
)
QUARANTINE_COLUMNS = BRONZE_COLUMNS + (REASON_COLUMN,)

# Rows produced by the counter-driven generator (one per counter value).
COUNTER_EVENT_COLUMNS = (
    "financing_id", "customer_id", "vehicle_type", "vehicle_brand", "vehicle_model",
    "vehicle_year", "segment", "region", "financed_amount", "down_payment",
    "installment_count", "monthly_installment", "interest_rate_monthly", "status",
    "currency", "created_at", "event_time",
)

# Gold's primary key.
GOLD_KEY = ("window_start", "window_end") + GOLD_DIMENSIONS
GOLD_PARTITIONS = ("segment", "region", "vehicle_type")
GOLD_COLUMNS = tuple(f.name for f in GOLD.fields)
# Partition columns that gold can be laid out by beside its own columns.
GOLD_DERIVED = StructType([StructField("window_date", DateType(), True)])

# Windows that closed once, beside what came too late for them.
KIND_COLUMN, KIND_CLOSED, KIND_LATE = "kind", "closed", "late"
GOLD_CLOSED = StructType([*GOLD.fields, StructField(KIND_COLUMN, StringType(), True)])

# Window summary of generic transaction events.
CATEGORY_SUMMARY_COLUMNS = (
    "window_start", "window_end", "category", "event_count", "total_amount", "average_amount",
)
