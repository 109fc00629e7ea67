"""SQL twins of the file and stream based queries.

Streams with a watermark emit a window in append mode once
``window_end <= max(event_time) - delay``; with all input in one micro-batch
(single-file tables, available-now) that is exactly the closed-window filter
below.
"""

from __future__ import annotations

from stratum import schemas
from stratum.plans import catalog as C
from stratum.plans import catalog_io as IO
from stratum.plans.oracle import (
    FIN_COLS,
    base_ctes,
    category_select,
    counter_select,
    double_avg,
    double_sum,
    exact_avg,
    exact_sum,
    fin_sql,
    gold_select,
    half_up,
    seconds,
    with_base,
)

GOLD_COLS = ", ".join(schemas.GOLD_COLUMNS)
GOLD_KEY = ", ".join(schemas.GOLD_KEY)
BRONZE_COLS = list(schemas.FINANCING_COLUMNS) + ["source_file", "ingestion_time", "_corrupt_record"]
QUARANTINE_COLS = BRONZE_COLS + ["validation_reason"]


def closed(src_sql: str, time_col: str, src_table: str) -> str:
    delay = seconds(C.WATERMARK)
    return (
        f"SELECT * FROM ({src_sql}) WHERE window_end <= "
        f"(SELECT max({time_col}) FROM {src_table}) - to_seconds({delay})"
    )


def gold_cte() -> str:
    return f"WITH {base_ctes()},\ngold AS ({gold_select('silver', C.GOLD_WINDOW)})\n"


def oracle_sql() -> dict[str, str]:
    fin_all = f"SELECT {FIN_COLS} FROM ({fin_sql()})"
    g = gold_cte()
    summary_cols = (
        "region, vehicle_type, segment, CAST(sum(financing_count) AS BIGINT) AS financing_count, "
        f"{exact_sum('total_financed_amount')} AS total_financed_amount"
    )
    counter = counter_select("event_id", "ts", "events")
    not_pending = "(SELECT * FROM silver WHERE status <> 'PENDING_APPROVAL')"
    upsert = (
        f"WITH {base_ctes()},\n"
        f"a AS (SELECT * FROM ({gold_select(not_pending, C.GOLD_WINDOW)})"
        f" WHERE window_start < TIMESTAMP '{IO.UPSERT_A_BEFORE}'),\n"
        f"b AS (SELECT * FROM ({gold_select('silver', C.GOLD_WINDOW)}) WHERE window_start >= TIMESTAMP '{IO.UPSERT_B_FROM}'),\n"
        f"u AS (SELECT *, 1 AS pri FROM b UNION ALL SELECT *, 2 AS pri FROM a)\n"
        f"SELECT {GOLD_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY {GOLD_KEY} ORDER BY pri) AS rn FROM u)"
        f" WHERE rn = 1"
    )
    audit_sql = (
        f"{g}, q AS (SELECT * FROM s_classified WHERE validation_reason IS NOT NULL)\n"
        f"SELECT 'bronze' AS layer, count(*) AS row_count, {len(BRONZE_COLS)} AS column_count,"
        f" '{','.join(BRONZE_COLS)}' AS columns FROM fin\n"
        f"UNION ALL SELECT 'silver', count(*), {len(schemas.FINANCING_COLUMNS)}, '{','.join(schemas.FINANCING_COLUMNS)}' FROM silver\n"
        f"UNION ALL SELECT 'quarantine', count(*), {len(QUARANTINE_COLS)}, '{','.join(QUARANTINE_COLS)}' FROM q\n"
        f"UNION ALL SELECT 'gold', count(*), {len(schemas.GOLD_COLUMNS)}, '{','.join(schemas.GOLD_COLUMNS)}' FROM gold\n"
        f"UNION ALL SELECT 'reconcile:bronze-silver-quarantine',"
        f" (SELECT count(*) FROM fin) - (SELECT count(*) FROM silver) - (SELECT count(*) FROM q), 0, ''\n"
        f"UNION ALL SELECT 'reconcile:silver_ids-gold_count',"
        f" (SELECT count(financing_id) FROM silver) - (SELECT CAST(coalesce(sum(financing_count), 0) AS BIGINT) FROM gold), 0, ''"
    )
    def placed(order: str) -> str:
        terms = [f"{t} NULLS LAST" if t.endswith(" DESC") else f"{t} NULLS FIRST" for t in order.split(", ")]
        return f"row_number() OVER (ORDER BY {', '.join(terms)}) AS position"

    summary_sql = (
        f"SELECT {summary_cols}, {exact_avg('average_monthly_installment', 2)} AS avg_installment FROM gold GROUP BY ALL"
    )
    return {
        "report_summary_positions": g + (
            f"SELECT *, {placed('total_financed_amount DESC, region, vehicle_type, segment')} FROM ({summary_sql})"
        ),
        "report_windows_positions": g + (
            "SELECT window_start, window_end, vehicle_model, financing_count, total_financed_amount, "
            + placed("window_start, total_financed_amount DESC, segment, region, vehicle_type, vehicle_brand, vehicle_model")
            + " FROM gold"
        ),
        "gold_positions": g + (
            f"SELECT *, {placed('window_start, region, vehicle_type, segment, vehicle_brand, vehicle_model')} FROM gold"
        ),
        "bronze_ingest": fin_all,
        "bronze_incremental": fin_all,
        "jsonl_line_count": "SELECT count(*) AS line_count FROM orders",
        "contract_raw_violations": (
            "SELECT 'VEH-' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS vehicle_id, concat_ws(',', "
            "CASE WHEN o_orderkey % 50 = 24 THEN 'additional:promo_code' END, "
            "CASE WHEN o_orderkey % 50 = 25 THEN 'format:created_at' END) AS raw_violation_text FROM orders"
        ),
        "silver_stream": with_base("SELECT * FROM silver"),
        "quarantine": with_base(f"SELECT {FIN_COLS}, validation_reason FROM s_classified WHERE validation_reason IS NOT NULL"),
        "gold_stream_closed": with_base(closed(gold_select("silver", C.GOLD_WINDOW), "created_at", "silver")),
        "gold_closed_windows": with_base(closed(gold_select("silver", C.GOLD_WINDOW), "created_at", "silver")),
        "gold_snapshot": g + "SELECT * FROM gold",
        "medallion_chain": g + "SELECT * FROM gold",
        "gold_incremental": g + "SELECT * FROM gold",
        "layer_audit": audit_sql,
        "layer_reconcile": g + (
            "SELECT 'bronze-silver' AS \"check\", count(*) AS row_count, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS extra FROM s_classified\n"
            "UNION ALL SELECT 'silver-gold', count(*), 0, 0 FROM gold"
        ),
        "gold_upsert": upsert,
        "report_summary": g + summary_sql,
        "report_summary_totals": g + f"SELECT {summary_cols} FROM gold GROUP BY ALL",
        "report_summary_raw_total": (
            f"WITH {base_ctes()},\ngold AS ({gold_select('silver', C.GOLD_WINDOW, 'double')})\n"
            "SELECT region, vehicle_type, segment, CAST(sum(financing_count) AS BIGINT) AS financing_count, "
            f"{double_sum('total_financed_amount')} AS total_financed_amount, "
            f"{half_up(double_avg('average_monthly_installment'), 2)} AS avg_installment FROM gold GROUP BY ALL"
        ),
        "report_summary_weighted": with_base(
            "SELECT region, vehicle_type, segment, count(financing_id) AS financing_count, "
            f"{exact_sum('financed_amount')} AS total_financed_amount, "
            f"{exact_avg('monthly_installment', 2)} AS avg_installment FROM silver GROUP BY ALL"
        ),
        "report_windows": g + (
            "SELECT window_start, window_end, vehicle_model, financing_count, total_financed_amount FROM gold"
        ),
        "gold_ordered": g + "SELECT * FROM gold",
        "gold_row_count": g + "SELECT count(*) AS row_count FROM gold",
        "category_summary_stream": closed(
            category_select("events", "ts", "event_type", "value", C.CATEGORY_WINDOW), "ts", "events"),
        "valid_partitioned": counter,
        "fanout_summary": closed(
            category_select(f"({counter})", "event_time", "segment", "financed_amount", C.CATEGORY_WINDOW),
            "ts", "events"),
    }
