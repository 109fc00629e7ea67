"""SQL twins of the registered queries, runnable by DuckDB on the same tables.

The text is generated from the same fixed domain lists the Spark side uses,
so a domain change cannot silently diverge between the two. Money follows
the exact mode: integer cents, half-away-from-zero integer division.
"""

from __future__ import annotations

from stratum import schemas
from stratum.functions.money import LIMB_BITS, LIMB_PLACES
from stratum.functions.rules import (
    CONTRACT_CENTS,
    CONTRACT_ENUMS,
    CONTRACT_MIN_LENGTH,
    CONTRACT_PATTERNS,
    CONTRACT_RANGES,
    contract_document,
)
from stratum.plans import catalog as C
from stratum.sources import synthetic as G
from stratum.sources.tables import LOCATIONS, PRODUCER_STATUSES, VEHICLES


def q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        if v.startswith("\t"):
            return "chr(9) || " + q(v[1:])
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def pick(index: str, values) -> str:
    return "CASE " + index + " " + " ".join(
        f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values)
    ) + " END"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def seconds(duration: str) -> int:
    n, unit = duration.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def bucket(col: str, duration: str) -> tuple[str, str]:
    """Epoch-aligned tumbling window bounds (floor, also before 1970)."""
    w = seconds(duration) * 1_000_000
    us = f"epoch_us({col})"
    start = f"make_timestamp({us} - ((({us} % {w}) + {w}) % {w}))"
    end = f"make_timestamp({us} - ((({us} % {w}) + {w}) % {w}) + {w})"
    return start, end


def exact_sum(col: str, in_scale: int = 2) -> str:
    return f"CAST(sum(CAST(round({col} * {10 ** in_scale}) AS HUGEINT)) AS DOUBLE) / {float(10 ** in_scale)}"


def exact_avg(col: str, scale: int = 2, in_scale: int = 2) -> str:
    s = f"sum(CAST(round({col} * {10 ** in_scale}) AS HUGEINT))"
    n = f"count({col})"
    shift = 10 ** (scale - in_scale)
    return (
        f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((2 * abs({s}) * {shift} + {n}) // (2 * {n})) AS DOUBLE)"
        f" / {float(10 ** scale)} END"
    )


def double_sum(col: str) -> str:
    """Sum of doubles by limbs of 24 bits (twin of ``money``'s double mode)."""
    bits = 2 ** LIMB_BITS
    limbs, carry = [], "0"
    for e in reversed(LIMB_PLACES):
        s = f"(sum(CAST(trunc(fmod({col} * {2.0 ** -e!r}, {float(bits)!r})) AS BIGINT)) + {carry})"
        carry = f"CAST(floor({s} / {float(bits)!r}) AS HUGEINT)"
        limbs.append((s, f"({s} - {carry} * {bits})"))
    (_, rest), (_, f1), (_, f0), (_, i1), (_, i0), (top, _) = limbs
    whole = f"(CAST({top} AS DOUBLE) * {2.0 ** LIMB_PLACES[0]!r} + CAST({i0} * {bits} + {i1} AS DOUBLE))"
    part = f"(CAST({f0} * {bits} + {f1} AS DOUBLE) * {2.0 ** LIMB_PLACES[4]!r} + CAST({rest} AS DOUBLE) * {2.0 ** LIMB_PLACES[5]!r})"
    return f"({whole} + {part})"


def double_avg(col: str) -> str:
    return f"({double_sum(col)} / nullif(count({col}), 0))"


def half_up(value: str, scale: int) -> str:
    """Rounds the decimal text of a double, half away from zero."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 17)), {scale}) AS DOUBLE)"


# ---- the financing projection of orders (twin of tables.financing) ---------

def fin_sql() -> str:
    slot = "(o_orderkey % 50)"
    veh = f"(o_custkey % {len(VEHICLES)})"
    loc = f"(o_custkey % {len(LOCATIONS)})"
    term = "(24 + (o_orderkey % 4) * 12)"
    price = "CAST(round(o_totalprice * 100) AS BIGINT)"
    monthly = f"CAST((({price}) * 125 + {term} * 50) // ({term} * 100) AS DOUBLE) / 100.0"
    down = f"(CAST((({price}) * 2 + 5) // 10 AS DOUBLE) / 100.0)"

    def dirt(clean: str, *cases) -> str:
        return "CASE " + slot + " " + " ".join(f"WHEN {s} THEN {v}" for s, v in cases) + f" ELSE {clean} END"

    cols = [
        (dirt("'FIN-' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(10, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')", (1, "NULL")), "financing_id"),
        ("'CUS-' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(8, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0')", "customer_id"),
        (dirt(pick(veh, [v[0] for v in VEHICLES]), (2, q(" car ")), (3, q("TRUCK")), (4, "NULL"),
              (5, q("\tCAR"))), "vehicle_type"),
        ("'VEH-' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')", "vehicle_id"),
        (pick(veh, [v[1] for v in VEHICLES]), "vehicle_brand"),
        (pick(veh, [v[2] for v in VEHICLES]), "vehicle_model"),
        ("CAST(" + dirt(pick(veh, [v[3] for v in VEHICLES]), (6, "1999")) + " AS INTEGER)", "vehicle_year"),
        (dirt(pick(veh, [v[4] for v in VEHICLES]), (7, q(" Premium "))), "segment"),
        (dirt(pick(loc, [v[0] for v in LOCATIONS]), (8, q("SP")), (9, q(" south ")), (10, "NULL"),
              (11, q(""))), "region"),
        (dirt(pick(loc, [v[1] for v in LOCATIONS]), (12, q("sp"))), "state"),
        (pick(loc, [v[2] for v in LOCATIONS]), "city"),
        (dirt("o_totalprice", (13, "NULL"), (14, "0.0::DOUBLE"), (15, "-o_totalprice")), "financed_amount"),
        (dirt(down, (23, f"{down} + 0.005")), "down_payment"),
        (f"CAST({term} AS INTEGER)", "installment_count"),
        (dirt(monthly, (16, "0.0::DOUBLE"), (17, "NULL")), "monthly_installment"),
        ("CAST(129 + (o_orderkey % 71) AS DOUBLE) / 100.0", "interest_rate_monthly"),
        (dirt(pick("(o_orderkey % 3)", PRODUCER_STATUSES), (18, q("FOO")), (19, q(" active ")), (20, "NULL")),
         "status"),
        (dirt("'BRL'", (21, q("brl"))), "currency"),
        (dirt("o_orderdate", (22, "NULL")), "created_at"),
    ]
    return "SELECT " + ",\n  ".join(f"{e} AS {n}" for e, n in cols) + "\nFROM orders"


def rules_case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {q(code)}" for cond, code in rules) + " END"


def transaction_rules_sql() -> list[tuple[str, str]]:
    return [
        ("financing_id IS NULL", "missing_id"),
        (f"vehicle_type NOT IN {in_list(schemas.VEHICLE_TYPES)}", "bad_vehicle_type"),
        (f"region NOT IN {in_list(schemas.REGIONS + schemas.STATE_CODES)}", "bad_region"),
        ("financed_amount IS NULL", "missing_amount"),
        ("financed_amount <= 0", "nonpositive_amount"),
        ("monthly_installment <= 0", "nonpositive_installment"),
    ]


def silver_rules_sql() -> list[tuple[str, str]]:
    return [
        ("financing_id IS NULL", "missing_id"),
        (f"vehicle_type NOT IN {in_list(schemas.VEHICLE_TYPES)}", "bad_vehicle_type"),
        (f"region NOT IN {in_list(schemas.REGIONS)}", "bad_region"),
        (f"status NOT IN {in_list(schemas.STATUSES)}", "bad_status"),
        ("financed_amount <= 0", "nonpositive_amount"),
        ("monthly_installment <= 0", "nonpositive_installment"),
        ("created_at IS NULL", "missing_created_at"),
    ]


def contract_hits_sql(order=None) -> list[tuple[str, str]]:
    """Conditions and codes; within a kind by the columns' place in ``order``, if given."""
    if order is not None:
        kinds, place = {}, {c: i for i, c in enumerate(order)}
        for hit in contract_hits_sql():
            kinds.setdefault(hit[1].split(":")[0], []).append(hit)
        return [h for hits in kinds.values() for h in sorted(hits, key=lambda h: place[h[1].split(":")[1]])]
    hits = [(f"{c} IS NULL", f"required:{c}") for c in schemas.FINANCING_COLUMNS]
    hits += [(f"coalesce(NOT regexp_matches({c}, {q(p)}), false)", f"pattern:{c}") for c, p in CONTRACT_PATTERNS]
    hits += [(f"coalesce({c} NOT IN {in_list(v)}, false)", f"enum:{c}") for c, v in CONTRACT_ENUMS]
    for c, low, high, exclusive in CONTRACT_RANGES:
        below = f"{c} <= {low}" if exclusive else f"{c} < {low}"
        cond = below if high is None else f"({below} OR {c} > {high})"
        hits.append((f"coalesce({cond}, false)", f"range:{c}"))
    hits += [(f"coalesce(round({c}, 2) <> {c}, false)", f"cents:{c}") for c in CONTRACT_CENTS]
    hits += [(f"coalesce(length({c}) < {n}, false)", f"length:{c}") for c, n in CONTRACT_MIN_LENGTH]
    return hits


def contract_select(key: str, order=None) -> str:
    hits = contract_hits_sql(order)
    text = "concat_ws(',', " + ", ".join(f"CASE WHEN {h} THEN {q(code)} END" for h, code in hits) + ")"
    count = " + ".join(f"CAST({h} AS INTEGER)" for h, _ in hits)
    return f"SELECT {key}, {text} AS violation_text, ({count}) AS violation_count"


UPPER = ("vehicle_type", "region", "state", "status", "currency")
LOWER = ("segment",)


def normalized_select(src: str) -> str:
    cols = []
    for c in schemas.FINANCING_COLUMNS:
        if c in UPPER:
            cols.append(f"upper(trim({c})) AS {c}")
        elif c in LOWER:
            cols.append(f"lower(trim({c})) AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {src}"


FIN_COLS = ", ".join(schemas.FINANCING_COLUMNS)


def base_ctes() -> str:
    """fin, t_classified, normalized, s_classified, silver."""
    return (
        f"fin AS ({fin_sql()}),\n"
        f"t_classified AS (SELECT *, {rules_case(transaction_rules_sql())} AS validation_reason FROM fin),\n"
        f"normalized AS ({normalized_select('fin')}),\n"
        f"s_classified AS (SELECT *, {rules_case(silver_rules_sql())} AS validation_reason FROM normalized),\n"
        f"silver AS (SELECT {FIN_COLS} FROM s_classified WHERE validation_reason IS NULL)"
    )


def with_base(body: str) -> str:
    return f"WITH {base_ctes()}\n{body}"


def gold_select(src: str, window: str, money: str = "exact") -> str:
    start, end = bucket("created_at", window)
    dims = ", ".join(schemas.GOLD_DIMENSIONS)
    if money == "double":
        return (
            f"SELECT {start} AS window_start, {end} AS window_end, {dims},\n"
            f"  count(financing_id) AS financing_count,\n"
            f"  {half_up(double_sum('financed_amount'), 2)} AS total_financed_amount,\n"
            f"  {half_up(double_avg('monthly_installment'), 2)} AS average_monthly_installment,\n"
            f"  {half_up(double_avg('interest_rate_monthly'), 4)} AS average_interest_rate_monthly\n"
            f"FROM {src} GROUP BY ALL"
        )
    return (
        f"SELECT {start} AS window_start, {end} AS window_end, {dims},\n"
        f"  count(financing_id) AS financing_count,\n"
        f"  {exact_sum('financed_amount')} AS total_financed_amount,\n"
        f"  {exact_avg('monthly_installment', 2)} AS average_monthly_installment,\n"
        f"  {exact_avg('interest_rate_monthly', 4, in_scale=4)} AS average_interest_rate_monthly\n"
        f"FROM {src} GROUP BY ALL"
    )


def category_select(src: str, time_col: str, category: str, amount: str, window: str, money: str = "exact") -> str:
    start, end = bucket(time_col, window)
    exact = money == "exact"
    total = exact_sum(amount) if exact else half_up(double_sum(amount), 2)
    average = exact_avg(amount, 2) if exact else half_up(double_avg(amount), 2)
    return (
        f"SELECT {start} AS window_start, {end} AS window_end, {category} AS category,\n"
        f"  count(*) AS event_count, {total} AS total_amount,\n"
        f"  {average} AS average_amount\n"
        f"FROM {src} GROUP BY ALL"
    )


def counter_select(value: str, ts: str, src: str) -> str:
    v = value

    def spread(base_span) -> str:
        base, span = base_span
        return f"{base} + {v} % {span}"

    car, moto = G.COUNTER_BRANDS["CAR"], G.COUNTER_BRANDS["MOTORCYCLE"]
    return (
        f"SELECT 'FIN-' || lpad(CAST({v} AS VARCHAR), CAST(greatest({G.COUNTER_ID_DIGITS}, length(CAST({v} AS VARCHAR))) AS INTEGER), '0') AS financing_id,\n"
        f"  'CUS-' || lpad(CAST({v} % {G.COUNTER_CUSTOMER_MODULUS} AS VARCHAR), CAST(greatest({G.COUNTER_CUSTOMER_DIGITS}, length(CAST({v} % {G.COUNTER_CUSTOMER_MODULUS} AS VARCHAR))) AS INTEGER), '0')"
        f" AS customer_id,\n"
        f"  CASE WHEN {v} % 2 = 0 THEN 'CAR' ELSE 'MOTORCYCLE' END AS vehicle_type,\n"
        f"  CASE WHEN {v} % 2 = 0 THEN {q(car[0])} ELSE {q(moto[0])} END AS vehicle_brand,\n"
        f"  CASE WHEN {v} % 2 = 0 THEN {q(car[1])} ELSE {q(moto[1])} END AS vehicle_model,\n"
        f"  CAST({spread(G.COUNTER_YEAR)} AS INTEGER) AS vehicle_year,\n"
        f"  {pick(f'({v} % {len(G.COUNTER_SEGMENTS)})', G.COUNTER_SEGMENTS)} AS segment,\n"
        f"  {pick(f'({v} % {len(schemas.REGIONS)})', schemas.REGIONS)} AS region,\n"
        f"  CAST({spread(G.COUNTER_FINANCED)} AS DOUBLE) AS financed_amount,\n"
        f"  CAST({spread(G.COUNTER_DOWN)} AS DOUBLE) AS down_payment,\n"
        f"  CAST({spread(G.COUNTER_INSTALLMENTS)} AS INTEGER) AS installment_count,\n"
        f"  CAST({spread(G.COUNTER_MONTHLY)} AS DOUBLE) AS monthly_installment,\n"
        f"  CAST({spread(G.COUNTER_RATE_CENTS)} AS DOUBLE) / 100.0 AS interest_rate_monthly,\n"
        f"  {q(G.COUNTER_STATUS)} AS status, {q(G.COUNTER_CURRENCY)} AS currency,"
        f" {ts} AS created_at, {ts} AS event_time\n"
        f"FROM {src}"
    )


def draw_sql(key: str, stream: int, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{stream}:{seed}'), 1, 15) AS BIGINT)"


def contract_events_select(src: str, key: str, day: str, seed: int, bad_percent: int) -> str:
    def d(stream: int) -> str:
        return draw_sql(key, stream, seed)

    def uniform(stream: int, low_high) -> str:
        low, high = low_high
        return f"({low} + {d(stream)} % {high - low + 1})"

    veh = f"({d(1)} % {len(VEHICLES)})"
    loc = f"({d(2)} % {len(LOCATIONS)})"
    good = uniform(3, G.CONTRACT_FINANCED_CENTS)
    financed = f"(CASE WHEN {d(7)} % 100 < {bad_percent} THEN -{uniform(8, G.CONTRACT_NEGATIVE_CENTS)} ELSE {good} END)"
    down = f"(({good} * {uniform(4, G.CONTRACT_DOWN_BASIS_POINTS)} + 5000) // 10000)"
    count = f"CAST({pick(f'({d(5)} % {len(G.CONTRACT_TERMS)})', G.CONTRACT_TERMS)} AS INTEGER)"
    up, dn = G.CONTRACT_MARKUP
    monthly = f"(sign({financed}) * ((abs({financed}) * {up} + {count} * {dn // 2}) // ({count} * {dn})))"
    return (
        f"SELECT 'FIN-' || strftime({day}, '%Y%m%d') || '-' || printf('%0{G.CONTRACT_EVENT_DIGITS}d', {key})"
        f" AS financing_id,\n"
        f"  'CUS-' || CAST({uniform(10, G.CONTRACT_ID_NUMBERS)} AS VARCHAR) AS customer_id,\n"
        f"  {pick(veh, [v[0] for v in VEHICLES])} AS vehicle_type,\n"
        f"  'VEH-' || CAST({uniform(11, G.CONTRACT_ID_NUMBERS)} AS VARCHAR) AS vehicle_id,\n"
        f"  {pick(veh, [v[1] for v in VEHICLES])} AS vehicle_brand,\n"
        f"  {pick(veh, [v[2] for v in VEHICLES])} AS vehicle_model,\n"
        f"  CAST({pick(veh, [v[3] for v in VEHICLES])} AS INTEGER) AS vehicle_year,\n"
        f"  {pick(veh, [v[4] for v in VEHICLES])} AS segment,\n"
        f"  {pick(loc, [v[0] for v in LOCATIONS])} AS region,\n"
        f"  {pick(loc, [v[1] for v in LOCATIONS])} AS state,\n"
        f"  {pick(loc, [v[2] for v in LOCATIONS])} AS city,\n"
        f"  CAST({financed} AS DOUBLE) / 100.0 AS financed_amount,\n"
        f"  CAST({down} AS DOUBLE) / 100.0 AS down_payment,\n"
        f"  {count} AS installment_count,\n"
        f"  CAST({monthly} AS DOUBLE) / 100.0 AS monthly_installment,\n"
        f"  CAST({uniform(6, G.CONTRACT_RATE_CENTS)} AS DOUBLE) / 100.0 AS interest_rate_monthly,\n"
        f"  {pick(f'({d(9)} % {len(PRODUCER_STATUSES)})', PRODUCER_STATUSES)} AS status,\n"
        f"  {q(G.CONTRACT_CURRENCY)} AS currency,\n"
        f"  {day} + to_seconds(CAST({d(12)} % 86400 AS BIGINT)) AS created_at\n"
        f"FROM {src}"
    )


def contract_events_sql() -> str:
    return contract_events_select("orders", "o_orderkey", "o_orderdate", C.CONTRACT_SEED, C.CONTRACT_BAD_PERCENT)


T_COLS = FIN_COLS


def oracle_sql() -> dict[str, str]:
    from stratum.plans import oracle_io

    out = {
        "category_summary": category_select("events", "ts", "event_type", "value", C.CATEGORY_WINDOW),
        "lineitem_summary": category_select(
            "lineitem", "l_shipdate", "concat_ws('|', l_returnflag, l_linestatus)", "l_extendedprice",
            C.LINEITEM_WINDOW),
        "category_summary_double": category_select(
            "events", "ts", "event_type", "value", C.CATEGORY_WINDOW, money="double"),
        "gold_batch": with_base(gold_select("silver", C.GOLD_WINDOW)),
        "normalize_dims": (
            "SELECT vehicle_id, " + ", ".join(f"upper(trim({c})) AS {c}" for c in UPPER)
            + ", " + ", ".join(f"lower(trim({c})) AS {c}" for c in LOWER)
            + f" FROM ({fin_sql()})"
        ),
        "validate_valid": with_base(f"SELECT {T_COLS} FROM t_classified WHERE validation_reason IS NULL"),
        "validate_invalid": with_base(f"SELECT {T_COLS}, validation_reason FROM t_classified WHERE validation_reason IS NOT NULL"),
        "reason_counts": with_base(
            "SELECT validation_reason, count(*) AS row_count, 'transaction' AS rule_set FROM t_classified"
            " WHERE validation_reason IS NOT NULL GROUP BY validation_reason\n"
            "UNION ALL SELECT validation_reason, count(*) AS row_count, 'silver' AS rule_set FROM s_classified"
            " WHERE validation_reason IS NOT NULL GROUP BY validation_reason"
        ),
        "silver_batch": with_base("SELECT * FROM silver"),
        "contract_violations": f"{contract_select('vehicle_id')} FROM ({fin_sql()})",
        # ranges, cents and lengths in the order of the document's properties
        "contract_document": f"{contract_select('vehicle_id', contract_document()['properties'])} FROM ({fin_sql()})",
        "contract_violations_generated": f"{contract_select('financing_id')} FROM ({contract_events_sql()})",
        "synth_events": counter_select("event_id", "ts", "events"),
        "synth_contract_events": contract_events_sql(),
    }
    out.update(oracle_io.oracle_sql())
    return out
