"""DuckDB oracle SQL for every registered query (tables are pre-registered views).

Written independently of the Spark code; dialect gaps are absorbed here:
``initcap`` is emulated, Sunday is 0 in DuckDB (``+ 1``), sums are cast to BIGINT, and
rounding of ratios is done exactly in integers (Spark rounds decimal / shortest-text values
HALF_UP, DuckDB rounds binary doubles).
"""

from __future__ import annotations

# --- raw feed from lineitem -----------------------------------------------------------------
RAW = """
raw AS (
  SELECT
    CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN 'None' ELSE CAST(k AS VARCHAR) END AS collision_id,
    CASE WHEN k % 103 = 0 THEN NULL
         ELSE strftime(CAST(l_shipdate AS DATE) + (CASE WHEN k % 89 = 0 THEN 0 ELSE 9862 END), '%Y-%m-%d')
              || 'T00:00:00.000' END AS crash_date,
    CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '25:61' WHEN 3 THEN ' 3:05 '
         ELSE CAST(k % 24 AS VARCHAR) || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') END AS crash_time,
    CASE s % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' bronx' WHEN 3 THEN 'Brooklyn '
         WHEN 4 THEN 'MANHATTAN' WHEN 5 THEN 'queens' ELSE 'Staten Island' END AS borough,
    CASE WHEN s % 5 = 0 THEN '' ELSE ' ' || CAST(10000 + s % 20 AS VARCHAR) END AS zip_code,
    CASE WHEN p % 11 = 0 THEN '0' WHEN p % 13 = 0 THEN ''
         ELSE '40.' || lpad(CAST(p % 1000 AS VARCHAR), 3, '0') END AS latitude,
    CASE WHEN p % 11 = 0 OR p % 17 = 0 THEN '0' WHEN p % 13 = 0 THEN ''
         ELSE '-73.' || lpad(CAST(p % 1000 AS VARCHAR), 3, '0') END AS longitude,
    '{"k":"' || CAST(p AS VARCHAR) || '"}' AS location,
    CASE WHEN p % 2 = 0 THEN ' broadway ' || CAST(p % 50 AS VARCHAR) || ' ' ELSE '' END AS on_street_name,
    CASE WHEN k % 5 = 0 THEN NULL ELSE 'Ave ' || CAST(k % 30 AS VARCHAR) END AS cross_street_name,
    CASE WHEN s % 3 = 0 THEN ' 12 main st' END AS off_street_name,
    CASE WHEN k % 29 = 0 THEN '-1' WHEN k % 31 = 0 THEN 'x' WHEN k % 37 = 0 THEN NULL
         ELSE CAST(p % 4 AS VARCHAR) END AS number_of_persons_injured,
    CASE WHEN k % 211 = 0 THEN '1' WHEN k % 29 = 0 THEN '-2' ELSE '0' END AS number_of_persons_killed,
    CASE WHEN p % 6 = 0 THEN '1' WHEN p % 19 = 0 THEN NULL ELSE '0' END AS number_of_pedestrians_injured,
    CASE WHEN k % 401 = 0 THEN '1' ELSE '0' END AS number_of_pedestrians_killed,
    CASE WHEN p % 9 = 0 THEN '2' ELSE '0' END AS number_of_cyclist_injured,
    CASE WHEN k % 503 = 0 THEN '1' ELSE '0' END AS number_of_cyclist_killed,
    CASE WHEN k % 37 = 0 THEN 'x' ELSE CAST(p % 3 AS VARCHAR) END AS number_of_motorist_injured,
    CASE WHEN k % 307 = 0 THEN '1' ELSE '0' END AS number_of_motorist_killed,
    CASE p % 3 WHEN 0 THEN ' driver inattention/DISTRACTION ' WHEN 1 THEN '' ELSE 'Unspecified' END
      AS contributing_factor_vehicle_1,
    CASE s % 3 WHEN 0 THEN 'unsafe speed' WHEN 1 THEN NULL ELSE ' ' END AS contributing_factor_vehicle_2,
    CASE WHEN p % 10 = 0 THEN 'glare' END AS contributing_factor_vehicle_3,
    CASE WHEN k % 50 = 0 THEN 'other vehicular' END AS contributing_factor_vehicle_4,
    CASE WHEN k % 100 = 0 THEN 'other vehicular' END AS contributing_factor_vehicle_5,
    CASE p % 4 WHEN 0 THEN 'sedan' WHEN 1 THEN ' Taxi' WHEN 2 THEN 'pick-up truck' ELSE '' END
      AS vehicle_type_code1,
    CASE s % 4 WHEN 0 THEN 'suv' WHEN 1 THEN NULL WHEN 2 THEN 'BIKE ' ELSE '' END AS vehicle_type_code2,
    CASE WHEN p % 7 = 0 THEN 'bus' END AS vehicle_type_code_3,
    CASE WHEN k % 41 = 0 THEN 'van' END AS vehicle_type_code_4,
    CASE WHEN k % 83 = 0 THEN 'van' END AS vehicle_type_code_5,
    l_shipdate AS _ingestion_timestamp
  FROM (SELECT *, l_orderkey AS k, l_partkey AS p, l_suppkey AS s FROM lineitem)
)"""

RAW_COLS = """collision_id, crash_date, crash_time, borough, zip_code, latitude, longitude, location,
  on_street_name, cross_street_name, off_street_name, number_of_persons_injured,
  number_of_persons_killed, number_of_pedestrians_injured, number_of_pedestrians_killed,
  number_of_cyclist_injured, number_of_cyclist_killed, number_of_motorist_injured,
  number_of_motorist_killed, contributing_factor_vehicle_1, contributing_factor_vehicle_2,
  contributing_factor_vehicle_3, contributing_factor_vehicle_4, contributing_factor_vehicle_5,
  vehicle_type_code1, vehicle_type_code2, vehicle_type_code_3, vehicle_type_code_4,
  vehicle_type_code_5"""


def _initcap(e: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({e}), ' '), "
            f"lambda w: concat(upper(w[1]), w[2:])), ' ')")


def _int(c: str) -> str:
    return f"CASE WHEN TRY_CAST({c} AS INTEGER) < 0 THEN NULL ELSE TRY_CAST({c} AS INTEGER) END"


def _dbl(c: str) -> str:
    return f"CASE WHEN TRY_CAST({c} AS DOUBLE) = 0 THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"


_FP = "md5(concat_ws('|', " + ", ".join(
    f"coalesce(length({c.strip()}) || ':' || {c.strip()}, '~')" for c in RAW_COLS.replace("\n", " ").split(",")) + "))"

TYPED = f"""
typed AS (
  SELECT
    collision_id,
    TRY_CAST(crash_date AS DATE) AS crash_date,
    trim(crash_time) AS crash_time,
    try_strptime(strftime(TRY_CAST(crash_date AS DATE), '%Y-%m-%d') || ' '
                 || coalesce(nullif(trim(crash_time), ''), '0:00'), '%Y-%m-%d %-H:%M') AS crash_datetime,
    nullif(upper(trim(borough)), '') AS borough,
    nullif(trim(zip_code), '') AS zip_code,
    {_dbl('latitude')} AS latitude,
    {_dbl('longitude')} AS longitude,
    nullif(upper(trim(on_street_name)), '') AS on_street_name,
    nullif(upper(trim(cross_street_name)), '') AS cross_street_name,
    nullif(upper(trim(off_street_name)), '') AS off_street_name,
    {_int('number_of_persons_injured')} AS persons_injured,
    {_int('number_of_persons_killed')} AS persons_killed,
    {_int('number_of_pedestrians_injured')} AS pedestrians_injured,
    {_int('number_of_pedestrians_killed')} AS pedestrians_killed,
    {_int('number_of_cyclist_injured')} AS cyclists_injured,
    {_int('number_of_cyclist_killed')} AS cyclists_killed,
    {_int('number_of_motorist_injured')} AS motorists_injured,
    {_int('number_of_motorist_killed')} AS motorists_killed,
    nullif({_initcap('trim(contributing_factor_vehicle_1)')}, '') AS contributing_factor_vehicle_1,
    nullif({_initcap('trim(contributing_factor_vehicle_2)')}, '') AS contributing_factor_vehicle_2,
    nullif({_initcap('trim(contributing_factor_vehicle_3)')}, '') AS contributing_factor_vehicle_3,
    nullif({_initcap('trim(contributing_factor_vehicle_4)')}, '') AS contributing_factor_vehicle_4,
    nullif({_initcap('trim(contributing_factor_vehicle_5)')}, '') AS contributing_factor_vehicle_5,
    nullif(upper(trim(vehicle_type_code1)), '') AS vehicle_type_code1,
    nullif(upper(trim(vehicle_type_code2)), '') AS vehicle_type_code2,
    nullif(upper(trim(vehicle_type_code_3)), '') AS vehicle_type_code_3,
    nullif(upper(trim(vehicle_type_code_4)), '') AS vehicle_type_code_4,
    nullif(upper(trim(vehicle_type_code_5)), '') AS vehicle_type_code_5,
    _ingestion_timestamp,
    {_FP} AS _row_fingerprint
  FROM raw
)"""

TOTALS = """
  coalesce(persons_injured, 0) + coalesce(pedestrians_injured, 0) + coalesce(cyclists_injured, 0)
    + coalesce(motorists_injured, 0) AS total_injuries,
  coalesce(persons_killed, 0) + coalesce(pedestrians_killed, 0) + coalesce(cyclists_killed, 0)
    + coalesce(motorists_killed, 0) AS total_fatalities"""

VALID = """
valid AS (
  SELECT * FROM typed
  WHERE collision_id IS NOT NULL AND collision_id <> 'None' AND crash_date IS NOT NULL
)"""


def _deduped(order: str) -> str:
    return f"""
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY collision_id ORDER BY {order}) AS rn FROM valid)
  WHERE rn = 1
)"""


DEDUPED = _deduped("_ingestion_timestamp DESC NULLS LAST, _row_fingerprint DESC")

SILVER_COLS = """collision_id, crash_date, crash_time, crash_datetime, borough, zip_code, latitude,
  longitude, on_street_name, cross_street_name, off_street_name, persons_injured, persons_killed,
  pedestrians_injured, pedestrians_killed, cyclists_injured, cyclists_killed, motorists_injured,
  motorists_killed, total_injuries, total_fatalities, has_injuries, has_fatalities,
  contributing_factor_vehicle_1, contributing_factor_vehicle_2, contributing_factor_vehicle_3,
  contributing_factor_vehicle_4, contributing_factor_vehicle_5, vehicle_type_code1,
  vehicle_type_code2, vehicle_type_code_3, vehicle_type_code_4, vehicle_type_code_5"""

SILVER = f"""
totals AS (SELECT *, {TOTALS} FROM deduped),
silver AS (
  SELECT *, total_injuries > 0 AS has_injuries, total_fatalities > 0 AS has_fatalities,
         crash_date AS crash_date_partition
  FROM totals
)"""

STG = """
stg AS (
  SELECT collision_id, crash_date, crash_time, crash_datetime, borough, zip_code, latitude,
    longitude, on_street_name, cross_street_name, off_street_name, persons_injured,
    persons_killed, pedestrians_injured, pedestrians_killed, cyclists_injured, cyclists_killed,
    motorists_injured, motorists_killed, total_injuries, total_fatalities, has_injuries,
    has_fatalities, contributing_factor_vehicle_1, contributing_factor_vehicle_2,
    contributing_factor_vehicle_3, contributing_factor_vehicle_4, contributing_factor_vehicle_5,
    vehicle_type_code1 AS vehicle_type_1, vehicle_type_code2 AS vehicle_type_2,
    vehicle_type_code_3 AS vehicle_type_3, vehicle_type_code_4 AS vehicle_type_4,
    vehicle_type_code_5 AS vehicle_type_5
  FROM silver
)"""


def _calendar(source: str) -> str:
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
    CAST(day(d) AS INTEGER) AS day, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
    CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
    dayofweek(d) IN (0, 6) AS is_weekend
  FROM ({source})"""


DIM_DATE = ("\ndim_date AS (" + _calendar(
    "SELECT CAST(range AS DATE) AS d FROM range(DATE '2022-01-01', DATE '2030-12-31', INTERVAL 1 DAY)")
    + "\n)")

SK_NULL = "'_dbt_utils_surrogate_key_null_'"


def _sk(*cols: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), {SK_NULL})" for c in cols) + "))"


VEH = ["vehicle_type_1", "vehicle_type_2", "vehicle_type_3", "vehicle_type_4", "vehicle_type_5"]

DIM_LOCATION = f"""
dim_location AS (
  SELECT {_sk('borough', 'zip_code')} AS location_sk, borough, zip_code,
    coalesce(borough, 'Unknown') AS borough_label, coalesce(zip_code, 'Unknown') AS zip_code_label
  FROM (SELECT DISTINCT borough, zip_code FROM stg)
)"""

DIM_VEHICLE = f"""
dim_vehicle AS (
  SELECT {_sk(*VEH)} AS vehicle_sk, {', '.join(VEH)},
    coalesce(vehicle_type_1, 'Unknown') AS primary_vehicle_type,
    CAST({' + '.join(f'CAST({v} IS NOT NULL AS INTEGER)' for v in VEH)} AS INTEGER)
      AS vehicles_involved_count
  FROM (SELECT DISTINCT {', '.join(VEH)} FROM stg)
)"""

FACT = f"""
fact AS (
  SELECT {_sk('c.collision_id')} AS collision_sk, c.collision_id, d.date_id AS date_sk,
    {_sk('c.borough', 'c.zip_code')} AS location_sk,
    {_sk(*[f'c.{v}' for v in VEH])} AS vehicle_sk,
    c.crash_date, c.crash_time, c.crash_datetime, c.latitude, c.longitude, c.on_street_name,
    c.cross_street_name, c.persons_injured, c.persons_killed, c.pedestrians_injured,
    c.pedestrians_killed, c.cyclists_injured, c.cyclists_killed, c.motorists_injured,
    c.motorists_killed, c.total_injuries, c.total_fatalities, c.has_injuries, c.has_fatalities,
    c.contributing_factor_vehicle_1, c.contributing_factor_vehicle_2,
    c.contributing_factor_vehicle_3, c.contributing_factor_vehicle_4,
    c.contributing_factor_vehicle_5
  FROM stg c LEFT JOIN dim_date d ON d.full_date = c.crash_date
)"""


def _round2_ratio(num: str, den: str, scale: int = 1) -> str:
    """round(num * scale / den, 2) exactly (HALF_UP) for non-negative integers, as DOUBLE."""
    return (f"CASE WHEN {den} = 0 OR {num} IS NULL THEN NULL ELSE "
            f"CAST((CAST({num} AS HUGEINT) * {200 * scale} + {den}) // (2 * {den}) AS DOUBLE) / 100 END")


MONTHLY = f"""
monthly AS (
  SELECT d.year, d.month, d.month_name,
    strftime(make_date(d.year, d.month, 1), '%Y-%m-%d') AS month_start_date,
    count(*) AS total_collisions,
    CAST(sum(f.total_injuries) AS BIGINT) AS total_injuries,
    CAST(sum(f.total_fatalities) AS BIGINT) AS total_fatalities,
    CAST(sum(CASE WHEN f.has_injuries THEN 1 ELSE 0 END) AS BIGINT) AS collisions_with_injuries,
    CAST(sum(CASE WHEN f.has_fatalities THEN 1 ELSE 0 END) AS BIGINT) AS collisions_with_fatalities,
    {_round2_ratio('sum(CASE WHEN f.total_injuries > 0 THEN f.total_injuries END)',
                   'count(CASE WHEN f.total_injuries > 0 THEN 1 END)')} AS avg_injuries_per_crash,
    CAST(sum(f.pedestrians_injured) AS BIGINT) AS pedestrians_injured,
    CAST(sum(f.pedestrians_killed) AS BIGINT) AS pedestrians_killed,
    CAST(sum(f.cyclists_injured) AS BIGINT) AS cyclists_injured,
    CAST(sum(f.cyclists_killed) AS BIGINT) AS cyclists_killed
  FROM fact f JOIN dim_date d ON d.date_id = f.date_sk
  WHERE d.year IS NOT NULL
  GROUP BY d.year, d.month, d.month_name
)"""

_COUNTS = ["persons_injured", "persons_killed", "pedestrians_injured", "pedestrians_killed",
           "cyclists_injured", "cyclists_killed", "motorists_injured", "motorists_killed"]

BOROUGH = f"""
borough_m AS (
  SELECT coalesce(l.borough, 'Unknown') AS borough,
    count(*) AS total_collisions,
    CAST(sum(f.total_injuries) AS BIGINT) AS total_injuries,
    CAST(sum(f.total_fatalities) AS BIGINT) AS total_fatalities,
    {', '.join(f'CAST(sum(f.{c}) AS BIGINT) AS {c}' for c in _COUNTS)},
    {_round2_ratio('sum(f.total_injuries)', 'count(*)', 100)} AS injury_rate_per_100,
    {_round2_ratio('sum(f.total_fatalities)', 'count(*)', 100)} AS fatality_rate_per_100
  FROM fact f LEFT JOIN dim_location l ON l.location_sk = f.location_sk
  GROUP BY coalesce(l.borough, 'Unknown')
)"""

PARTS = {"raw": RAW, "typed": TYPED, "valid": VALID, "deduped": DEDUPED, "silver": SILVER,
         "stg": STG, "dim_date": DIM_DATE, "dim_location": DIM_LOCATION,
         "dim_vehicle": DIM_VEHICLE, "fact": FACT, "monthly": MONTHLY, "borough_m": BOROUGH}
ORDER = list(PARTS)


def with_(upto: list[str], final: str, parts: dict | None = None) -> str:
    """WITH clause holding every CTE needed up to the named ones, then ``final``."""
    parts = parts or PARTS
    need = max(ORDER.index(u) for u in upto)
    chosen = [parts[n] for n in ORDER[: need + 1]]
    return "WITH " + ",".join(chosen) + "\n" + final


# --- data tests --------------------------------------------------------------------------------
GOLD_CTE = {"stg_collisions": "stg", "dim_date": "dim_date", "dim_location": "dim_location",
            "dim_vehicle": "dim_vehicle", "fact_collisions": "fact",
            "monthly_collision_metrics": "monthly", "borough_collision_metrics": "borough_m"}


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def check_sql(table_label: str, source: str, kind: str, column: str, opts: dict,
              name: str) -> str:
    where = f" AND ({opts['where']})" if opts.get("where") else ""
    head = f"SELECT '{table_label}' AS table_name, '{name}' AS check_name, '{kind}' AS check_kind, " \
           f"'{column}' AS column_name, "
    if kind == "not_null":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM {source} WHERE {column} IS NULL{where}"
    if kind == "unique":
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {column} FROM {source} "
                       f"WHERE {column} IS NOT NULL{where} GROUP BY {column} HAVING count(*) > 1)")
    if kind == "accepted_values":
        vals = ", ".join(_lit(v) for v in opts["values"])
        return head + (f"CAST(count(DISTINCT {column}) AS BIGINT) AS failures FROM {source} "
                       f"WHERE {column} IS NOT NULL AND {column} NOT IN ({vals}){where}")
    if kind == "expression_is_true":
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM {source} "
                       f"WHERE NOT ({column} {opts['expression']}){where}")
    if kind == "relationships":
        parent, pcol = opts["to"]
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM {source} c "
                       f"WHERE c.{column} IS NOT NULL{where.replace(column, 'c.' + column)} "
                       f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{column})")
    raise ValueError(kind)


def _check_name(table: str, kind: str, column: str, opts: dict) -> str:
    suffix = ""
    if kind == "expression_is_true":
        suffix = "_" + {">= 0": "ge_0", "> 0": "gt_0"}[opts["expression"]]
    return f"{kind}_{table}_{column}{suffix}"


def suite_sql(tests, kinds) -> list[str]:
    out = []
    for table, kind, column, opts in tests:
        if kind not in kinds:
            continue
        o = dict(opts)
        if kind == "relationships":
            o["to"] = (GOLD_CTE[o["to"][0]], o["to"][1])
        out.append(check_sql(table, GOLD_CTE[table], kind, column, o,
                             _check_name(table, kind, column, opts)))
    return out


DIRTY = """
dirty AS (
  SELECT collision_id, crash_date, upper(trim(borough)) AS borough,
         TRY_CAST(number_of_persons_injured AS INTEGER) AS persons_injured
  FROM raw
)"""


def _all_with(final: str, parts: dict | None = None, extra: str = "") -> str:
    parts = parts or PARTS
    body = ",".join(parts[n] for n in ORDER) + ("," + extra if extra else "")
    return "WITH " + body + "\n" + final


# --- fixed values: the data tests and the borough seed, listed here on their own ------------
BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"]
_IN_LIST = {"values": BOROUGHS, "where": "borough is not null"}
DATA_TESTS = [
    ("stg_collisions", "not_null", "collision_id", {}),
    ("stg_collisions", "unique", "collision_id", {}),
    ("stg_collisions", "not_null", "crash_date", {}),
    ("stg_collisions", "accepted_values", "borough", _IN_LIST),
    ("stg_collisions", "not_null", "total_injuries", {}),
    ("stg_collisions", "expression_is_true", "total_injuries", {"expression": ">= 0"}),
    ("stg_collisions", "not_null", "total_fatalities", {}),
    ("stg_collisions", "expression_is_true", "total_fatalities", {"expression": ">= 0"}),
    ("dim_date", "not_null", "date_id", {}),
    ("dim_date", "unique", "date_id", {}),
    ("dim_date", "not_null", "full_date", {}),
    ("dim_date", "unique", "full_date", {}),
    ("dim_date", "not_null", "year", {}),
    ("dim_date", "not_null", "month", {}),
    ("dim_date", "accepted_values", "month", {"values": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]}),
    ("dim_date", "not_null", "day_of_week", {}),
    ("dim_date", "accepted_values", "day_of_week", {"values": [1, 2, 3, 4, 5, 6, 7]}),
    ("dim_date", "not_null", "is_weekend", {}),
    ("dim_location", "not_null", "location_sk", {}),
    ("dim_location", "unique", "location_sk", {}),
    ("dim_location", "accepted_values", "borough", _IN_LIST),
    ("dim_location", "not_null", "borough_label", {}),
    ("dim_vehicle", "not_null", "vehicle_sk", {}),
    ("dim_vehicle", "unique", "vehicle_sk", {}),
    ("dim_vehicle", "not_null", "primary_vehicle_type", {}),
    ("dim_vehicle", "not_null", "vehicles_involved_count", {}),
    ("dim_vehicle", "accepted_values", "vehicles_involved_count", {"values": [0, 1, 2, 3, 4, 5]}),
    ("fact_collisions", "not_null", "collision_sk", {}),
    ("fact_collisions", "unique", "collision_sk", {}),
    ("fact_collisions", "not_null", "collision_id", {}),
    ("fact_collisions", "unique", "collision_id", {}),
    ("fact_collisions", "relationships", "date_sk", {"to": ("dim_date", "date_id"), "where": "date_sk is not null"}),
    ("fact_collisions", "relationships", "location_sk", {"to": ("dim_location", "location_sk")}),
    ("fact_collisions", "relationships", "vehicle_sk", {"to": ("dim_vehicle", "vehicle_sk")}),
    ("fact_collisions", "not_null", "crash_date", {}),
    ("fact_collisions", "not_null", "total_injuries", {}),
    ("fact_collisions", "expression_is_true", "total_injuries", {"expression": ">= 0"}),
    ("fact_collisions", "not_null", "total_fatalities", {}),
    ("fact_collisions", "expression_is_true", "total_fatalities", {"expression": ">= 0"}),
    ("fact_collisions", "not_null", "has_injuries", {}),
    ("fact_collisions", "not_null", "has_fatalities", {}),
    ("monthly_collision_metrics", "not_null", "year", {}),
    ("monthly_collision_metrics", "not_null", "month", {}),
    ("monthly_collision_metrics", "not_null", "total_collisions", {}),
    ("monthly_collision_metrics", "expression_is_true", "total_collisions", {"expression": "> 0"}),
    ("monthly_collision_metrics", "not_null", "total_injuries", {}),
    ("monthly_collision_metrics", "not_null", "total_fatalities", {}),
    ("borough_collision_metrics", "not_null", "borough", {}),
    ("borough_collision_metrics", "unique", "borough", {}),
    ("borough_collision_metrics", "not_null", "total_collisions", {}),
    ("borough_collision_metrics", "expression_is_true", "total_collisions", {"expression": "> 0"}),
    ("borough_collision_metrics", "not_null", "injury_rate_per_100", {}),
    ("borough_collision_metrics", "not_null", "fatality_rate_per_100", {}),
]
SEED = [
    ("BRONX", "The Bronx", "BX"),
    ("BROOKLYN", "Brooklyn", "BK"),
    ("MANHATTAN", "Manhattan", "MN"),
    ("QUEENS", "Queens", "QN"),
    ("STATEN ISLAND", "Staten Island", "SI"),
    ("Unknown", "Unknown", "N/A"),
]
# ------------------------------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    win = ("ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-24 23:59:59'")
    seed = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in SEED)
    newer = "ts >= TIMESTAMP '2024-01-15 00:00:00'"
    counts = ",\n  ".join(
        f"TRY_CAST(number_of_{src} AS INTEGER) AS {dst}" for src, dst in [
            ("persons_injured", "persons_injured"), ("persons_killed", "persons_killed"),
            ("pedestrians_injured", "pedestrians_injured"), ("pedestrians_killed", "pedestrians_killed"),
            ("cyclist_injured", "cyclists_injured"), ("cyclist_killed", "cyclists_killed"),
            ("motorist_injured", "motorists_injured"), ("motorist_killed", "motorists_killed")])
    all_kinds = {"not_null", "unique", "accepted_values", "expression_is_true", "relationships"}

    def checks(kinds, dirty: list[str]) -> str:
        return _all_with("\nUNION ALL\n".join(suite_sql(DATA_TESTS, kinds) + dirty), extra=DIRTY)

    def dirty(kind, column, opts, source="dirty", label="raw_collisions"):
        return check_sql(label, source, kind, column, opts, _check_name(label, kind, column, opts))

    staged_parts = dict(PARTS, deduped=_deduped("_row_fingerprint DESC"))
    li_rel = [
        check_sql("lineitem", "lineitem", "relationships", c, {"to": (p, pc)},
                  f"relationships_lineitem_{c}")
        for c, p, pc in [("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                         ("l_suppkey", "supplier", "s_suppkey")]]
    return {
        "incremental_window": f"SELECT * FROM events WHERE {win}",
        "high_water_mark": (
            "SELECT count(*) AS batch_rows, CASE WHEN count(*) = 0 THEN DATE '2024-01-24' "
            "WHEN max(ts) IS NULL THEN DATE '2024-01-10' ELSE CAST(max(ts) AS DATE) END AS new_mark "
            f"FROM events WHERE {win}"),
        "ordered_page": "SELECT * FROM events ORDER BY ts, event_id LIMIT 1000 OFFSET 2000",
        "deep_page": "SELECT * FROM events ORDER BY ts, event_id LIMIT 1000 OFFSET 4000",
        "page_numbers": (
            "SELECT o_orderkey, o_orderdate, row_number() OVER w AS row_no, "
            "(row_number() OVER w - 1) // 1000 AS page_no FROM orders "
            "WINDOW w AS (ORDER BY o_orderdate, o_orderkey)"),
        "flatten_nested": (
            "SELECT o_orderkey, "
            "'{\"id\":' || coalesce(CAST(o_custkey AS VARCHAR), 'null') || ',\"status\":' || "
            "coalesce('\"' || o_orderstatus || '\"', 'null') || '}' AS customer, "
            "'[' || coalesce('\"' || o_orderpriority || '\"', 'null') || ',' || "
            "coalesce('\"' || o_orderstatus || '\"', 'null') || ']' AS tags, "
            "'{\"priority\":' || coalesce('\"' || o_orderpriority || '\"', 'null') || '}' AS attrs "
            "FROM orders"),
        "jsonl_roundtrip": with_(["raw"], f"SELECT {RAW_COLS} FROM raw"),
        "schema_merge_load": (
            f"SELECT CAST(event_id AS VARCHAR) AS event_id, ts, event_type, "
            f"CASE WHEN {newer} THEN CAST(user_id AS VARCHAR) END AS user_id, "
            f"CASE WHEN {newer} THEN value END AS value, CASE WHEN {newer} THEN props END AS props FROM events"),
        "idempotent_file_load": with_(
            ["raw"], f"SELECT {RAW_COLS}, TRY_CAST(crash_date AS DATE) AS crash_date_partition FROM raw"),
        "compact_partitions": "SELECT *, CAST(ts AS DATE) AS event_date FROM events",
        "seed_lookup_join": with_(["borough_m"], (
            "SELECT b.*, s.borough_name, s.borough_short FROM borough_m b LEFT JOIN "
            f"(VALUES {seed}) s(borough_code, borough_name, borough_short) "
            "ON b.borough = s.borough_code")),
        "typed_casts": with_(["raw"], (
            "SELECT collision_id, TRY_CAST(crash_date AS DATE) AS crash_date, "
            "TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude, "
            f"{counts} FROM raw")),
        "compose_timestamp": with_(["typed"], (
            "SELECT collision_id, crash_date, crash_time, crash_datetime FROM typed")),
        "clean_strings": with_(["typed"], (
            "SELECT collision_id, borough, zip_code, on_street_name, cross_street_name, "
            "off_street_name, crash_time, contributing_factor_vehicle_1, "
            "contributing_factor_vehicle_2, contributing_factor_vehicle_3, "
            "contributing_factor_vehicle_4, contributing_factor_vehicle_5, vehicle_type_code1, "
            "vehicle_type_code2, vehicle_type_code_3, vehicle_type_code_4, vehicle_type_code_5 "
            "FROM typed")),
        "null_sentinels": with_(["typed"], (
            "SELECT collision_id, latitude, longitude, persons_injured, persons_killed, "
            "pedestrians_injured, pedestrians_killed, cyclists_injured, cyclists_killed, "
            "motorists_injured, motorists_killed FROM typed")),
        "valid_rows": with_(["valid"], (
            "SELECT collision_id, crash_date, _ingestion_timestamp, _row_fingerprint FROM valid")),
        "totals_flags": with_(["typed"], (
            f"SELECT collision_id, total_injuries, total_fatalities, total_injuries > 0 AS has_injuries, "
            f"total_fatalities > 0 AS has_fatalities FROM (SELECT *, {TOTALS} FROM typed)")),
        "dedupe_latest": with_(["deduped"], (
            "SELECT collision_id, crash_date, _ingestion_timestamp, _row_fingerprint FROM deduped")),
        "silver": with_(["silver"], f"SELECT {SILVER_COLS}, _ingestion_timestamp, crash_date_partition FROM silver"),
        "staging": with_(["stg"], "SELECT * FROM stg"),
        "dim_date": with_(["stg"], _calendar(
            "SELECT CAST(unnest(generate_series(CAST(min(crash_date) AS TIMESTAMP), "
            "CAST(max(crash_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM stg")),
        "dim_location": with_(["dim_location"], "SELECT * FROM dim_location"),
        "dim_vehicle": with_(["dim_vehicle"], "SELECT * FROM dim_vehicle"),
        "fact": with_(["fact"], "SELECT * FROM fact"),
        "monthly_metrics": with_(["monthly"], "SELECT * FROM monthly ORDER BY year, month"),
        "borough_metrics": with_(["borough_m"], "SELECT * FROM borough_m ORDER BY total_collisions DESC"),
        "check_not_null": checks({"not_null"}, [dirty("not_null", "collision_id", {}),
                                                dirty("not_null", "crash_date", {})]),
        "check_unique": checks({"unique"}, [dirty("unique", "collision_id", {})]),
        "check_accepted": checks({"accepted_values"}, [dirty(
            "accepted_values", "borough",
            {"values": ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"],
             "where": "borough is not null"})]),
        "check_expression": checks({"expression_is_true"}, [dirty(
            "expression_is_true", "persons_injured", {"expression": ">= 0"})]),
        "check_relationships": checks({"relationships"}, li_rel),
        "check_suite": checks(all_kinds, []),
        "failing_rows": with_(["raw"], (
            "SELECT collision_id, persons_injured FROM (SELECT collision_id, "
            "TRY_CAST(number_of_persons_injured AS INTEGER) AS persons_injured FROM raw) "
            "WHERE NOT (persons_injured >= 0)")),
        "staged_run": _all_with("SELECT * FROM borough_m", parts=staged_parts),
    }
