"""The driver's star tables seen as raw flight records.

One `lineitem` row is one scheduled flight; supplier and customer nations are
the origin and destination airports.  The SQL text is portable, so the same
definition of the *input* can be read by an independent engine; the operators
on top of it are not shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightlake.contracts import AIRPORTS, CARRIERS, COMPACT_COLUMNS, RAW_COLUMNS
from flightlake.session import partitions
from flightlake.sources.files import read_driver_table

_LINEITEM_COLUMNS = {
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
}
TABLES = ["lineitem", "orders", "customer", "supplier", "nation", "region"]


def _hhmm(minute: str) -> str:
    return f"cast(floor(({minute}) / 60) as int) * 100 + ({minute}) % 60"


def _block(minute: str) -> str:
    hour = f"lpad(cast(cast(floor({minute} / 60) as int) as string), 2, '0')"
    return f"{hour} || '00-' || {hour} || '59'"


BASE_CTES = f"""
base AS (
  SELECT
    l_orderkey, l_linenumber, l_suppkey,
    cast(l_shipdate as date) AS d,
    cast(l_suppkey % 14 as int) AS a,
    cast((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000 as int) AS h,
    cast((l_partkey * 37 + l_linenumber * 11) % 1440 as int) AS dep_min,
    45 + cast(l_quantity as int) * 6 AS elapsed,
    s_nationkey, c_nationkey,
    sn.n_name AS s_nation, sn.n_regionkey AS s_regionkey, sr.r_name AS s_region,
    cn.n_name AS c_nation, cn.n_regionkey AS c_regionkey, cr.r_name AS c_region
  FROM {{lineitem}} l
  JOIN {{orders}} o ON l_orderkey = o_orderkey
  JOIN {{customer}} c ON o_custkey = c_custkey
  JOIN {{supplier}} s ON l_suppkey = s_suppkey
  JOIN {{nation}} sn ON s_nationkey = sn.n_nationkey
  JOIN {{region}} sr ON sn.n_regionkey = sr.r_regionkey
  JOIN {{nation}} cn ON c_nationkey = cn.n_nationkey
  JOIN {{region}} cr ON cn.n_regionkey = cr.r_regionkey
),
derived AS (
  SELECT *,
    (dep_min + elapsed) % 1440 AS arr_min,
    h < 20 AS canc,
    h BETWEEN 20 AND 22 AS dv,
    h > 22 AS done,
    (h * 7 + s_nationkey * 3 + a * 2) % 41 - 20
      + CASE WHEN h >= 960 THEN 75 WHEN h >= 880 THEN 25 ELSE 0 END AS adel,
    (h * 7 + s_nationkey * 3 + a * 2) % 41 - 20
      + CASE WHEN h >= 960 THEN 75 WHEN h >= 880 THEN 25 ELSE 0 END - 5 + l_linenumber AS ddel
  FROM base
)"""

_TWO = "lpad(cast({0} as string), 2, '0')"
_DATE_TEXT = (
    f"{_TWO.format('month(d)')} || '/' || {_TWO.format('dayofmonth(d)')} || '/' || "
    "cast(year(d) as string) || ' 12:00:00 AM'"
)

# raw column -> SQL over `derived`
_STANDARD = {
    "YEAR": "cast(year(d) as int)",
    "QUARTER": "cast(quarter(d) as int)",
    "MONTH": "cast(month(d) as int)",
    "DAY_OF_MONTH": "cast(dayofmonth(d) as int)",
    "DAY_OF_WEEK": "cast([isodow] as int)",
    "FL_DATE": _DATE_TEXT,
    "OP_UNIQUE_CARRIER": f"'C' || {_TWO.format('a')}",
    "OP_CARRIER_AIRLINE_ID": "19000 + a",
    "TAIL_NUM": "'N' || cast(l_suppkey as string)",
    "OP_CARRIER_FL_NUM": "l_orderkey * 7 + l_linenumber",
    "ORIGIN_AIRPORT_ID": "10000 + s_nationkey",
    "ORIGIN": f"'A' || {_TWO.format('s_nationkey')}",
    "ORIGIN_CITY_NAME": "s_nation",
    "ORIGIN_STATE_ABR": "'R' || cast(s_regionkey as string)",
    "ORIGIN_STATE_NM": "s_region",
    "DEST_AIRPORT_ID": "10000 + c_nationkey",
    "DEST": f"'A' || {_TWO.format('c_nationkey')}",
    "DEST_CITY_NAME": "c_nation",
    "DEST_STATE_ABR": "'R' || cast(c_regionkey as string)",
    "DEST_STATE_NM": "c_region",
    "CRS_DEP_TIME": _hhmm("dep_min"),
    "DEP_TIME": f"CASE WHEN NOT canc THEN {_hhmm('(dep_min + ddel + 1440) % 1440')} END",
    "DEP_DELAY": "CASE WHEN NOT canc THEN ddel END",
    "DEP_DELAY_NEW": "CASE WHEN NOT canc THEN CASE WHEN ddel < 0 THEN 0 ELSE ddel END END",
    "DEP_DEL15": "CASE WHEN NOT canc THEN CASE WHEN ddel >= 15 THEN 1 ELSE 0 END END",
    "DEP_TIME_BLK": _block("dep_min"),
    "TAXI_OUT": "CASE WHEN NOT canc THEN 8 + h % 20 END",
    "TAXI_IN": "CASE WHEN NOT canc THEN 3 + h % 9 END",
    "CRS_ARR_TIME": _hhmm("arr_min"),
    "ARR_TIME": f"CASE WHEN done THEN {_hhmm('(arr_min + adel + 1440) % 1440')} END",
    "ARR_DELAY": "CASE WHEN done THEN adel END",
    "ARR_DELAY_NEW": "CASE WHEN done THEN CASE WHEN adel < 0 THEN 0 ELSE adel END END",
    "ARR_DEL15": "CASE WHEN done THEN CASE WHEN adel >= 15 THEN 1 ELSE 0 END END",
    "ARR_TIME_BLK": _block("arr_min"),
    "CANCELLED": "CASE WHEN canc THEN 1 ELSE 0 END",
    "CANCELLATION_CODE": "CASE WHEN canc THEN substr('ABCD', h % 4 + 1, 1) END",
    "DIVERTED": "CASE WHEN dv THEN 1 ELSE 0 END",
    "CRS_ELAPSED_TIME": "elapsed",
    "ACTUAL_ELAPSED_TIME": "CASE WHEN done THEN elapsed + 5 END",
    "AIR_TIME": "CASE WHEN done THEN elapsed - 20 END",
    "FLIGHTS": "1",
    "DISTANCE": "elapsed * 7",
    "DISTANCE_GROUP": "least(cast(floor(elapsed * 7 / 250) as int) + 1, 11)",
    "CARRIER_DELAY": "CASE WHEN done AND adel >= 15 THEN cast(floor(adel / 3) as int) END",
    "WEATHER_DELAY": "CASE WHEN done AND adel >= 15 THEN h % 5 END",
    "NAS_DELAY": "CASE WHEN done AND adel >= 15 THEN cast(floor(adel / 4) as int) END",
    "SECURITY_DELAY": "CASE WHEN done AND adel >= 15 THEN 0 END",
    "LATE_AIRCRAFT_DELAY": (
        "CASE WHEN done AND adel >= 15 THEN adel - cast(floor(adel / 3) as int)"
        " - h % 5 - cast(floor(adel / 4) as int) END"
    ),
}
# h -> faulted raw columns of the edge fixture (SQL over the text-typed rows).
_FAULTS = {
    "TAIL_NUM": "WHEN h = 101 THEN '  ' || TAIL_NUM || ' '",
    "CANCELLATION_CODE": "WHEN h = 101 THEN '   '",
    "CRS_DEP_TIME": "WHEN h = 102 THEN '2400' WHEN h = 103 THEN '2460'",
    "FL_DATE": "WHEN h = 104 THEN 'not-a-date' WHEN h = 105 THEN '1/2/1999 12:00:00 AM'",
    "ORIGIN_AIRPORT_ID": "WHEN h = 106 THEN NULL",
    "CANCELLED": "WHEN h = 107 THEN '1' WHEN h = 108 THEN '2' WHEN h = 109 THEN NULL",
    "DIVERTED": "WHEN h = 107 THEN '1'",
    "MONTH": "WHEN h = 110 THEN cast(cast(MONTH as int) + 1 as string) WHEN h = 111 THEN NULL",
    "TAXI_OUT": "WHEN h = 112 THEN '-3'",
    "DISTANCE": "WHEN h = 113 THEN 'abc'",
    "ARR_DEL15": "WHEN h = 114 THEN CASE WHEN ARR_DEL15 = '1' THEN '0' ELSE '1' END",
    "ORIGIN": "WHEN h = 115 THEN NULL",
    "DEST": "WHEN h = 116 THEN 'Q' || DEST",
    "FLIGHTS": "WHEN h = 117 THEN '1.5'",
}


def _carrier_pick() -> str:
    codes = ",".join(code for code, _, _ in CARRIERS[:13])
    return f"CASE WHEN a < 13 THEN split_part('{codes}', ',', a + 1) ELSE 'ZZ' END"


def _airport_pick(nation: str) -> str:
    codes = ",".join(row[0] for row in AIRPORTS[:20])
    return (
        f"CASE WHEN {nation} < 20 THEN split_part('{codes}', ',', {nation} + 1) "
        f"ELSE 'X' || cast({nation} as string) END"
    )


_COMPACT = {
    "YEAR": _STANDARD["YEAR"],
    "MONTH": _STANDARD["MONTH"],
    "DAY": _STANDARD["DAY_OF_MONTH"],
    "AIRLINE": f"CASE WHEN h = 122 THEN NULL ELSE {_carrier_pick()} END",
    "FLIGHT_NUMBER": "cast(l_orderkey * 7 + l_linenumber as string)",
    "TAIL_NUMBER": "' N' || cast(l_suppkey as string) || ' '",
    "ORIGIN_AIRPORT": _airport_pick("s_nationkey"),
    "DESTINATION_AIRPORT": _airport_pick("c_nationkey"),
    "SCHEDULED_DEPARTURE": (
        f"CASE WHEN h = 120 THEN 'abc' ELSE cast({_STANDARD['CRS_DEP_TIME']} as string) END"
    ),
    "DEPARTURE_TIME": _STANDARD["DEP_TIME"],
    "DEPARTURE_DELAY": _STANDARD["DEP_DELAY"],
    "TAXI_OUT": _STANDARD["TAXI_OUT"],
    "SCHEDULED_TIME": _STANDARD["CRS_ELAPSED_TIME"],
    "ELAPSED_TIME": _STANDARD["ACTUAL_ELAPSED_TIME"],
    "AIR_TIME": _STANDARD["AIR_TIME"],
    "DISTANCE": _STANDARD["DISTANCE"],
    "TAXI_IN": _STANDARD["TAXI_IN"],
    "SCHEDULED_ARRIVAL": _STANDARD["CRS_ARR_TIME"],
    "ARRIVAL_TIME": _STANDARD["ARR_TIME"],
    "ARRIVAL_DELAY": _STANDARD["ARR_DELAY"],
    "DIVERTED": "CASE WHEN dv OR h = 121 THEN 1 ELSE 0 END",
    "CANCELLED": "CASE WHEN canc OR h = 121 THEN 1 ELSE 0 END",
    "CANCELLATION_REASON": _STANDARD["CANCELLATION_CODE"],
    "AIR_SYSTEM_DELAY": _STANDARD["NAS_DELAY"],
    "SECURITY_DELAY": _STANDARD["SECURITY_DELAY"],
    "AIRLINE_DELAY": _STANDARD["CARRIER_DELAY"],
    "LATE_AIRCRAFT_DELAY": _STANDARD["LATE_AIRCRAFT_DELAY"],
    "WEATHER_DELAY": _STANDARD["WEATHER_DELAY"],
}


def standard_sql() -> str:
    """CTE list ending in `raw`: 48 columns, typed, no faults."""
    columns = ",\n    ".join(f"{_STANDARD[c]} AS {c}" for c in RAW_COLUMNS)
    return f"{BASE_CTES},\nraw AS (\n  SELECT\n    {columns}\n  FROM derived\n)"


def edge_sql() -> str:
    """CTE list ending in `raw`: 48 text columns with the injected faults."""
    text = ",\n    ".join(f"cast({_STANDARD[c]} as string) AS {c}" for c in RAW_COLUMNS)
    faulted = ",\n    ".join(
        f"CASE {_FAULTS[c]} ELSE {c} END AS {c}" if c in _FAULTS else c for c in RAW_COLUMNS
    )
    # h = 100 appears twice: exact duplicates
    return (
        f"{BASE_CTES},\ntyped_text AS (\n  SELECT h,\n    {text}\n  FROM derived\n),\n"
        f"raw AS (\n  SELECT\n    {faulted}\n  FROM typed_text\n"
        f"  UNION ALL\n  SELECT {', '.join(RAW_COLUMNS)} FROM typed_text WHERE h = 100\n)"
    )


def compact_sql() -> str:
    """CTE list ending in `raw`: the 28-column layout."""
    columns = ",\n    ".join(f"{_COMPACT[c]} AS {c}" for c in COMPACT_COLUMNS)
    return f"{BASE_CTES},\nraw AS (\n  SELECT\n    {columns}\n  FROM derived\n)"


def _run(spark: SparkSession, sf_dir: str, ctes: str, columns: list[str]) -> DataFrame:
    tables = {name: read_driver_table(spark, sf_dir, name) for name in TABLES}
    columns_used = [c for c in tables["lineitem"].columns if c in _LINEITEM_COLUMNS]
    tables["lineitem"] = tables["lineitem"].select(*columns_used).repartition(partitions(spark), "l_orderkey")
    ctes = ctes.replace("[isodow]", "weekday(d) + 1")  # the one spelling that is not portable
    return spark.sql(f"WITH {ctes}\nSELECT {', '.join(columns)} FROM raw", **tables)


def standard_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, standard_sql(), RAW_COLUMNS)


def edge_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, edge_sql(), RAW_COLUMNS)


def compact_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, compact_sql(), COMPACT_COLUMNS)
