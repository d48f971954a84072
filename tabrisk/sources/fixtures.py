"""Stand-in ``segments`` table derived from the driver tables.

The reference's raw input (road segments with a multi-label string) is not
available, so the segments are derived from ``lineitem JOIN supplier JOIN
nation`` by arithmetic on keys; missing values and the elevation sentinel are
injected deterministically. The column expressions are written once, valid
both in Spark SQL and in DuckDB, so the correctness oracle runs the very same
derivation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

KEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]

_SALT = "(l_orderkey*7 + l_partkey*3 + l_linenumber)"

# Column -> expression, valid in both engines (doubles written as 1.0e0).
SEGMENT_EXPRS: list[tuple[str, str]] = [
    ("segment_id", _SALT),
    ("city_name", "n_name"),
    ("latitude", "cast((l_suppkey*37)%140 - 70 as double)"),
    ("longitude", "cast((l_suppkey*53)%340 - 170 as double)"),
    (
        "elevation_m",
        f"case when {_SALT}%19=0 then null when {_SALT}%23=0 then -3.0e0 "
        "else l_quantity*l_quantity/10.0e0 end",
    ),
    ("drainage_density_km_per_km2", f"case when {_SALT}%11=0 then null else 1.0e0+l_tax*100.0e0 end"),
    ("storm_drain_proximity_m", f"case when {_SALT}%13=0 then null else l_extendedprice/100.0e0 end"),
    ("historical_rainfall_intensity_mm_hr", "5.0e0+l_discount*l_discount*10000.0e0"),
    (
        "return_period_years",
        "case l_partkey%6 when 0 then 2 when 1 then 5 when 2 then 10 when 3 then 25 "
        "when 4 then 50 else 100 end",
    ),
    ("land_use", "l_returnflag"),
    (
        "soil_group",
        "case l_suppkey%8 when 0 then null when 1 then 'A' when 2 then 'B' when 3 then 'B' "
        "when 4 then 'C' when 5 then 'C' when 6 then 'D' else 'A' end",
    ),
    ("storm_drain_type", f"case when {_SALT}%17=0 then null else l_linestatus end"),
    ("rainfall_source", f"case when {_SALT}%10=0 then null else cast(l_linenumber as varchar(10)) end"),
    ("dem_source", "l_returnflag"),
    (
        "risk_labels",
        "concat_ws('|', case when l_discount>=0.095e0 then 'extreme_rain_history' end, "
        "case when l_quantity<=3.0e0 then 'ponding_hotspot' end, "
        "case when l_quantity<=12.0e0 then ' low_lying ' end, "
        "case when l_partkey%9=0 then concat('event_','2024-01-0',cast(1+l_partkey%5 as varchar(10))) end)",
    ),
]

SEGMENT_COLUMNS = KEY_COLS + [name for name, _ in SEGMENT_EXPRS]


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the stand-in raw table (one row per line item)."""
    return segments_from(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "supplier"),
                         read_table(spark, sf_dir, "nation"))


def segments_from(li: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """The derivation on given frames (``li`` may be a streaming DataFrame).

    supplier grows with the scale factor: its join is left to Catalyst / AQE
    (broadcast only under autoBroadcastJoinThreshold, i.e. a checked size).
    nation has a fixed 25 rows in every scale factor: a proven broadcast bound."""
    su = supplier.select("s_suppkey", "s_nationkey")
    na = F.broadcast(nation.select("n_nationkey", "n_name"))
    joined = li.join(su, li.l_suppkey == su.s_suppkey).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(*KEY_COLS, *[f"{expr} AS {name}" for name, expr in SEGMENT_EXPRS])


def segments_sql() -> str:
    """The same derivation as a DuckDB / ANSI SQL sub-select."""
    cols = ", ".join(KEY_COLS + [f"{expr} AS {name}" for name, expr in SEGMENT_EXPRS])
    return (
        f"SELECT {cols} FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey "
        "JOIN nation n ON s.s_nationkey = n.n_nationkey"
    )
