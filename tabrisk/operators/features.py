"""Engineered features: core groups G1-G4 (P10-P14), domain groups (P15-P19),
percentile ranks fitted on train (W1a, W1b, W2, W3, T10), binning (P21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from .clean import med
from .order import join_small, positions, value_counts_ranked

EPS = C.DIVISION_EPS


def core_features(df: DataFrame, groups: Sequence[str] = ("G1", "G2", "G3", "G4")) -> DataFrame:
    """Core groups on rows that carry the fitted columns (``med__*``, ``elev_low``).

    G1 = proximity / (drainage + 1e-5), operands filled with fitted medians;
    G2 = rain * return period; G3 = soil code (Unknown 0 .. D 4) * rain;
    G4 = elevation (missing -> 999) < fitted p10 (fallback 5.0).
    """
    out = df
    if "G1" in groups:
        drain = F.coalesce(F.col("drainage_density_km_per_km2"), F.col(med("drainage_density_km_per_km2")))
        prox = F.coalesce(F.col("storm_drain_proximity_m"), F.col(med("storm_drain_proximity_m")))
        out = out.withColumn("G1_infra_vuln", prox / (drain + F.lit(EPS)))
    if "G2" in groups:
        out = out.withColumn(
            "G2_rain_x_return",
            F.col("historical_rainfall_intensity_mm_hr") * F.col("return_period_years").cast("double"),
        )
    if "G3" in groups:
        soil = X.map_values(F.coalesce(F.col("soil_group"), F.lit(C.UNKNOWN_CATEGORY)), C.SOIL_CODE_CORE)
        out = out.withColumn("G3_soil_x_rainfall", soil.cast("double") * F.col("historical_rainfall_intensity_mm_hr"))
    if "G4" in groups:
        thr = F.coalesce(F.col("elev_low"), F.lit(C.ELEV_LOW_FALLBACK))
        out = out.withColumn(
            "G4_is_very_low_elev",
            (F.coalesce(F.col("elevation_m"), F.lit(C.ELEV_MISSING_FILL)) < thr).cast("int"),
        )
    return out


def is_very_low_elevation(df: DataFrame, threshold: float = C.ELEV_LOW_FALLBACK) -> DataFrame:
    """Fixed-threshold flag."""
    return df.withColumn("is_very_low_elev", (F.col("elevation_m") < F.lit(threshold)).cast("int"))


def elevation_bins(df: DataFrame, col: str = "elevation_m") -> DataFrame:
    """Right-closed bins (-inf,5], (5,20], (20,50], (50,inf)."""
    return df.withColumn("elev_bin", X.right_closed_bins(col, C.ELEVATION_BIN_EDGES, C.ELEVATION_BIN_LABELS))


def domain_row_features(df: DataFrame) -> DataFrame:
    """Stateless domain groups G1, G2, G3, G5, G6."""
    elev = F.col("elevation_m")
    drain = F.col("drainage_density_km_per_km2")
    rain = F.col("historical_rainfall_intensity_mm_hr")
    ret = F.col("return_period_years").cast("double")
    soil = X.map_values("soil_group", C.SOIL_CODE_DOMAIN).cast("double")
    e01 = X.clip_lower(elev, 0.1)
    e05 = X.clip_lower(elev, 0.5)
    rain_x_ret = rain * ret
    return (
        df.withColumn("G1_drainage_deficit", (F.lit(1.0) / (drain + F.lit(EPS))) * (F.lit(1.0) / e01))
        .withColumn("G1_infra_vuln", F.col("storm_drain_proximity_m") / (drain + F.lit(EPS)))
        .withColumn("G2_hydraulic_stress", rain / (drain + F.lit(EPS)))
        .withColumn("G2_flood_accum", rain_x_ret / F.sqrt(e05))
        .withColumn("G3_effective_runoff", rain * (soil + F.lit(1.0)) / F.lit(4.0))
        .withColumn("G3_soil_elev_risk", (soil + F.lit(1.0)) / (e05 + F.lit(1.0)))
        .withColumn("G5_is_tropical", (F.abs(F.col("latitude")) < F.lit(C.TROPIC_LATITUDE)).cast("int"))
        .withColumn("G5_abs_latitude", F.abs(F.col("latitude")))
        .withColumn("G6_log_elevation", F.log1p(X.clip_lower(elev, 0.0)))
        .withColumn("G6_log_rainfall", F.log1p(rain))
        .withColumn("G6_log_rain_x_return", F.log1p(rain_x_ret))
    )


def train_percent_rank(df: DataFrame, value_col: str, key_cols: Sequence[str], out_col: str,
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """Position / max(1, n-1) in the order (value, keys); ties get distinct positions."""
    group_cols = list(group_cols)
    ranked = positions(df, [value_col, *key_cols], group_cols, "_pos", total_col="_n")
    return ranked.withColumn(
        out_col, F.col("_pos").cast("double") / F.greatest(F.lit(1), F.col("_n") - 1).cast("double")
    ).drop("_pos", "_n")


def average_rank(df: DataFrame, value_col: str, out_col: str, group_cols: Sequence[str] = (),
                 normalise: bool = True) -> DataFrame:
    """Average rank (ties share the mean rank), optionally / n.

    Built from the (value -> count) table, so a hot value is one row there.
    """
    group_cols = list(group_cols)
    vc = value_counts_ranked(df.where(F.col(value_col).isNotNull()), value_col, group_cols)
    avg = (F.col("before") + (F.col("cnt") + 1) / 2.0)
    vc = vc.select(*group_cols, value_col, (avg / F.col("n") if normalise else avg).alias(out_col))
    return join_small(df, vc, [*group_cols, value_col], "left")


def interp_percent_rank(train: DataFrame, new: DataFrame, value_col: str, out_col: str) -> DataFrame:
    """``np.interp(x, sorted(train), linspace(0,1,n))`` for every row of ``new``.

    x equal to a train value -> last position of that value / (n-1); between two
    train values -> linear between the last position of the lower and the first
    position of the upper; outside the train range -> 0 or 1.

    Distributed as an as-of lookup on *distinct* values: the train side is its
    (value -> first, last position) table, the new side is reduced to its
    distinct values first; both are unioned and the lower / upper neighbours
    found by ordered windows over that union of distinct values, then the result
    is joined back to the rows on the value (AQE splits a hot value).
    """
    vc = value_counts_ranked(train.where(F.col(value_col).isNotNull()), value_col)
    tv = vc.select(
        F.col(value_col).alias("v"),
        F.col("before").cast("double").alias("first_pos"),
        (F.col("before") + F.col("cnt") - 1).cast("double").alias("last_pos"),
        F.col("n"),
    )
    n_train = tv.select("n").limit(1).collect()[0]["n"]
    denom = float(max(1, n_train - 1))
    xs = new.select(F.col(value_col).alias("v")).where(F.col("v").isNotNull()).distinct()
    both = tv.drop("n").withColumn("is_train", F.lit(1)).unionByName(
        xs.withColumn("first_pos", F.lit(None).cast("double")).withColumn("last_pos", F.lit(None).cast("double"))
        .withColumn("is_train", F.lit(0))
    )
    # order: value, then train row first on equal value
    from pyspark.sql import Window

    lookup = _asof_neighbours(both, Window)
    res = lookup.where(F.col("is_train") == 0).select(
        F.col("v").alias(value_col),
        F.when(F.col("lo_v").isNull(), F.lit(0.0))
        .when(F.col("hi_v").isNull() & (F.col("lo_v") < F.col("v")), F.lit(1.0))
        .when(F.col("lo_v") == F.col("v"), F.col("lo_last") / denom)
        .otherwise(
            (F.col("lo_last") + (F.col("hi_first") - F.col("lo_last")) * (F.col("v") - F.col("lo_v"))
             / (F.col("hi_v") - F.col("lo_v"))) / denom
        ).alias(out_col),
    )
    return join_small(new, res, [value_col], "left")


def _asof_neighbours(both: DataFrame, Window) -> DataFrame:
    """Lower (last train value <= v) and upper (first train value >= v) neighbours.

    ``both`` holds distinct values only. It is range-bucketed by value so every
    bucket is ordered in its own task; a neighbour missing inside a bucket
    comes from the bucket summaries (last / first train entry per bucket),
    carried across buckets by a window over that small table.
    """
    spark = both.sparkSession
    nb = int(spark.conf.get("spark.sql.shuffle.partitions"))
    from ..session import cut_lineage

    b = cut_lineage(both.repartitionByRange(nb, "v", F.desc("is_train")).withColumn("_b", F.spark_partition_id()))
    train_v = F.when(F.col("is_train") == 1, F.col("v"))
    w_lo = Window.partitionBy("_b").orderBy("v", F.desc("is_train")).rowsBetween(Window.unboundedPreceding, 0)
    w_hi = Window.partitionBy("_b").orderBy("v", F.desc("is_train")).rowsBetween(0, Window.unboundedFollowing)
    loc = (
        b.withColumn("lo_v", F.last(train_v, ignorenulls=True).over(w_lo))
        .withColumn("lo_last", F.last(F.col("last_pos"), ignorenulls=True).over(w_lo))
        .withColumn("hi_v", F.first(train_v, ignorenulls=True).over(w_hi))
        .withColumn("hi_first", F.first(F.col("first_pos"), ignorenulls=True).over(w_hi))
    )
    summ = b.where(F.col("is_train") == 1).groupBy("_b").agg(
        F.max("v").alias("b_max_v"), F.max("last_pos").alias("b_max_last"),
        F.min("v").alias("b_min_v"), F.min("first_pos").alias("b_min_first"),
    )
    # one row per range bucket: a table of spark.sql.shuffle.partitions rows
    buckets = spark.range(nb).select(F.col("id").cast("int").alias("_b"))
    full = buckets.join(summ, "_b", "left")
    wb_prev = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wb_next = Window.orderBy("_b").rowsBetween(1, Window.unboundedFollowing)
    carry = full.select(
        "_b",
        F.last("b_max_v", ignorenulls=True).over(wb_prev).alias("p_v"),
        F.last("b_max_last", ignorenulls=True).over(wb_prev).alias("p_last"),
        F.first("b_min_v", ignorenulls=True).over(wb_next).alias("n_v"),
        F.first("b_min_first", ignorenulls=True).over(wb_next).alias("n_first"),
    )
    out = loc.join(F.broadcast(carry), "_b", "left")
    return out.select(
        "v", "is_train",
        F.coalesce("lo_v", "p_v").alias("lo_v"),
        F.when(F.col("lo_v").isNotNull(), F.col("lo_last")).otherwise(F.col("p_last")).alias("lo_last"),
        F.coalesce("hi_v", "n_v").alias("hi_v"),
        F.when(F.col("hi_v").isNotNull(), F.col("hi_first")).otherwise(F.col("n_first")).alias("hi_first"),
    )


def percentile_rank_features(train: DataFrame, test: DataFrame, key_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """G4 elevation and rainfall percentile ranks and their compound, fitted on train."""
    e, r = "elevation_m", "historical_rainfall_intensity_mm_hr"
    tr = train_percent_rank(train, e, key_cols, "G4_elev_pct_rank")
    tr = train_percent_rank(tr, r, key_cols, "G4_rain_pct_rank")
    te = interp_percent_rank(train, test, e, "G4_elev_pct_rank")
    te = interp_percent_rank(train, te, r, "G4_rain_pct_rank")
    comp = (1.0 - F.col("G4_elev_pct_rank")) * F.col("G4_rain_pct_rank")
    return tr.withColumn("G4_compound_extreme", comp), te.withColumn("G4_compound_extreme", comp)
