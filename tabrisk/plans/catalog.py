"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole driver tables; ``ORACLE`` holds the equivalent DuckDB SQL.

Floating outputs are rounded to 6 places on both sides so that engine-level
last-bit differences do not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import exprs as X
from ..operators import clean, encode, features, folds, labels, metrics, profile, ranking
from ..operators.order import exact_quantiles, local_df, to_long
from ..sources.fixtures import segments
from ..sources.tables import read_table
from . import prepare
from .sqltext import (
    CAT, KEYS, NUM, assign_class_sql, base_cte, class_code_sql, hash_sql, params_cte, soil_core_sql,
    soil_domain_sql, tokens_sql,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

KEY_LIST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
HASH_KEYS = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]
SEED = 42


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def rnd(df: DataFrame, places: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def seg_labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labels.with_risk_class(segments(spark, sf))


def seg_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled segments with the sentinel applied."""
    return clean.apply_sentinel(seg_labelled(spark, sf))


def _r(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


# ---------------------------------------------------------------- labels ---
@register(
    "class_distribution",
    f"{base_cte()} SELECT risk_class, count(*) AS n, "
    "round(count(*) / sum(count(*)) OVER (), 6) AS share, "
    "round(max(count(*)) OVER () / min(count(*)) OVER (), 6) AS imbalance_ratio FROM lab GROUP BY risk_class",
)
def q_class_distribution(spark, sf):
    return rnd(labels.class_distribution(seg_labelled(spark, sf)))


@register(
    "risk_class_rows",
    f"{base_cte()} SELECT {KEYS}, risk_labels, risk_class, risk_class_encoded FROM lab",
)
def q_risk_class_rows(spark, sf):
    return seg_labelled(spark, sf).select(*KEY_LIST, "risk_labels", "risk_class", "risk_class_encoded")


@register(
    "label_token_frequency",
    f"{base_cte()}, t AS (SELECT unnest({tokens_sql('risk_labels')}) AS token FROM lab) "
    "SELECT token, regexp_matches(token, '^event_\\d{4}-\\d{2}-\\d{2}') AS is_event, count(*) AS n "
    "FROM t WHERE token <> '' GROUP BY token",
)
def q_label_token_frequency(spark, sf):
    return labels.token_frequency(segments(spark, sf), drop_events=False)


@register(
    "class_by_land_use",
    f"{base_cte()} SELECT land_use, risk_class, count(*) AS n, "
    "round(count(*) / sum(count(*)) OVER (PARTITION BY land_use), 6) AS share, "
    "round(max(count(*)) OVER (PARTITION BY land_use) / min(count(*)) OVER (PARTITION BY land_use), 6) AS imbalance_ratio "
    "FROM lab GROUP BY land_use, risk_class",
)
def q_class_by_land_use(spark, sf):
    return rnd(labels.class_distribution(seg_labelled(spark, sf), group_cols=["land_use"]))


# --------------------------------------------------------------- profile ---
def _union_sql(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@register(
    "numeric_quantiles",
    f"{base_cte()} "
    + _union_sql([
        f"SELECT '{c}' AS feature, count({c}) AS n, "
        + ", ".join(_r(f"quantile_cont({c}, {p})", "q_" + str(p).replace(".", "_")) for p in (0.1, 0.25, 0.5, 0.75, 0.95))
        + " FROM lab"
        for c in NUM
    ]),
)
def q_numeric_quantiles(spark, sf):
    return rnd(exact_quantiles(seg_clean(spark, sf), NUM, [0.1, 0.25, 0.5, 0.75, 0.95]))


@register(
    "missing_report",
    f"{base_cte()} SELECT * FROM ("
    + _union_sql([
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_missing, "
        f"round((count(*) - count({c})) * 100.0e0 / count(*), 6) AS pct_missing FROM lab"
        for c in NUM + CAT
    ])
    + ") WHERE n_missing > 0",
)
def q_missing_report(spark, sf):
    return rnd(profile.missing_report(seg_clean(spark, sf), NUM + CAT))


@register(
    "missing_by_class",
    f"{base_cte()} "
    + _union_sql([
        f"SELECT risk_class, '{c}' AS feature, {_r(f'avg(CASE WHEN {c} IS NULL THEN 1.0e0 ELSE 0.0e0 END)', 'missing_rate')} "
        "FROM lab GROUP BY risk_class"
        for c in NUM + CAT
    ]),
)
def q_missing_by_class(spark, sf):
    return rnd(profile.missing_rate_by(seg_clean(spark, sf), "risk_class", NUM + CAT))


@register(
    "missing_by_city",
    f"{base_cte()} SELECT * FROM ("
    + _union_sql([
        f"SELECT city_name, '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0e0 ELSE 0.0e0 END) AS missing_rate "
        "FROM lab GROUP BY city_name"
        for c in NUM + CAT
    ])
    + ") WHERE missing_rate > 0.1e0",
)
def q_missing_by_city(spark, sf):
    return profile.missing_rate_by(seg_clean(spark, sf), "city_name", NUM + CAT, min_rate=0.1)


def _describe_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return _union_sql([
        f"SELECT {g}'{c}' AS feature, count({c}) AS count, {_r(f'avg({c})', 'mean')}, {_r(f'stddev_samp({c})', 'std')}, "
        f"{_r(f'min({c})', 'min')}, {_r(f'max({c})', 'max')}, {_r(f'quantile_cont({c}, 0.25)', 'q_0_25')}, "
        f"{_r(f'quantile_cont({c}, 0.5)', 'q_0_5')}, {_r(f'quantile_cont({c}, 0.75)', 'q_0_75')} FROM lab{gb}"
        for c in NUM
    ])


@register("describe_numeric", f"{base_cte()} {_describe_sql(None)}")
def q_describe(spark, sf):
    return rnd(profile.describe(seg_clean(spark, sf), NUM))


@register("describe_by_class", f"{base_cte()} {_describe_sql('risk_class')}")
def q_describe_by_class(spark, sf):
    return rnd(profile.describe(seg_clean(spark, sf), NUM, ["risk_class"]))


@register(
    "skewness",
    f"{base_cte()} SELECT feature, round(skew, 6) AS skew, CASE WHEN abs(skew) > 1.0 THEN 'heavy' "
    "WHEN abs(skew) > 0.5 THEN 'moderate' ELSE 'low' END AS severity FROM ("
    + _union_sql([f"SELECT '{c}' AS feature, skewness({c}) AS skew FROM lab" for c in NUM])
    + ")",
)
def q_skewness(spark, sf):
    return rnd(profile.skewness(seg_clean(spark, sf), NUM))


CORR_COLS = NUM + ["risk_class_encoded"]


@register(
    "correlation_matrix",
    f"{base_cte()} "
    + _union_sql([
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 'corr')} FROM lab"
        for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i:]
    ]),
)
def q_correlation_matrix(spark, sf):
    return rnd(profile.correlations(seg_clean(spark, sf), CORR_COLS))


@register(
    "target_correlation",
    f"{base_cte()}, c AS ("
    + _union_sql([f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(risk_class_encoded AS DOUBLE)) AS corr FROM lab" for c in NUM])
    + ") SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr, CAST(abs(corr) > 0.3 AS INTEGER) AS strong, "
    "CAST(row_number() OVER (ORDER BY abs(corr) DESC, feature) AS INTEGER) AS rank FROM c",
)
def q_target_correlation(spark, sf):
    return rnd(profile.target_correlation(seg_clean(spark, sf), NUM, "risk_class_encoded"))


@register(
    "spearman_target",
    f"{base_cte()}, l AS ("
    + _union_sql([f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(risk_class_encoded AS DOUBLE) AS y FROM lab WHERE {c} IS NOT NULL" for c in NUM])
    + "), r AS (SELECT feature, "
    "rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0e0 AS rx, "
    "rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0e0 AS ry FROM l) "
    ", s AS (SELECT feature, corr(rx, ry) AS rho, count(*) AS n, corr(rx, ry) * sqrt((count(*) - 2) / (1.0e0 - corr(rx, ry) * corr(rx, ry))) AS t FROM r GROUP BY feature), "
    # the tail of the t density by Simpson's rule over 4000 intervals of [0, |t|]
    "w AS (SELECT feature, i, abs(t) * i / 4000.0e0 AS u, n - 2 AS v, abs(t) / 4000.0e0 AS h FROM s, range(4001) q(i)), "
    "p AS (SELECT feature, 1 - 2 * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * h / 3 * exp(lgamma((v + 1) / 2.0e0) - lgamma(v / 2.0e0) - 0.5e0 * ln(pi() * v) - (v + 1) / 2.0e0 * ln(1 + u * u / v))) AS p FROM w GROUP BY feature) "
    "SELECT feature, round(rho, 6) AS rho, n, round(t, 6) AS t_stat, round(abs(rho), 6) AS abs_rho, round(greatest(p, 0.0e0), 6) + 0.0e0 AS p_value, "
    "CAST(row_number() OVER (ORDER BY abs(rho) DESC, feature) AS INTEGER) AS place, 1 AS in_top FROM s JOIN p USING (feature)",
)
def q_spearman_target(spark, sf):
    return rnd(profile.spearman_target(seg_clean(spark, sf), NUM, "risk_class_encoded"))


@register(
    "crosstab_soil_class",
    f"{base_cte()} SELECT soil_group, risk_class, count(*) AS n, "
    "round(count(*) / sum(count(*)) OVER (PARTITION BY soil_group), 6) AS share FROM lab GROUP BY soil_group, risk_class",
)
def q_crosstab_soil_class(spark, sf):
    return rnd(profile.crosstab(seg_clean(spark, sf), "soil_group", "risk_class", "index"))


@register(
    "crosstab_class_soil_col",
    f"{base_cte()} SELECT risk_class, soil_group, count(*) AS n, "
    "round(count(*) / sum(count(*)) OVER (PARTITION BY soil_group), 6) AS share FROM lab GROUP BY risk_class, soil_group",
)
def q_crosstab_class_soil_col(spark, sf):
    return rnd(profile.crosstab(seg_clean(spark, sf), "risk_class", "soil_group", "columns"))


@register(
    "categorical_cardinality",
    f"{base_cte()} "
    + _union_sql([f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_missing FROM lab" for c in CAT]),
)
def q_categorical_cardinality(spark, sf):
    return profile.cardinality(seg_clean(spark, sf), CAT)


@register(
    "categorical_value_counts",
    f"{base_cte()} "
    + _union_sql([f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM lab GROUP BY {c}" for c in CAT]),
)
def q_categorical_value_counts(spark, sf):
    return profile.value_counts(seg_clean(spark, sf), CAT)


@register(
    "tukey_fences",
    f"{base_cte()}, q AS ("
    + _union_sql([f"SELECT '{c}' AS feature, count({c}) AS n, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lab" for c in NUM])
    + "), f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper FROM q), o AS ("
    + _union_sql([f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} < lower OR {c} > upper) AS n_outliers, count({c}) AS n_valid "
                  f"FROM lab, (SELECT lower, upper FROM f WHERE feature = '{c}')" for c in NUM])
    + ") SELECT f.feature, n, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower, "
    "round(upper, 6) AS upper, n_outliers, n_valid, round(n_outliers / n_valid, 6) AS outlier_share FROM f JOIN o USING (feature)",
)
def q_tukey_fences(spark, sf):
    return rnd(profile.tukey_fences(seg_clean(spark, sf), NUM))


@register(
    "outlier_class_mix",
    f"{base_cte()}, q AS ("
    + _union_sql([f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lab" for c in NUM])
    + "), l AS ("
    + _union_sql([f"SELECT '{c}' AS feature, risk_class, CAST({c} AS DOUBLE) AS value FROM lab WHERE {c} IS NOT NULL" for c in NUM])
    + "), o AS (SELECT l.feature, risk_class, count(*) AS n FROM l JOIN q ON l.feature = q.feature "
    "WHERE value < q1 - 1.5e0 * (q3 - q1) OR value > q3 + 1.5e0 * (q3 - q1) GROUP BY l.feature, risk_class) "
    "SELECT feature, risk_class, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS share FROM o",
)
def q_outlier_class_mix(spark, sf):
    return rnd(profile.outlier_class_mix(seg_clean(spark, sf), NUM, "risk_class"))


@register(
    "outlier_event_type_mix",
    "WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events), "
    "o AS (SELECT 'value' AS feature, event_type, count(*) AS n FROM events, q "
    "WHERE value < q1 - 1.5e0 * (q3 - q1) OR value > q3 + 1.5e0 * (q3 - q1) GROUP BY event_type) "
    "SELECT feature, event_type, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS share FROM o",
)
def q_outlier_event_type_mix(spark, sf):
    """A11 on a skewed column: event types among the Tukey outliers of the event value."""
    return rnd(profile.outlier_class_mix(read_table(spark, sf, "events"), ["value"], "event_type"))


@register(
    "grouped_stats_by_class",
    f"{base_cte()} "
    + _union_sql([
        f"SELECT risk_class, '{c}' AS feature, {_r(f'avg({c})', 'mean')}, {_r(f'stddev_samp({c})', 'std')}, "
        f"{_r(f'min({c})', 'min')}, {_r(f'max({c})', 'max')}, {_r(f'quantile_cont({c}, 0.5)', 'median')} FROM lab GROUP BY risk_class"
        for c in NUM
    ]),
)
def q_grouped_stats_by_class(spark, sf):
    return rnd(profile.grouped_stats(seg_clean(spark, sf), NUM, "risk_class"))


_BIN_SQL = (
    "CASE WHEN elevation_m IS NULL THEN NULL WHEN elevation_m <= 5.0e0 THEN '<=5' WHEN elevation_m <= 20.0e0 THEN '5-20' "
    "WHEN elevation_m <= 50.0e0 THEN '20-50' ELSE '>50' END"
)


@register(
    "elevation_bin_share",
    f"{base_cte()} SELECT risk_class, {_BIN_SQL} AS elev_bin, count(*) AS n, "
    "round(count(*) / sum(count(*)) OVER (PARTITION BY risk_class), 6) AS share FROM lab GROUP BY risk_class, elev_bin",
)
def q_elevation_bin_share(spark, sf):
    d = features.elevation_bins(seg_clean(spark, sf))
    return rnd(profile.bin_share_by_class(d, "elev_bin", "risk_class"))


@register(
    "rainfall_histogram",
    f"{base_cte()}, mm AS (SELECT min(historical_rainfall_intensity_mm_hr) AS lo, max(historical_rainfall_intensity_mm_hr) AS hi FROM lab), "
    "b AS (SELECT risk_class, CAST(least(floor((historical_rainfall_intensity_mm_hr - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, lo, hi "
    "FROM lab, mm WHERE historical_rainfall_intensity_mm_hr IS NOT NULL) "
    "SELECT risk_class, bin, count(*) AS n, round(min(lo) + bin * ((min(hi) - min(lo)) / 50), 6) AS bin_lo, "
    "round(min(lo) + (bin + 1) * ((min(hi) - min(lo)) / 50), 6) AS bin_hi FROM b GROUP BY risk_class, bin",
)
def q_rainfall_histogram(spark, sf):
    return rnd(profile.histogram(seg_clean(spark, sf), "historical_rainfall_intensity_mm_hr", 50, ["risk_class"]))


@register(
    "elevation_boxplot_by_class",
    f"{base_cte()}, q AS (SELECT risk_class, count(elevation_m) AS n, quantile_cont(elevation_m, 0.25) AS q1, "
    "quantile_cont(elevation_m, 0.5) AS q2, quantile_cont(elevation_m, 0.75) AS q3 FROM lab GROUP BY risk_class), "
    "f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lf, q3 + 1.5e0 * (q3 - q1) AS uf FROM q) "
    "SELECT f.risk_class, 'elevation_m' AS feature, n, round(q1, 6) AS q_0_25, round(q2, 6) AS q_0_5, round(q3, 6) AS q_0_75, "
    "round(min(CASE WHEN elevation_m BETWEEN lf AND uf THEN elevation_m END), 6) AS whisker_lo, "
    "round(max(CASE WHEN elevation_m BETWEEN lf AND uf THEN elevation_m END), 6) AS whisker_hi, "
    "count(*) FILTER (WHERE NOT (elevation_m BETWEEN lf AND uf)) AS n_fliers "
    "FROM lab JOIN f ON lab.risk_class = f.risk_class WHERE elevation_m IS NOT NULL "
    "GROUP BY f.risk_class, n, q1, q2, q3",
)
def q_elevation_boxplot_by_class(spark, sf):
    return rnd(profile.boxplot_stats(seg_clean(spark, sf), "elevation_m", "risk_class"))


@register(
    "events_value_by_type",
    "SELECT event_type, 'value' AS feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, "
    "round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS q_0_25, "
    "round(quantile_cont(value, 0.5), 6) AS q_0_5, round(quantile_cont(value, 0.75), 6) AS q_0_75 FROM events GROUP BY event_type",
)
def q_events_value_by_type(spark, sf):
    return rnd(profile.describe(read_table(spark, sf, "events"), ["value"], ["event_type"]))


@register(
    "events_skew_by_type",
    "SELECT event_type, 'value' AS feature, round(skewness(value), 6) AS skew, CASE WHEN abs(skewness(value)) > 1.0 THEN 'heavy' "
    "WHEN abs(skewness(value)) > 0.5 THEN 'moderate' ELSE 'low' END AS severity FROM events GROUP BY event_type",
)
def q_events_skew_by_type(spark, sf):
    return rnd(profile.skewness(read_table(spark, sf, "events"), ["value"], ["event_type"]))


# ----------------------------------------------------------- preparation ---
def _tree_sql() -> str:
    codes = []
    for c in CAT:
        codes.append(
            f"cd_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM "
            f"(SELECT DISTINCT coalesce({c}, 'Unknown') AS v FROM lab))"
        )
    joins = " ".join(f"LEFT JOIN cd_{c} ON cd_{c}.v = coalesce(lab.{c}, 'Unknown')" for c in CAT)
    imp = {c: f"coalesce(lab.{c}, p.med_{i})" for i, c in enumerate(NUM)}
    prox = imp["storm_drain_proximity_m"]
    return (
        f"{base_cte()}, {params_cte()}, {', '.join(codes)} SELECT {', '.join('lab.' + k.strip() for k in KEYS.split(','))}, "
        + _r(imp["elevation_m"], "elevation_m") + ", "
        + _r(imp["drainage_density_km_per_km2"], "drainage_density_km_per_km2") + ", "
        + _r(f"CASE WHEN {prox} > p.clip_upper THEN p.clip_upper ELSE {prox} END", "storm_drain_proximity_m") + ", "
        + _r(imp["historical_rainfall_intensity_mm_hr"], "historical_rainfall_intensity_mm_hr") + ", "
        + _r(imp["return_period_years"], "return_period_years") + ", "
        + _r(f"{prox} / (coalesce(lab.drainage_density_km_per_km2, p.med_1) + 1e-5)", "G1_infra_vuln") + ", "
        + _r("lab.historical_rainfall_intensity_mm_hr * lab.return_period_years", "G2_rain_x_return") + ", "
        + _r(f"{soil_core_sql('coalesce(lab.soil_group, ' + chr(39) + 'Unknown' + chr(39) + ')')} * lab.historical_rainfall_intensity_mm_hr", "G3_soil_x_rainfall") + ", "
        + "CAST(coalesce(lab.elevation_m, 999.0e0) < coalesce(p.elev_low, 5.0e0) AS INTEGER) AS G4_is_very_low_elev, "
        + ", ".join(f"cd_{c}.code AS {c}" for c in CAT)
        + ", lab.risk_class, lab.risk_class_encoded, lab.latitude, lab.longitude "
        f"FROM lab CROSS JOIN p {joins}"
    )


@register("tree_preparation", _tree_sql())
def q_tree_preparation(spark, sf):
    raw = segments(spark, sf)
    prep = prepare.fit_tree(raw)
    return rnd(prepare.transform_tree(raw, prep, keep=KEY_LIST))


@register(
    "fitted_parameters",
    f"{base_cte()}, {params_cte()} SELECT "
    + ", ".join(_r(f"med_{i}", f"med__{c}") for i, c in enumerate(NUM))
    + ", round(elev_low, 6) AS elev_low, round(clip_upper, 6) AS clip_upper FROM p",
)
def q_fitted_parameters(spark, sf):
    return rnd(clean.fit_common(segments(spark, sf)))


def _domain_sql() -> str:
    imp = {c: f"coalesce(lab.{c}, p.med_{i})" for i, c in enumerate(NUM)}
    e, d, pr, r, rp = (imp[c] for c in NUM)
    soil = soil_domain_sql("lab.soil_group")
    e01 = f"(CASE WHEN {e} < 0.1e0 THEN 0.1e0 ELSE {e} END)"
    e05 = f"(CASE WHEN {e} < 0.5e0 THEN 0.5e0 ELSE {e} END)"
    e00 = f"(CASE WHEN {e} < 0.0e0 THEN 0.0e0 ELSE {e} END)"
    return (
        f"{base_cte()}, {params_cte()} SELECT {', '.join('lab.' + k.strip() for k in KEYS.split(','))}, "
        + ", ".join([
            _r(f"(1.0e0 / ({d} + 1e-5)) * (1.0e0 / {e01})", "G1_drainage_deficit"),
            _r(f"{pr} / ({d} + 1e-5)", "G1_infra_vuln"),
            _r(f"{r} / ({d} + 1e-5)", "G2_hydraulic_stress"),
            _r(f"{r} * {rp} / sqrt({e05})", "G2_flood_accum"),
            _r(f"{r} * ({soil} + 1.0e0) / 4.0e0", "G3_effective_runoff"),
            _r(f"({soil} + 1.0e0) / ({e05} + 1.0e0)", "G3_soil_elev_risk"),
            "CAST(abs(lab.latitude) < 23.5e0 AS INTEGER) AS G5_is_tropical",
            _r("abs(lab.latitude)", "G5_abs_latitude"),
            _r(f"ln(1 + {e00})", "G6_log_elevation"),
            _r(f"ln(1 + {r})", "G6_log_rainfall"),
            _r(f"ln(1 + {r} * {rp})", "G6_log_rain_x_return"),
        ])
        + " FROM lab CROSS JOIN p"
    )


DOMAIN_OUT = [c for g in ("G1", "G2", "G3", "G5", "G6") for c in C.DOMAIN_GROUP_COLS[g]]


@register("domain_features", _domain_sql())
def q_domain_features(spark, sf):
    raw = segments(spark, sf)
    params = clean.fit_medians(clean.apply_sentinel(raw), NUM)
    return rnd(prepare.domain_transform(raw, params).select(*KEY_LIST, *DOMAIN_OUT))


# ------------------------------------------------------- splits and folds ---
def _rank_sql(seed: int) -> str:
    return (
        f"row_number() OVER (PARTITION BY risk_class ORDER BY {hash_sql(HASH_KEYS, seed)}, {KEYS}) - 1"
    )


def _split_sql() -> str:
    return (
        f"{base_cte()}, cnt AS (SELECT risk_class, count(*) AS n_c FROM lab GROUP BY risk_class), "
        "tot AS (SELECT sum(n_c) AS n, CAST(ceil(0.2e0 * sum(n_c)) AS BIGINT) AS draws FROM cnt), "
        "ex AS (SELECT risk_class, n_c * draws / n AS x, floor(n_c * draws / n) AS b, draws FROM cnt, tot), "
        "rk AS (SELECT *, row_number() OVER (ORDER BY x - b DESC, risk_class) AS r, draws - sum(b) OVER () AS left_ FROM ex), "
        "quota AS (SELECT risk_class, b + CASE WHEN r <= left_ THEN 1 ELSE 0 END AS q FROM rk), "
        f"ranked AS (SELECT {KEYS}, risk_class, {_rank_sql(SEED)} AS rk FROM lab) "
        f"SELECT {KEYS}, ranked.risk_class, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split "
        "FROM ranked JOIN quota USING (risk_class)"
    )


#: What a preparation reads beside the keys and the class.
PREP_COLS = ["risk_class_encoded", "latitude", "longitude", *C.NUMERIC_COLS, *C.CATEGORICAL_COLS]


def seg_split(spark, sf, cols: list[str] | None = None) -> DataFrame:
    """Labelled segments (``cols`` beside the keys and the class, or all) with their
    split; the split writes the rows out, as every consumer fits on one part and
    applies to the other (several passes)."""
    d = seg_labelled(spark, sf)
    d = d if cols is None else d.select(*dict.fromkeys([*KEY_LIST, *HASH_KEYS, "risk_class", *cols]))
    return folds.stratified_split(d, "risk_class", HASH_KEYS, KEY_LIST, 0.2, SEED)


@register("stratified_split", _split_sql())
def q_stratified_split(spark, sf):
    return folds.stratified_split(
        seg_labelled(spark, sf).select(*dict.fromkeys([*KEY_LIST, *HASH_KEYS, "risk_class"])), "risk_class", HASH_KEYS, KEY_LIST, 0.2, SEED
    ).select(*KEY_LIST, "risk_class", "split")


def _folds_sql(k: int = 5, repeats: int = 2) -> str:
    parts = [
        f"SELECT {KEYS}, risk_class, {r} AS repeat, CAST(({_rank_sql(SEED + 1000003 * r)}) % {k} AS INTEGER) AS fold FROM lab"
        for r in range(repeats)
    ]
    return f"{base_cte()} " + _union_sql(parts)


@register("stratified_folds", _folds_sql())
def q_stratified_folds(spark, sf):
    keys = seg_labelled(spark, sf).select(*dict.fromkeys([*KEY_LIST, *HASH_KEYS, "risk_class"]))
    d = folds.stratified_folds(keys, "risk_class", HASH_KEYS, KEY_LIST, k=5, repeats=2, seed=SEED)
    return d.select(*KEY_LIST, "risk_class", "repeat", "fold")


# ---------------------------------------------------------------- metrics ---
RULE_T1, RULE_T2 = 30.0, 60.0  # baseline rule model: rainfall thresholds
RULE_SQL = "CAST(CASE WHEN historical_rainfall_intensity_mm_hr >= 60.0e0 THEN 2 WHEN historical_rainfall_intensity_mm_hr >= 30.0e0 THEN 1 ELSE 0 END AS INTEGER)"


def rule_predictions(spark, sf) -> DataFrame:
    d = seg_labelled(spark, sf)
    return d.withColumn("prediction", X.threshold_classes("historical_rainfall_intensity_mm_hr", RULE_T1, RULE_T2))


def _cm_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    grid_src = f"(SELECT DISTINCT {group} FROM lab)" if group else "(SELECT 1 AS one)"
    using = f"{group}, label, prediction" if group else "label, prediction"
    return (
        f"{base_cte()}, pr AS (SELECT *, {RULE_SQL} AS prediction FROM lab), "
        f"c AS (SELECT {g}risk_class_encoded AS label, prediction, CAST(count(*) AS DOUBLE) AS n FROM pr GROUP BY ALL), "
        f"grid AS (SELECT {g}l.label, p.prediction FROM {grid_src} g0, (SELECT unnest([0,1,2]) AS label) l, "
        "(SELECT unnest([0,1,2]) AS prediction) p), "
        f"cm AS (SELECT {g}CAST(grid.label AS INTEGER) AS label, CAST(grid.prediction AS INTEGER) AS prediction, coalesce(c.n, 0.0e0) AS n "
        f"FROM grid LEFT JOIN c USING ({using}))"
    )


@register("rule_confusion_by_land_use", _cm_sql("land_use") + " SELECT land_use, label, prediction, round(n, 6) AS n FROM cm")
def q_rule_confusion(spark, sf):
    return rnd(metrics.confusion(rule_predictions(spark, sf), "risk_class_encoded", "prediction", group_cols=["land_use"]))


def _per_class_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gp = f"PARTITION BY {group}, " if group else "PARTITION BY "
    return (
        f"{_cm_sql(group)}, pc0 AS (SELECT {g}label, "
        "sum(n) FILTER (WHERE label = prediction) OVER (" + gp + "label) AS tp0, "
        "sum(n) OVER (" + gp + "label) AS support, n, prediction FROM cm), "
        f"pp AS (SELECT {g}prediction AS label, sum(n) AS predicted FROM cm GROUP BY ALL), "
        f"pc1 AS (SELECT DISTINCT {g}label, "
        f"sum(CASE WHEN label = prediction THEN n ELSE 0 END) OVER ({gp}label) AS tp, sum(n) OVER ({gp}label) AS support FROM cm), "
        f"pc AS (SELECT pc1.*, pp.predicted, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0e0 END AS precision, "
        "CASE WHEN support > 0 THEN tp / support ELSE 0.0e0 END AS recall FROM pc1 JOIN pp USING ("
        + (f"{group}, label" if group else "label") + ")), "
        "pcf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0e0 * precision * recall / (1.0e0 * precision + recall) ELSE 0.0e0 END AS f1, "
        "CASE WHEN precision + recall > 0 THEN 5.0e0 * precision * recall / (4.0e0 * precision + recall) ELSE 0.0e0 END AS f2 FROM pc)"
    )


@register(
    "rule_per_class_report",
    _per_class_sql(None) + " SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
    "round(f2, 6) AS f2, round(support, 6) AS support FROM pcf",
)
def q_rule_per_class(spark, sf):
    cm = metrics.confusion(rule_predictions(spark, sf), "risk_class_encoded", "prediction")
    return rnd(metrics.per_class(cm))


@register(
    "rule_metrics_by_land_use",
    _per_class_sql("land_use") + " SELECT land_use, round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro, "
    "round(avg(f1), 6) AS f1_macro, round(avg(f2), 6) AS f2_macro, "
    "round(CASE WHEN sum(support) > 0 THEN sum(f1 * support) / sum(support) ELSE 0.0e0 END, 6) AS f1_weighted, "
    "round(CASE WHEN sum(support) > 0 THEN sum(f2 * support) / sum(support) ELSE 0.0e0 END, 6) AS f2_weighted, "
    "round(max(recall) FILTER (WHERE label = 0), 6) AS recall_low, round(max(recall) FILTER (WHERE label = 1), 6) AS recall_medium, "
    "round(max(recall) FILTER (WHERE label = 2), 6) AS recall_high, "
    "round(CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0e0 END, 6) AS accuracy FROM pcf GROUP BY land_use",
)
def q_rule_metrics(spark, sf):
    cm = metrics.confusion(rule_predictions(spark, sf), "risk_class_encoded", "prediction", group_cols=["land_use"])
    return rnd(metrics.summary(cm, ["land_use"]))


@register(
    "balanced_class_weights",
    f"{base_cte()}, c AS (SELECT risk_class_encoded, count(*) AS n_c FROM lab GROUP BY risk_class_encoded) "
    "SELECT risk_class_encoded, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM c",
)
def q_balanced_class_weights(spark, sf):
    return rnd(metrics.balanced_weights(seg_labelled(spark, sf), "risk_class_encoded"))


@register(
    "toxic_class_weights",
    "WITH c AS (SELECT toxic, count(*) AS n_c FROM labels GROUP BY toxic) "
    "SELECT toxic, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM c",
)
def q_toxic_class_weights(spark, sf):
    return rnd(metrics.balanced_weights(read_table(spark, sf, "labels"), "toxic"))


@register(
    "initial_scores",
    f"{base_cte()}, c AS (SELECT risk_class_encoded, count(*) AS n_c FROM lab GROUP BY risk_class_encoded), "
    "s AS (SELECT *, n_c / sum(n_c) OVER () AS prior FROM c) "
    "SELECT risk_class_encoded, n_c, round(prior, 6) AS prior, round(ln(prior), 6) AS log_prior, "
    "round(ln(prior / (1 - prior)), 6) AS logit FROM s",
)
def q_initial_scores(spark, sf):
    return rnd(metrics.initial_scores(seg_labelled(spark, sf), "risk_class_encoded"))


@register(
    "impurity_by_city",
    f"{base_cte()}, c AS (SELECT city_name, risk_class_encoded, count(*) AS n_c FROM lab GROUP BY ALL), "
    "s AS (SELECT *, n_c / sum(n_c) OVER (PARTITION BY city_name) AS p FROM c) "
    "SELECT city_name, sum(n_c) AS n, round(1 - sum(p * p), 6) AS gini, round(-sum(p * log2(p)), 6) AS entropy, "
    "arg_min(risk_class_encoded, (-n_c, risk_class_encoded)) AS majority FROM s GROUP BY city_name",
)
def q_impurity_by_city(spark, sf):
    return rnd(metrics.impurity(seg_labelled(spark, sf), "risk_class_encoded", ["city_name"]))


# ------------------------------------------------- threshold search (W16) ---
def _threshold_sql(score: str, num: int = 50) -> str:
    return (
        f"{base_cte()}, mm AS (SELECT min({score}) AS lo, max({score}) AS hi FROM lab), "
        f"c AS (SELECT i, CASE WHEN i = {num - 1} THEN hi ELSE lo + i * ((hi - lo) / {num - 1}) END AS c FROM mm, range({num}) t(i)), "
        f"b AS (SELECT risk_class_encoded AS y, (SELECT count(*) FROM c WHERE c.c <= lab.{score}) AS bucket FROM lab), "
        "h AS (SELECT y, bucket, CAST(count(*) AS DOUBLE) AS w FROM b GROUP BY y, bucket), "
        f"pairs AS (SELECT a.i AS i, b2.i AS j FROM range({num}) a(i), range({num}) b2(i) WHERE a.i < b2.i), "
        "cm AS (SELECT i, j, y, CASE WHEN bucket >= j + 1 THEN 2 WHEN bucket >= i + 1 THEN 1 ELSE 0 END AS p, sum(w) AS n FROM pairs, h GROUP BY ALL), "
        "agg AS (SELECT i, j, "
        + ", ".join(
            f"sum(CASE WHEN y = {k} AND p = {k} THEN n ELSE 0.0e0 END) AS tp{k}, sum(CASE WHEN y = {k} THEN n ELSE 0.0e0 END) AS s{k}, "
            f"sum(CASE WHEN p = {k} THEN n ELSE 0.0e0 END) AS q{k}"
            for k in range(3)
        )
        + " FROM cm GROUP BY i, j), "
        "pr AS (SELECT i, j, "
        + ", ".join(
            f"CASE WHEN q{k} > 0 THEN tp{k} / q{k} ELSE 0.0e0 END AS p{k}, CASE WHEN s{k} > 0 THEN tp{k} / s{k} ELSE 0.0e0 END AS r{k}"
            for k in range(3)
        )
        + " FROM agg), f AS (SELECT i, j, ("
        + " + ".join(f"CASE WHEN (p{k} + r{k}) > 0 THEN (1 + 4.0e0) * p{k} * r{k} / (4.0e0 * p{k} + r{k}) ELSE 0.0e0 END" for k in range(3))
        + ") / 3.0e0 AS score FROM pr), best AS (SELECT * FROM f ORDER BY score DESC, i, j LIMIT 1) "
        "SELECT round(c1.c, 6) AS t1, round(c2.c, 6) AS t2, round(score, 6) AS f2_macro FROM best JOIN c c1 ON c1.i = best.i JOIN c c2 ON c2.i = best.j"
    )


@register("threshold_search_rainfall", _threshold_sql("historical_rainfall_intensity_mm_hr"))
def q_threshold_search(spark, sf):
    from ..operators import linear

    return rnd(linear.threshold_search(seg_labelled(spark, sf), "historical_rainfall_intensity_mm_hr", "risk_class_encoded"))


# --------------------------------------------------------- split finding ---
SPLIT_FEATURES = ["elevation_m", "drainage_density_km_per_km2", "storm_drain_proximity_m",
                  "historical_rainfall_intensity_mm_hr", "return_period_years"]


def _imputed_sql_cte() -> str:
    imp = ", ".join(f"coalesce(lab.{c}, p.med_{i}) AS {c}" for i, c in enumerate(NUM))
    return f"{base_cte()}, {params_cte()}, imp AS (SELECT {KEYS}, risk_class_encoded, {imp} FROM lab CROSS JOIN p)"


def seg_imputed(spark, sf) -> DataFrame:
    """Median-imputed numeric features with keys and label, written out for the
    multi-pass split searches."""
    from ..session import keep_rows

    d = seg_clean(spark, sf)
    params = clean.fit_medians(d, NUM)
    d = clean.drop_params(clean.impute(clean.attach_params(d, params), categorical_cols=[]), params)
    return keep_rows(d.select(*KEY_LIST, "risk_class_encoded", *NUM))


@register(
    "gini_root_split",
    _imputed_sql_cte() + ", l AS ("
    + _union_sql([f"SELECT {i + 1} AS fidx, '{c}' AS feature, {c} AS value, risk_class_encoded AS y FROM imp" for i, c in enumerate(SPLIT_FEATURES)])
    + "), cnt AS (SELECT fidx, feature, value, " + ", ".join(f"count(*) FILTER (WHERE y = {k}) AS c{k}" for k in range(3))
    + " FROM l GROUP BY ALL), cum AS (SELECT fidx, feature, value AS threshold, "
    + ", ".join(f"sum(c{k}) OVER (PARTITION BY fidx ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l{k}" for k in range(3)) + ", "
    + ", ".join(f"sum(c{k}) OVER (PARTITION BY fidx) AS t{k}" for k in range(3))
    + " FROM cnt), c2 AS (SELECT *, 0 + l0 + l1 + l2 AS n_L, 0 + t0 + t1 + t2 AS n FROM cum), c3 AS (SELECT *, n - n_L AS n_R FROM c2 WHERE n_L >= 1 AND n - n_L >= 1), "
    "c4 AS (SELECT *, (n_L / n) * (1.0e0 - (0.0e0 + (l0 / n_L) * (l0 / n_L) + (l1 / n_L) * (l1 / n_L) + (l2 / n_L) * (l2 / n_L))) + "
    "(n_R / n) * (1.0e0 - (0.0e0 + ((t0 - l0) / n_R) * ((t0 - l0) / n_R) + ((t1 - l1) / n_R) * ((t1 - l1) / n_R) + ((t2 - l2) / n_R) * ((t2 - l2) / n_R))) AS impurity FROM c3) "
    "SELECT feature, round(threshold, 6) AS threshold, round(impurity, 6) AS impurity, n_L, n_R FROM c4 ORDER BY impurity, fidx, threshold LIMIT 1",
)
def q_gini_root_split(spark, sf):
    from ..operators import trees

    return rnd(trees.exhaustive_best_split(seg_imputed(spark, sf), SPLIT_FEATURES, "risk_class_encoded"))


@register(
    "conflict_matrix",
    _imputed_sql_cte() + " "
    + _union_sql([
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(count(*) FILTER (WHERE {a} <> 0 AND {b} <> 0) / count(*), 6) AS conflict_rate FROM imp"
        for i, a in enumerate(SPLIT_FEATURES) for b in SPLIT_FEATURES[i + 1:]
    ]),
)
def q_conflict_matrix(spark, sf):
    from ..operators import trees

    return rnd(trees.conflict_matrix(seg_imputed(spark, sf), SPLIT_FEATURES))


@register(
    "normal_equation_moments",
    _imputed_sql_cte() + " "
    + _union_sql(
        ["SELECT 'sw' AS term, -1 AS i, -1 AS j, round(sum(1.0e0) / count(*), 6) AS value FROM imp",
         "SELECT 'swy' AS term, -1 AS i, -1 AS j, round(sum(CAST(risk_class_encoded AS DOUBLE)) / count(*), 6) AS value FROM imp",
         "SELECT 'swyy' AS term, -1 AS i, -1 AS j, round(sum(CAST(risk_class_encoded AS DOUBLE) * risk_class_encoded) / count(*), 6) AS value FROM imp"]
        + [f"SELECT 'swx' AS term, {i} AS i, -1 AS j, round(sum({a}) / count(*), 6) AS value FROM imp" for i, a in enumerate(SPLIT_FEATURES)]
        + [f"SELECT 'swxy' AS term, {i} AS i, -1 AS j, round(sum({a} * risk_class_encoded) / count(*), 6) AS value FROM imp" for i, a in enumerate(SPLIT_FEATURES)]
        + [f"SELECT 'swxx' AS term, {i} AS i, {j} AS j, round(sum({a} * {b}) / count(*), 6) AS value FROM imp"
           for i, a in enumerate(SPLIT_FEATURES) for j, b in enumerate(SPLIT_FEATURES) if j >= i]
    ),
)
def q_normal_equation_moments(spark, sf):
    """A31 sums divided by the total weight (scale-free for the value check)."""
    from pyspark.sql import Window

    from ..operators import linear

    s = linear.normal_sums(seg_imputed(spark, sf), SPLIT_FEATURES, "risk_class_encoded")
    # the sums table has (d+1)(d+2)/2 + 2d + 1 rows: a global window over it is tiny
    sw = F.max(F.when(F.col("term") == "sw", F.col("value"))).over(Window.partitionBy())
    return s.withColumn("value", F.round(F.col("value") / sw, 6))


# ----------------------------------------------------------- encoders ------


# ----------------------------------------------- histogram split (W11, W12) ---
HIST_BINS = 16


def _hist_split_sql(max_bin: int = HIST_BINS) -> str:
    probs = "[" + ", ".join(repr(i / max_bin) for i in range(max_bin + 1)) + "]"
    edges = _union_sql([
        f"SELECT {i + 1} AS fidx, '{c}' AS feature, list_sort(list_distinct(quantile_cont({c}, {probs}))) AS e FROM imp"
        for i, c in enumerate(SPLIT_FEATURES)
    ])
    longs = _union_sql([
        f"SELECT {i + 1} AS fidx, imp.risk_class_encoded AS y, "
        f"CAST(len(list_filter(e[2:len(e) - 1], lambda x: x <= imp.{c})) AS INTEGER) AS bin FROM imp, edges WHERE edges.fidx = {i + 1}"
        for i, c in enumerate(SPLIT_FEATURES)
    ])
    return (
        _imputed_sql_cte()
        + f", edges AS ({edges}), l AS ({longs}), "
        "pri AS (SELECT y AS cls, count(*) / sum(count(*)) OVER () AS p FROM imp_y GROUP BY y), "
        "gl AS (SELECT pri.cls, l.fidx, l.bin, pri.p - CASE WHEN l.y = pri.cls THEN 1.0e0 ELSE 0.0e0 END AS g, pri.p * (1.0e0 - pri.p) AS h FROM l, pri), "
        "hist AS (SELECT cls, fidx, bin, sum(g) AS gb, sum(h) AS hb, count(*) AS nb FROM gl GROUP BY ALL), "
        "cum AS (SELECT cls, fidx, bin, "
        "sum(gb) OVER (PARTITION BY cls, fidx ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gL, "
        "sum(hb) OVER (PARTITION BY cls, fidx ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hL, "
        "sum(nb) OVER (PARTITION BY cls, fidx ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nL, "
        "sum(gb) OVER (PARTITION BY cls, fidx) AS g, sum(hb) OVER (PARTITION BY cls, fidx) AS h, sum(nb) OVER (PARTITION BY cls, fidx) AS n FROM hist), "
        "c2 AS (SELECT *, g - gL AS gR, h - hL AS hR, n - nL AS nR FROM cum), "
        "c3 AS (SELECT *, 0.5e0 * (gL * gL / (hL + 1.0e0) + gR * gR / (hR + 1.0e0) - (gL + gR) * (gL + gR) / (hL + hR + 1.0e0)) AS gain FROM c2), "
        "c4 AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY gain DESC, fidx, bin) AS rn FROM c3 WHERE nL >= 20 AND nR >= 20 AND gain > 0.0e0) "
        "SELECT CAST(cls AS INTEGER) AS cls, e.feature, bin, round(gain, 6) AS gain, nL AS n_L, nR AS n_R FROM c4 JOIN edges e USING (fidx) WHERE rn = 1"
    ).replace("FROM imp_y GROUP BY y", "FROM (SELECT risk_class_encoded AS y FROM imp) GROUP BY y")


@register("histogram_root_split", _hist_split_sql())
def q_histogram_root_split(spark, sf):
    """One boosting round's root split per class: softmax gradients at the prior
    (g = p_c - y_c, h = p_c (1 - p_c)), quantile bins, best histogram split."""
    from ..operators import trees

    d = seg_imputed(spark, sf)
    edges = trees.quantile_bin_edges(d, SPLIT_FEATURES, HIST_BINS)
    binned = trees.bin_features(d, edges)
    prior = metrics.initial_scores(d, "risk_class_encoded").select(F.col("risk_class_encoded").alias("cls"), "prior")
    # one row per class: the prior table is tiny, replicate rows per class by explode
    pri = {r["cls"]: r["prior"] for r in prior.collect()}
    cls_arr = F.array(*[F.struct(F.lit(int(k)).alias("cls"), F.lit(float(v)).alias("p")) for k, v in sorted(pri.items())])
    g = binned.select("*", F.explode(cls_arr).alias("_c")).select(
        "*", F.col("_c.cls").alias("cls"), F.col("_c.p").alias("p")
    )
    y = (F.col("risk_class_encoded") == F.col("cls")).cast("double")
    g = g.withColumn("g", F.col("p") - y).withColumn("h", F.col("p") * (1.0 - F.col("p")))
    best = trees.histogram_best_split(g, [c + "_bin" for c in SPLIT_FEATURES], group_cols=["cls"])
    return rnd(best.withColumn("feature", F.regexp_replace("feature", "_bin$", "")))


# -------------------------------------------------- percentile ranks (T10) ---
def _pct_sql() -> str:
    e, r = "elevation_m", "historical_rainfall_intensity_mm_hr"
    split = _split_sql()
    split = split[: split.rindex("SELECT " + KEYS)]  # keep the CTEs
    med_e = "(SELECT quantile_cont(elevation_m, 0.5) FROM lab JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) WHERE split = 'train')"
    body = (
        f"sp AS (SELECT {KEYS}, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)), "
        f"d AS (SELECT {', '.join('lab.' + k.strip() for k in KEYS.split(','))}, sp.split, coalesce(lab.{e}, {med_e}) AS e, lab.{r} AS r "
        "FROM lab JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)), "
        "tr AS (SELECT * FROM d WHERE split = 'train'), te AS (SELECT * FROM d WHERE split = 'test'), "
        "ntr AS (SELECT count(*) - 1 AS m FROM tr), "
        "trr AS (SELECT *, (row_number() OVER (ORDER BY e, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) / (SELECT greatest(m, 1) FROM ntr) AS pe, "
        "(row_number() OVER (ORDER BY r, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) / (SELECT greatest(m, 1) FROM ntr) AS pr FROM tr), "
    )
    for col in ("e", "r"):
        body += (
            f"tv_{col} AS (SELECT {col} AS v, min(pos) AS first_pos, max(pos) AS last_pos FROM "
            f"(SELECT {col}, row_number() OVER (ORDER BY {col}) - 1 AS pos FROM tr) GROUP BY {col}), "
            f"lo_{col} AS (SELECT te.*, tv.v AS lo_v, tv.last_pos AS lo_last FROM te ASOF LEFT JOIN tv_{col} tv ON te.{col} >= tv.v), "
            f"hi_{col} AS (SELECT lo_{col}.*, tv.v AS hi_v, tv.first_pos AS hi_first FROM lo_{col} ASOF LEFT JOIN "
            f"(SELECT -v AS nv, v, first_pos FROM tv_{col}) tv ON -lo_{col}.{col} >= tv.nv), "
            f"ip_{col} AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE WHEN lo_v IS NULL THEN 0.0e0 "
            f"WHEN hi_v IS NULL AND lo_v < {col} THEN 1.0e0 WHEN lo_v = {col} THEN lo_last / (SELECT greatest(m, 1) FROM ntr) "
            f"ELSE (lo_last + (hi_first - lo_last) * ({col} - lo_v) / (hi_v - lo_v)) / (SELECT greatest(m, 1) FROM ntr) END AS p FROM hi_{col}), "
        )
    body += (
        "ter AS (SELECT te.*, ip_e.p AS pe, ip_r.p AS pr FROM te JOIN ip_e USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) "
        "JOIN ip_r USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)), "
        "allr AS (SELECT * FROM trr UNION ALL SELECT * FROM ter) "
        f"SELECT {KEYS}, split, round(pe, 6) AS G4_elev_pct_rank, round(pr, 6) AS G4_rain_pct_rank, "
        "round((1.0e0 - pe) * pr, 6) AS G4_compound_extreme FROM allr"
    )
    return split + ", " + body


@register("percentile_rank_features", _pct_sql())
def q_percentile_rank_features(spark, sf):
    sp = seg_split(spark, sf, ["elevation_m", "historical_rainfall_intensity_mm_hr"])
    sp = clean.apply_sentinel(sp)
    train = sp.where(F.col("split") == "train")
    med = clean.fit_medians(train, ["elevation_m"])
    sp = clean.drop_params(clean.impute(clean.attach_params(sp, med), ["elevation_m"], []), med)
    cols = [*KEY_LIST, "split", "elevation_m", "historical_rainfall_intensity_mm_hr"]
    sp = sp.select(*cols)
    tr, te = features.percentile_rank_features(
        sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test"), KEY_LIST
    )
    out = [*KEY_LIST, "split", "G4_elev_pct_rank", "G4_rain_pct_rank", "G4_compound_extreme"]
    return rnd(tr.select(*out).unionByName(te.select(*out)))


@register(
    "average_rank_rainfall",
    f"{base_cte()} SELECT {KEYS}, round((rank() OVER (ORDER BY historical_rainfall_intensity_mm_hr) + "
    "(count(*) OVER (PARTITION BY historical_rainfall_intensity_mm_hr) - 1) / 2.0e0) / count(*) OVER (), 6) AS rain_avg_rank FROM lab",
)
def q_average_rank_rainfall(spark, sf):
    d = seg_labelled(spark, sf).select(*KEY_LIST, "historical_rainfall_intensity_mm_hr")
    out = features.average_rank(d, "historical_rainfall_intensity_mm_hr", "rain_avg_rank")
    return rnd(out.select(*KEY_LIST, "rain_avg_rank"))


# ------------------------------------------- cross-validation result tables ---
from . import ablation, experiment, final  # noqa: E402
from .sqltext import cls_metrics_sql  # noqa: E402

CV_REPEATS, CV_K = 2, 5
SUMMARY_COLS = ["precision_macro", "recall_macro", "f1_macro", "f2_macro", "f1_weighted", "f2_weighted",
                "recall_low", "recall_medium", "recall_high", "accuracy"]


def _cv_cte() -> str:
    fo = _union_sql([
        f"SELECT risk_class_encoded, historical_rainfall_intensity_mm_hr AS rain, {r} AS repeat, "
        f"CAST(({_rank_sql(SEED + 1000003 * r)}) % {CV_K} AS INTEGER) AS fold FROM lab"
        for r in range(CV_REPEATS)
    ])
    mdl = ", ".join(f"('{k}', {a}e0, {b}e0)" for k, (a, b) in experiment.RULE_MODELS.items())
    keys = ["model", "repeat", "fold"]
    return (
        f"{base_cte()}, fo AS ({fo}), mdl AS (SELECT * FROM (VALUES {mdl}) t(model, t1, t2)), "
        "pr AS (SELECT model, repeat, fold, risk_class_encoded AS y, CASE WHEN rain >= t2 THEN 2 WHEN rain >= t1 THEN 1 ELSE 0 END AS p FROM fo, mdl), "
        "cv AS (SELECT model, repeat, fold, y, p, CAST(count(*) AS DOUBLE) AS n FROM pr GROUP BY ALL), "
        "grid AS (SELECT g.model, g.repeat, g.fold, yy.y, pp.p FROM (SELECT DISTINCT model, repeat, fold FROM cv) g, "
        "(SELECT unnest([0, 1, 2]) AS y) yy, (SELECT unnest([0, 1, 2]) AS p) pp), "
        "cm AS (SELECT grid.*, coalesce(cv.n, 0.0e0) AS nv FROM grid LEFT JOIN cv USING (model, repeat, fold, y, p)), "
        "cm2 AS (SELECT *, sum(nv) OVER (PARTITION BY model, repeat, y, p) - nv AS nt FROM cm), "
        f"val AS ({cls_metrics_sql('cm2', keys, 'nv')}), "
        f"tr AS (SELECT model, repeat, fold, f2_macro AS train_f2_macro FROM ({cls_metrics_sql('cm2', keys, 'nt')})), "
        "fm AS (SELECT * FROM val JOIN tr USING (model, repeat, fold))"
    )


def cv_preds(spark, sf) -> DataFrame:
    used = seg_labelled(spark, sf).select(*dict.fromkeys([*KEY_LIST, *HASH_KEYS, "risk_class", "risk_class_encoded", "historical_rainfall_intensity_mm_hr"]))
    d = folds.stratified_folds(used, "risk_class", HASH_KEYS, KEY_LIST, k=CV_K, repeats=CV_REPEATS, seed=SEED)
    return experiment.rule_predictions(d, "historical_rainfall_intensity_mm_hr", "risk_class_encoded")


def cv_fold_table(spark, sf) -> DataFrame:
    from ..operators.order import materialize_small

    return materialize_small(experiment.cv_fold_metrics(cv_preds(spark, sf)))


@register(
    "cv_fold_metrics",
    _cv_cte() + " SELECT model, repeat, fold, " + ", ".join(f"round({c}, 6) AS {c}" for c in SUMMARY_COLS + ["train_f2_macro"]) + " FROM fm",
)
def q_cv_fold_metrics(spark, sf):
    return rnd(cv_fold_table(spark, sf))


_LB_COLS = ["f2_macro", "f1_weighted", "recall_high", "train_f2_macro"]


def _cv_summary_sql() -> str:
    aggs = ", ".join(f"round(avg({c}), 4) AS {c}_mean, round(stddev_pop({c}), 4) AS {c}_std" for c in _LB_COLS)
    return (
        f"{_cv_cte()}, sm AS (SELECT model, {aggs}, count(*) AS n_folds FROM fm GROUP BY model), "
        "sm2 AS (SELECT *, round(train_f2_macro_mean - f2_macro_mean, 4) AS gap FROM sm), "
        "sm3 AS (SELECT *, CAST(gap > 0.1e0 AS INTEGER) AS overfit, CASE WHEN gap > 0.1e0 THEN 'high' WHEN gap > 0.05e0 THEN 'moderate' ELSE 'low' END AS overfit_risk FROM sm2)"
    )


@register(
    "cv_leaderboard",
    _cv_summary_sql() + " SELECT *, CAST(row_number() OVER (ORDER BY f2_macro_mean DESC, f1_weighted_mean DESC, model) AS INTEGER) AS rank, "
    "CAST(row_number() OVER (ORDER BY f2_macro_mean DESC, f1_weighted_mean DESC, model) <= 2 AS INTEGER) AS is_top FROM sm3",
)
def q_cv_leaderboard(spark, sf):
    s = experiment.cv_summary(cv_fold_table(spark, sf))
    return rnd(ranking.leaderboard(s, ["f2_macro_mean", "f1_weighted_mean"], ["model"], top_k=2))


@register(
    "cv_winner",
    _cv_summary_sql() + " SELECT model, f2_macro_mean, f2_macro_std, f1_weighted_mean, recall_high_mean FROM sm3 "
    "ORDER BY f2_macro_mean DESC, f1_weighted_mean DESC, recall_high_mean DESC, f2_macro_std ASC, model LIMIT 1",
)
def q_cv_winner(spark, sf):
    s = experiment.cv_summary(cv_fold_table(spark, sf))
    return rnd(experiment.winner(s).select("model", "f2_macro_mean", "f2_macro_std", "f1_weighted_mean", "recall_high_mean"))


@register(
    "cv_delta_vs_baseline",
    _cv_cte() + ", b AS (SELECT *, max(CASE WHEN model = 'rain_30_60' THEN f2_macro END) OVER (PARTITION BY repeat, fold) AS baseline_value FROM fm) "
    "SELECT model, repeat, fold, round(f2_macro, 6) AS f2_macro, round(baseline_value, 6) AS baseline_value, "
    "round(f2_macro - baseline_value, 6) AS delta, round(CASE WHEN baseline_value <> 0 THEN (f2_macro - baseline_value) * 100.0e0 / baseline_value END, 6) AS improvement_pct, "
    "CAST(f2_macro - baseline_value > 0 AS INTEGER) AS beats_baseline FROM b",
)
def q_cv_delta_vs_baseline(spark, sf):
    fm = cv_fold_table(spark, sf).select("model", "repeat", "fold", "f2_macro")
    return rnd(ranking.delta_vs_baseline(fm, ["repeat", "fold"], "model", "rain_30_60", "f2_macro"))


@register(
    "cv_pivot_f2_by_repeat",
    _cv_cte() + " SELECT model, " + ", ".join(f"round(avg(f2_macro) FILTER (WHERE repeat = {r}), 6) AS r{r}" for r in range(CV_REPEATS)) + " FROM fm GROUP BY model",
)
def q_cv_pivot_f2_by_repeat(spark, sf):
    fm = cv_fold_table(spark, sf).withColumn("rep", F.concat(F.lit("r"), F.col("repeat").cast("string")))
    return rnd(ranking.pivot_mean(fm, "model", "rep", "f2_macro", [f"r{r}" for r in range(CV_REPEATS)]))


@register(
    "cv_best_worst_fold",
    _cv_cte() + ", k AS (SELECT model, repeat * 5 + fold AS fold_key, f2_macro FROM fm), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f2_macro DESC, fold_key) AS rb, "
    "row_number() OVER (PARTITION BY model ORDER BY f2_macro ASC, fold_key) AS rw FROM k) "
    "SELECT model, max(CASE WHEN rb = 1 THEN fold_key END) AS best, round(max(f2_macro), 6) AS best_value, "
    "max(CASE WHEN rw = 1 THEN fold_key END) AS worst, round(min(f2_macro), 6) AS worst_value, "
    "round(max(f2_macro) - min(f2_macro), 6) AS value_range, "
    "round(CASE WHEN min(f2_macro) <> 0 THEN (max(f2_macro) - min(f2_macro)) * 100.0e0 / min(f2_macro) END, 6) AS impact_pct FROM r GROUP BY model",
)
def q_cv_best_worst_fold(spark, sf):
    fm = cv_fold_table(spark, sf).select("model", (F.col("repeat") * 5 + F.col("fold")).alias("fold_key"), "f2_macro")
    return rnd(ranking.best_worst_exact(fm, ["model"], "fold_key", "f2_macro"))


@register(
    "cv_best_fold_per_model",
    _cv_cte() + ", r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f2_macro DESC, recall_high DESC, f1_weighted DESC, repeat, fold) AS rn FROM fm) "
    "SELECT model, repeat, fold, round(f2_macro, 6) AS f2_macro, round(recall_high, 6) AS recall_high, round(f1_weighted, 6) AS f1_weighted FROM r WHERE rn = 1",
)
def q_cv_best_fold_per_model(spark, sf):
    fm = cv_fold_table(spark, sf).select("model", "repeat", "fold", "f2_macro", "recall_high", "f1_weighted")
    return rnd(ranking.first_per_group(fm, ["model"], ["f2_macro", "recall_high", "f1_weighted"], ["repeat", "fold"]))


@register(
    "cv_top_folds",
    _cv_cte() + " SELECT model, repeat, fold, round(f2_macro, 6) AS f2_macro FROM fm ORDER BY f2_macro DESC, model, repeat, fold LIMIT 5",
)
def q_cv_top_folds(spark, sf):
    fm = cv_fold_table(spark, sf).select("model", "repeat", "fold", "f2_macro")
    return rnd(ranking.top_n(fm, "f2_macro", 5, ["model", "repeat", "fold"]))


@register(
    "cv_per_class_report",
    _cv_cte() + ", pcs AS ("
    + _union_sql([
        f"SELECT model, repeat, fold, {c} AS cls, sum(CASE WHEN y = {c} AND p = {c} THEN nv ELSE 0.0e0 END) AS tp, "
        f"sum(CASE WHEN y = {c} THEN nv ELSE 0.0e0 END) AS sup, sum(CASE WHEN p = {c} THEN nv ELSE 0.0e0 END) AS pred FROM cm2 GROUP BY model, repeat, fold"
        for c in range(3)
    ])
    + "), "
    "pc AS (SELECT *, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0e0 END AS precision, CASE WHEN sup > 0 THEN tp / sup ELSE 0.0e0 END AS recall FROM pcs) "
    "SELECT model, CAST(cls AS INTEGER) AS label, round(avg(precision), 4) AS precision_mean, round(avg(recall), 4) AS recall_mean, "
    "round(avg(CASE WHEN precision + recall > 0 THEN 2.0e0 * precision * recall / (1.0e0 * precision + recall) ELSE 0.0e0 END), 4) AS f1_mean "
    "FROM pc GROUP BY model, cls",
)
def q_cv_per_class_report(spark, sf):
    return rnd(experiment.per_class_cv(cv_preds(spark, sf)))


EXPECTED_MODELS = [*experiment.RULE_MODELS, "rain_10_40", "ridge_ordinal"]


@register(
    "cv_missing_models",
    _cv_cte() + ", e AS (SELECT unnest([" + ", ".join(f"'{m}'" for m in EXPECTED_MODELS) + "]) AS model) "
    "SELECT model FROM e WHERE model NOT IN (SELECT DISTINCT model FROM fm)",
)
def q_cv_missing_models(spark, sf):
    fm = cv_fold_table(spark, sf)
    expected = local_df(spark, [(m,) for m in EXPECTED_MODELS], "model string")
    return ranking.missing_expected(expected, fm, ["model"])


# ------------------------------------------------------------- encoders ---
@register(
    "ordinal_codes_part_brand",
    "WITH fitset AS (SELECT DISTINCT p_brand AS v FROM part WHERE p_size <= 5), "
    "codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM fitset) "
    "SELECT p_partkey, p_brand, coalesce(code, -1.0e0) AS brand_code FROM part LEFT JOIN codes ON codes.v = part.p_brand",
)
def q_ordinal_codes_part_brand(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    codes = encode.fit_ordinal(part.where(F.col("p_size") <= 5), ["p_brand"])
    out = encode.apply_ordinal(part.withColumn("brand_code", F.col("p_brand")), codes.withColumn("feature", F.lit("brand_code")), ["brand_code"])
    return out.select("p_partkey", "p_brand", "brand_code")


# TPC-H domains of the columns behind the stand-in categoricals (fixed, so the
# SQL side can name the one-hot columns).
OHE_DOMAINS = {
    "land_use": ["A", "N", "R"],
    "storm_drain_type": ["F", "O", "Unknown"],
    "rainfall_source": ["1", "2", "3", "4", "5", "6", "7", "Unknown"],
    "dem_source": ["A", "N", "R"],
}


@register(
    "onehot_categoricals",
    f"{base_cte()} SELECT {KEYS}, CAST((CASE coalesce(soil_group, 'Unknown') "
    + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(C.SOIL_ORDER))
    + " ELSE -1 END) AS DOUBLE) AS soil_group, "
    + ", ".join(
        f"CASE WHEN coalesce({c}, 'Unknown') = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS {c}_{v}"
        for c, vs in OHE_DOMAINS.items() for v in vs
    )
    + " FROM lab",
)
def q_onehot_categoricals(spark, sf):
    d = clean.impute(seg_clean(spark, sf), [], C.CATEGORICAL_COLS)
    cats = encode.fit_onehot(d, C.OHE_COLS)
    d = encode.ordinal_with_order(d, "soil_group")
    d = encode.apply_onehot(d, cats)
    return d.select(*KEY_LIST, "soil_group", *[f"{c}_{v}" for c, vs in cats.items() for v in vs])


def _robust_sql() -> str:
    split = _split_sql()
    split = split[: split.rindex("SELECT " + KEYS)]
    imp = ", ".join(f"coalesce(lab.{c}, p.med_{i}) AS {c}" for i, c in enumerate(NUM))
    stats = ", ".join(
        f"quantile_cont({c}, 0.5) AS m_{i}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS r_{i}" for i, c in enumerate(NUM)
    )
    scaled = ", ".join(
        f"round(({c} - s.m_{i}) / CASE WHEN s.r_{i} = 0 THEN 1.0e0 ELSE s.r_{i} END, 6) AS {c}" for i, c in enumerate(NUM)
    )
    return (
        split + ", sp AS (SELECT " + KEYS + ", CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)), "
        + params_cte()
        + f", imp AS (SELECT {', '.join('lab.' + k.strip() for k in KEYS.split(','))}, sp.split, {imp} FROM lab CROSS JOIN p "
        "JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)), "
        f"s AS (SELECT {stats} FROM imp WHERE split = 'train') SELECT {KEYS}, split, {scaled} FROM imp CROSS JOIN s"
    )


@register("robust_scaled_numeric", _robust_sql())
def q_robust_scaled_numeric(spark, sf):
    d = seg_split(spark, sf, NUM)
    d = clean.apply_sentinel(d)
    params = clean.fit_medians(d, NUM)
    d = clean.drop_params(clean.impute(clean.attach_params(d, params), NUM, []), params).select(*KEY_LIST, "split", *NUM)
    sc = encode.fit_robust(d.where(F.col("split") == "train"), NUM)
    return rnd(encode.apply_robust(d, sc, NUM))


YJ_LAMBDAS = {"longitude": 2.0, "latitude": 1.5, "historical_rainfall_intensity_mm_hr": 0.0, "l_extendedprice": -0.5}


def _yj_sql(c: str, lam: float) -> str:
    if lam == 0:
        pos = f"ln(1 + {c})"
    else:
        pos = f"(pow({c} + 1.0e0, {lam}e0) - 1.0e0) / {lam}e0"
    neg = f"-ln(1 - {c})" if lam == 2 else f"-(pow(1.0e0 - {c}, {2 - lam}e0) - 1.0e0) / {2 - lam}e0"
    return f"round(CASE WHEN {c} >= 0 THEN {pos} ELSE {neg} END, 6) AS yj_{c}"


@register(
    "yeo_johnson_fixed",
    f"{base_cte()} SELECT {KEYS}, " + ", ".join(_yj_sql(c, lam) for c, lam in YJ_LAMBDAS.items()) + " FROM lab",
)
def q_yeo_johnson_fixed(spark, sf):
    d = seg_labelled(spark, sf)
    return rnd(d.select(*KEY_LIST, *[X.yeo_johnson(c, lam).alias(f"yj_{c}") for c, lam in YJ_LAMBDAS.items()]))


# ------------------------------------------------------------- losses ------
CENTRES = [15.0, 45.0, 75.0]


def _prob_sql() -> str:
    s = [f"(-abs(historical_rainfall_intensity_mm_hr - {m}e0) / 10.0e0)" for m in CENTRES]
    mx = f"greatest({', '.join(s)})"
    ex = [f"exp({x} - {mx})" for x in s]
    tot = "(" + " + ".join(ex) + ")"
    probs = ", ".join(f"{e} / {tot} AS p{i}" for i, e in enumerate(ex))
    return f"{base_cte()}, pr AS (SELECT risk_class_encoded AS y, {probs} FROM lab), " \
        "pt AS (SELECT y, greatest(least(CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1 - 1e-15), 1e-15) AS p, " \
        "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS am, " \
        "CASE y WHEN 0 THEN 1.0e0 WHEN 1 THEN 1.5e0 WHEN 2 THEN 2.0e0 ELSE 1.0e0 END AS w FROM pr) "


@register(
    "rule_probability_losses",
    _prob_sql() + "SELECT round(avg(-ln(p)), 6) AS log_loss, round(sum(-ln(p) * w) / sum(w), 6) AS weighted_log_loss, "
    "round(avg(-0.25e0 * pow(1 - p, 2.0e0) * ln(p)), 6) AS focal_loss, round(avg(CASE WHEN am = y THEN 1.0e0 ELSE 0.0e0 END), 6) AS argmax_accuracy FROM pt",
)
def q_rule_probability_losses(spark, sf):
    d = seg_labelled(spark, sf)
    scores = F.array(*[-F.abs(F.col("historical_rainfall_intensity_mm_hr") - F.lit(m)) / 10.0 for m in CENTRES])
    d = d.select(F.col("risk_class_encoded").alias("y"), X.softmax(scores).alias("prob"))
    d = d.withColumn("am", X.argmax("prob"))
    ll = metrics.log_loss(d, "y", "prob")
    wl = metrics.log_loss(d, "y", "prob", class_weights=C.DEFAULT_CLASS_WEIGHTS).withColumnRenamed("log_loss", "weighted_log_loss")
    fl = metrics.focal_loss(d, "y", "prob")
    acc = d.agg(F.avg((F.col("am") == F.col("y")).cast("double")).alias("argmax_accuracy"))
    parts = [ll, wl, fl, acc]
    # four one-row aggregates side by side
    out = parts[0].withColumn("_k", F.lit(1))
    for p in parts[1:]:
        out = out.join(p.withColumn("_k", F.lit(1)), "_k")
    return rnd(out.drop("_k"))


@register(
    "labels_binary_losses",
    "WITH p AS (SELECT toxic, 1.0e0 / (1.0e0 + exp(-(2.0e0 * quality - 1.5e0))) AS prob FROM labels), "
    "c AS (SELECT toxic, prob, greatest(least(prob, 1 - 1e-15), 1e-15) AS pc FROM p) "
    "SELECT round(avg(-(toxic * ln(pc) + (1 - toxic) * ln(1 - pc))), 6) AS log_loss, round(avg((toxic - prob) * (toxic - prob)), 6) AS mse FROM c",
)
def q_labels_binary_losses(spark, sf):
    d = read_table(spark, sf, "labels").select("toxic", X.sigmoid(2.0 * F.col("quality") - 1.5).alias("prob"))
    return rnd(metrics.binary_log_loss(d, "toxic", "prob"))


@register(
    "huber_residuals",
    f"{base_cte()}, r AS (SELECT historical_rainfall_intensity_mm_hr / 50.0e0 - risk_class_encoded AS r FROM lab) "
    "SELECT round(avg(CASE WHEN abs(r) <= 1.0e0 THEN 0.5e0 * abs(r) * abs(r) ELSE 1.0e0 * (abs(r) - 0.5e0 * 1.0e0) END), 6) AS huber_loss, "
    "round(avg(r * r), 6) AS squared_error, round(avg(abs(r)), 6) AS abs_error FROM r",
)
def q_huber_residuals(spark, sf):
    d = seg_labelled(spark, sf).select((F.col("historical_rainfall_intensity_mm_hr") / 50.0 - F.col("risk_class_encoded")).alias("r"))
    return rnd(d.agg(F.avg(X.huber_loss("r", 1.0)).alias("huber_loss"), F.avg(F.col("r") * F.col("r")).alias("squared_error"),
                     F.avg(F.abs("r")).alias("abs_error")))


@register(
    "weighted_rule_metrics",
    f"{base_cte()}, pr AS (SELECT risk_class_encoded AS y, {RULE_SQL} AS p, "
    "CASE risk_class_encoded WHEN 0 THEN 1.0e0 WHEN 1 THEN 1.5e0 WHEN 2 THEN 2.0e0 ELSE 1.0e0 END AS w FROM lab), "
    "cm AS (SELECT 1 AS k, y, p, sum(w) AS n FROM pr GROUP BY y, p) SELECT "
    + ", ".join(f"round({c}, 6) AS {c}" for c in SUMMARY_COLS)
    + f" FROM ({cls_metrics_sql('cm', ['k'], 'n')})",
)
def q_weighted_rule_metrics(spark, sf):
    d = rule_predictions(spark, sf).withColumn("w", X.class_weight("risk_class_encoded", C.DEFAULT_CLASS_WEIGHTS))
    cm = metrics.confusion(d, "risk_class_encoded", "prediction", weight="w")
    return rnd(metrics.summary(cm))


# ------------------------------------------------------ set / table checks ---
@register(
    "class_code_pairs",
    f"{base_cte()} SELECT DISTINCT risk_class, risk_class_encoded FROM lab",
)
def q_class_code_pairs(spark, sf):
    return seg_labelled(spark, sf).select("risk_class", "risk_class_encoded").distinct().orderBy("risk_class_encoded")


@register(
    "split_table_report",
    _split_sql().replace(
        f"SELECT {KEYS}, ranked.risk_class, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)",
        f", sp AS (SELECT {KEYS}, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)) "
        "SELECT split, count(*) AS n_rows, "
        + " + ".join(f"(count(*) - count({c}))" for c in NUM + CAT)
        + " AS n_missing, count(*) FILTER (WHERE risk_class = 'High') AS n_high, count(*) FILTER (WHERE risk_class = 'Medium') AS n_medium, "
        "count(*) FILTER (WHERE risk_class = 'Low') AS n_low FROM lab JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) GROUP BY split",
    ).replace("WITH lab0 AS", "WITH lab0 AS", 1),
)
def q_split_table_report(spark, sf):
    d = clean.apply_sentinel(seg_split(spark, sf, NUM + CAT))
    miss = sum((F.count_if(F.col(c).isNull()) for c in NUM + CAT), F.lit(0))
    return d.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), miss.cast("long").alias("n_missing"),
        *[F.count_if(F.col("risk_class") == k).alias(f"n_{k.lower()}") for k in ("High", "Medium", "Low")],
    )


@register(
    "events_keep_last_per_user",
    "SELECT user_id, event_id, event_type, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def q_events_keep_last_per_user(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("_o", F.struct("ts", "event_id"))
    return rnd(ranking.keep_last(ev, ["user_id"], "_o").select("user_id", "event_id", "event_type", "value"))


@register(
    "events_duplicated_users",
    "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1",
)
def q_events_duplicated_users(spark, sf):
    return ranking.duplicated_keys(read_table(spark, sf, "events"), ["user_id"])


# ------------------------------------------------- models (rows-only checks) ---
from ..operators import balance, dtree, models  # noqa: E402
from ..session import cut_lineage, drop_rows, keep_rows  # noqa: E402


def _prepared_split(spark, sf, kind: str = "tree", cfg: C.PrepConfig | None = None, keep: Sequence[str] = KEY_LIST):
    """Training part, test part and features: fitted on the training rows; all rows are transformed and written in one pass."""
    sp = seg_split(spark, sf, PREP_COLS)
    raw_tr = sp.where(F.col("split") == "train")
    if kind == "tree":
        prep = prepare.fit_tree(raw_tr, cfg)
        both = prepare.transform_tree(sp, prep, [*keep, "split"])
    else:
        prep = prepare.fit_linear(raw_tr, cfg)
        both = prepare.transform_linear(sp, prep, [*keep, "split"])
    both = keep_rows(both)
    drop_rows(sp)
    return both.where(F.col("split") == "train").drop("split"), both.where(F.col("split") == "test").drop("split"), prep.feature_cols


def _model_eval(spark, sf, key: str, kind: str = "tree", cfg=None, strategy: str = "none", weights=None, params=None):
    tr, te, feats = _prepared_split(spark, sf, kind, cfg)
    tr = experiment.class_weight_column(tr, "risk_class_encoded", strategy, weights)
    fitted = models.fit_model(key, tr, feats, "risk_class_encoded", None if strategy == "none" else "weight", params)
    pred_te = fitted.predict(te)
    pred_tr = fitted.predict(tr)
    s_te = metrics.summary(metrics.confusion(pred_te, "risk_class_encoded", "prediction"))
    s_tr = metrics.summary(metrics.confusion(pred_tr, "risk_class_encoded", "prediction")).select(
        F.col("f2_macro").alias("train_f2_macro"))
    out = s_te.withColumn("_k", F.lit(1)).join(s_tr.withColumn("_k", F.lit(1)), "_k").drop("_k")
    out = out.withColumn("gap", F.col("train_f2_macro") - F.col("f2_macro")).withColumn("overfit", X.overfit_flag("gap"))
    return rnd(out.select(F.lit(key).alias("model"), F.lit(strategy).alias("imbalance"), "*"))


@register(
    "model_dummy_test_metrics",
    _split_sql().replace(
        f"SELECT {KEYS}, ranked.risk_class, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)",
        f", sp AS (SELECT {KEYS}, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)), "
        "j AS (SELECT lab.risk_class_encoded AS y, sp.split FROM lab JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)), "
        "maj AS (SELECT y AS m FROM j WHERE split = 'train' GROUP BY y ORDER BY count(*) DESC, y LIMIT 1), "
        "cm0 AS (SELECT split, y, (SELECT m FROM maj) AS p, CAST(count(*) AS DOUBLE) AS n FROM j GROUP BY split, y), "
        "g AS (SELECT s.split, yy.y, pp.p FROM (SELECT DISTINCT split FROM j) s, (SELECT unnest([0,1,2]) AS y) yy, (SELECT unnest([0,1,2]) AS p) pp), "
        "cm AS (SELECT g.*, coalesce(cm0.n, 0.0e0) AS n FROM g LEFT JOIN cm0 USING (split, y, p)), "
        f"sm AS ({cls_metrics_sql('cm', ['split'], 'n')}) "
        "SELECT 'dummy' AS model, 'none' AS imbalance, " + ", ".join(f"round(te.{c}, 6) AS {c}" for c in SUMMARY_COLS)
        + ", round(tr.f2_macro, 6) AS train_f2_macro, round(tr.f2_macro - te.f2_macro, 6) AS gap, "
        "CAST(tr.f2_macro - te.f2_macro > 0.1e0 AS INTEGER) AS overfit FROM sm te, sm tr WHERE te.split = 'test' AND tr.split = 'train'",
    ),
)
def q_model_dummy(spark, sf):
    return _model_eval(spark, sf, "dummy")


@register("model_decision_tree_test_metrics")
def q_model_dt(spark, sf):
    return _model_eval(spark, sf, "decision_tree", params={"max_depth": 8, "min_samples_leaf": 5})


@register("model_random_forest_test_metrics")
def q_model_rf(spark, sf):
    return _model_eval(spark, sf, "random_forest", strategy="balanced", params={"n_estimators": 30, "max_depth": 8})


@register("model_gbt_ovr_test_metrics")
def q_model_gbt(spark, sf):
    return _model_eval(spark, sf, "gbt_ovr", strategy="balanced", params={"n_estimators": 20, "max_depth": 4})


@register("model_linear_svc_test_metrics")
def q_model_svc(spark, sf):
    return _model_eval(spark, sf, "linear_svc_ovr", kind="linear", cfg=C.PrepConfig(use_skew=True),
                       strategy="weighted", weights={0: 1.0, 1: 2.0, 2: 3.0})


@register("model_ridge_ordinal_test_metrics")
def q_model_ridge(spark, sf):
    return _model_eval(spark, sf, "ridge_ordinal", kind="linear", cfg=C.PrepConfig(use_skew=False), params={"alpha": 1.0})


@register("model_linear_ordinal_test_metrics")
def q_model_linear(spark, sf):
    return _model_eval(spark, sf, "linear_ordinal", kind="linear", cfg=C.PrepConfig(use_skew=False),
                       strategy="weighted", weights={0: 1.0, 1: 1.5, 2: 2.0})


@register("model_huber_ordinal_test_metrics")
def q_model_huber(spark, sf):
    return _model_eval(spark, sf, "huber_ordinal", kind="linear", cfg=C.PrepConfig(use_skew=False),
                       strategy="weighted", weights={0: 1.0, 1: 1.5, 2: 2.0}, params={"delta": 1.0})


@register("model_lasso_ordinal_test_metrics")
def q_model_lasso(spark, sf):
    return _model_eval(spark, sf, "lasso_ordinal", kind="linear", cfg=C.PrepConfig(use_skew=False, use_scale=False),
                       params={"alpha": 0.01})


@register("cv_decision_tree_fold_keyed")
def q_cv_decision_tree(spark, sf):
    """Leak-free 5-fold CV. Preparation statistics of all folds come from one
    pass over the rows (training counts = total - own fold, no row copies); one
    tree per fold, scored on its validation and training rows, one metrics aggregation."""
    raw = seg_labelled(spark, sf).select(*KEY_LIST, "risk_class", *PREP_COLS)
    dealt = folds.stratified_folds(raw, "risk_class", HASH_KEYS, KEY_LIST, k=CV_K, repeats=1, seed=SEED)
    fo = keep_rows(dealt)
    drop_rows(dealt)
    preps = prepare.fit_tree_folds(fo, "fold", CV_K)
    preds = None
    for f in range(CV_K):
        part = keep_rows(prepare.transform_tree(fo, preps[f], keep=[*KEY_LIST, "repeat", "fold"]))
        grown = dtree.fit_many(part.where(F.col("fold") != f), "risk_class_encoded", [dtree.Spec(preps[f].feature_cols, None, {"max_depth": 6})])
        p = dtree.fold_counts(part, grown, f, ["decision_tree"], "risk_class_encoded", "_cfg").drop("_cfg")
        drop_rows(part)
        preds = p if preds is None else preds.unionByName(p)
    return rnd(experiment.cv_summary(experiment.cv_fold_metrics(preds, weight="n")))


def _embeddings(spark, sf) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


@register(
    "knn_embeddings_within_label",
    "WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), "
    "p AS (SELECT a.label, a.vec_id AS id, b.vec_id AS nn_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS dist "
    "FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY label, id ORDER BY dist, nn_id) - 1 AS nn_rank FROM p) "
    "SELECT label, id, nn_id, round(dist, 6) AS dist, CAST(nn_rank AS INTEGER) AS nn_rank FROM r WHERE nn_rank < 5",
)
def q_knn_embeddings(spark, sf):
    """Exact kNN inside each label by blocked search (matrix products, k best
    per row and block); the oracle is DuckDB brute force over all pairs."""
    nn = balance.knn_within_class(_embeddings(spark, sf), "vec_id", "vec", "label", 5)
    return rnd(nn.select("label", "id", "nn_id", "dist", F.col("nn_rank").cast("int")))


@register(
    "smote_embeddings_class_counts",
    "WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label) "
    "SELECT label, CAST(max(n) OVER () AS BIGINT) AS n, CAST(max(n) OVER () - n AS BIGINT) AS n_synthetic FROM c",
)
def q_smote_embeddings(spark, sf):
    """SMOTE on the embeddings up to the majority label count."""
    out = balance.smote(_embeddings(spark, sf), "vec_id", "vec", "label", k=5, seed=SEED)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("is_synthetic").alias("n_synthetic"))


@register("kmeans_geo_clusters")
def q_kmeans_geo(spark, sf):
    """K-means (k=8) on latitude / longitude fitted on the training rows, cluster sizes of all rows."""
    from pyspark.ml.clustering import KMeans

    sp = models.assemble(seg_split(spark, sf, ["latitude", "longitude"]), ["latitude", "longitude"])
    km = KMeans(k=8, seed=SEED, featuresCol="features", predictionCol="geo_cluster").fit(sp.where(F.col("split") == "train"))
    d = sp
    return km.transform(d).groupBy("geo_cluster").agg(F.count(F.lit(1)).alias("n"))


@register("yeo_johnson_lambdas")
def q_yeo_johnson_lambdas(spark, sf):
    """Maximum-likelihood lambdas for the columns whose |skew| >= 0.5."""
    d = seg_imputed(spark, sf)
    lams = encode.fit_skew_transforms(d, C.BASE_SKEW_COLS)
    return local_df(spark, [(c, lam) for c, lam in lams.items()], "feature string, lmbda double")


@register("linear_preparation_rows")
def q_linear_preparation(spark, sf):
    """Linear preparation (skew, soil order, one-hot, robust scale) fitted on train, applied to test."""
    sp = seg_split(spark, sf, PREP_COLS)
    raw_tr, raw_te = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    prep = prepare.fit_linear(raw_tr)
    return rnd(prepare.transform_linear(raw_te, prep, KEY_LIST))


def _goss_sql() -> str:
    order = ", ".join(HASH_KEYS)
    return (
        f"{base_cte()}, pri AS (SELECT risk_class_encoded, count(*) * 1.0e0 / sum(count(*)) OVER () AS pr FROM lab GROUP BY 1), "
        f"g AS (SELECT lab.*, 1.0e0 - pr AS a, count(*) OVER () AS n_all FROM lab JOIN pri USING (risk_class_encoded)), "
        f"r AS (SELECT *, row_number() OVER (ORDER BY a DESC, {hash_sql(HASH_KEYS, SEED)}, {order}) AS pos FROM g), "
        f"d AS (SELECT *, row_number() OVER (PARTITION BY pos <= floor(0.2e0 * n_all) ORDER BY {hash_sql(HASH_KEYS, SEED + 1)}, {order}) AS draw FROM r), "
        "k AS (SELECT *, CASE WHEN pos <= floor(0.2e0 * n_all) THEN 1.0e0 ELSE (n_all - floor(0.2e0 * n_all)) / floor(0.1e0 * n_all) END AS w "
        "FROM d WHERE pos <= floor(0.2e0 * n_all) OR draw <= floor(0.1e0 * n_all)) "
        "SELECT round(w, 6) AS goss_weight, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM k GROUP BY 1"
    )


@register("goss_sample_counts", _goss_sql())
def q_goss(spark, sf):
    """GOSS sample of the first-round gradients (top 20 % by |g| averaged over the classes, 10 % of the rest): counts and key sums."""
    from ..operators import trees

    d = seg_labelled(spark, sf).select(*HASH_KEYS, "risk_class_encoded")
    pri = {r["risk_class_encoded"]: r["prior"] for r in metrics.initial_scores(d, "risk_class_encoded").collect()}
    parts = [F.abs(F.lit(float(p)) - (F.col("risk_class_encoded") == c).cast("double")) for c, p in sorted(pri.items())]
    # every row of a class has one gradient; rounding makes the classes' order independent of the order of the sum
    g = d.withColumn("abs_g", F.round(sum(parts[1:], parts[0]) / F.lit(float(len(parts))), 12))
    s = trees.goss_sample(g, "abs_g", HASH_KEYS, 0.2, 0.1, SEED, X.seeded_hash)
    return s.groupBy(F.round("goss_weight", 6).alias("goss_weight")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"))


@register("efb_bundles")
def q_efb(spark, sf):
    """Exclusive feature bundles of the one-hot indicator columns (no conflicts), and the rows in each bin of the merged columns."""
    from ..operators import trees

    d = clean.impute(seg_clean(spark, sf), [], C.CATEGORICAL_COLS)
    cats = encode.fit_onehot(d, C.OHE_COLS)
    oh = encode.apply_onehot(d, cats)
    cols = [f"{c}_{v}" for c, vs in cats.items() for v in vs]
    conf = [(r["col_a"], r["col_b"], r["conflict_rate"]) for r in trees.conflict_matrix(oh, cols).collect()]
    bundles = trees.bundle_features(conf, cols, 0.0)
    merged = oh.select(*cols)
    for i, b in enumerate(bundles):
        merged = trees.merge_bundle(merged, b, {c: 1 for c in cols}, f"bundle_{i}")
    long = merged.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("bundle"), F.lit(",".join(b)).alias("members"), F.col(f"bundle_{i}").cast("long").alias("bin")) for i, b in enumerate(bundles)
    ])).alias("x"))
    return long.groupBy("x.bundle", "x.members", "x.bin").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------- sinks and streams ---
from ..sources import io as sio  # noqa: E402


@register(
    "results_roundtrip",
    _cv_cte() + " SELECT model, repeat, fold, " + ", ".join(f"round({c}, 6) AS {c}" for c in SUMMARY_COLS + ["train_f2_macro"]) + " FROM fm",
)
def q_results_roundtrip(spark, sf):
    """Fold metrics written per model (partitioned CSV) in two
    runs, read back from the explicit list of run folders, later run wins per key."""
    from pyspark.sql import types as T

    fm = rnd(cv_fold_table(spark, sf))
    first = sio.scratch_path(spark, "results-run0")
    second = sio.scratch_path(spark, "results-run1")
    # run 0 holds stale values for every key; run 1 rewrites them all
    stale = fm.select(*[F.lit(-1.0).alias(c) if c in SUMMARY_COLS else F.col(c) for c in fm.columns])
    sio.write_table(stale, first, "csv", partition_by=["model"])
    sio.write_table(fm, second, "csv", partition_by=["model"])
    schema = T.StructType([T.StructField(c, fm.schema[c].dataType) for c in fm.columns if c != "model"]
                          + [T.StructField("model", T.StringType())])
    back = sio.read_results(spark, [first, second], ["model", "repeat", "fold"], "csv", schema)
    return back.select(*fm.columns)


@register("stream_scored_class_counts")
def q_stream_scored(spark, sf):
    """T14 on a stream: lineitem rows arrive as a file stream, are turned into
    segments (stream-static joins), prepared with statistics fitted on the batch
    table and scored by a decision tree; predictions land in a Parquet sink."""
    from ..sources.fixtures import segments_from
    from ..streaming.score import run_available, score_stream

    raw = segments(spark, sf)
    prep = prepare.fit_tree(raw)
    train = cut_lineage(prepare.transform_tree(raw, prep))
    fitted = models.fit_model("decision_tree", train, prep.feature_cols, "risk_class_encoded", params={"max_depth": 6})
    li_path = f"{sf}/lineitem.parquet"
    li_stream = (spark.readStream.schema(spark.read.parquet(li_path).schema)
                 .option("pathGlobFilter", "lineitem.parquet").option("maxFilesPerTrigger", 1).parquet(sf))
    stream_seg = segments_from(li_stream, read_table(spark, sf, "supplier"), read_table(spark, sf, "nation"))
    scored = score_stream(stream_seg, prep, fitted, keep=["l_orderkey", "l_linenumber"])
    out = run_available(spark, scored.select("risk_class_encoded", "prediction"), sio.scratch_path(spark, "stream-out"),
                        sio.scratch_path(spark, "stream-ckpt"))
    return out.groupBy("risk_class_encoded", "prediction").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------ artefacts and raw CSV input ---
@register("csv_roundtrip_class_distribution", ORACLE["class_distribution"])
def q_csv_roundtrip(spark, sf):
    """The raw segments written as CSV with header, read back with an
    explicit schema (NaN -> NULL at ingestion), then labelled (A2)."""
    from ..sources.tables import read_raw_csv

    from ..sources.tables import RAW_SCHEMA

    raw = segments(spark, sf)
    cols = [F.col(f.name).cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in RAW_SCHEMA.fields]
    path = sio.scratch_path(spark, "raw-csv")
    sio.write_table(raw.select(*cols), path, "csv")
    back = read_raw_csv(spark, path)
    return rnd(labels.class_distribution(labels.with_risk_class(back)))


@register("artefact_roundtrip_parameters", ORACLE["fitted_parameters"])
def q_artefact_roundtrip(spark, sf):
    """Fitted parameter tables saved with a metadata contract,
    reloaded after validation; a JSON report of the parameters is written when non-empty."""
    params = clean.fit_common(segments(spark, sf))
    path = sio.scratch_path(spark, "prep-artefact")
    meta = {"artifact_schema_version": 1, "target_mapping": C.CLASS_TO_CODE, "fe_groups": C.PrepConfig().fe_groups}
    sio.save_params({"params": params}, meta, path)
    tables, _ = sio.load_params(spark, path, ["params"], {"artifact_schema_version": 1})
    sio.write_if_nonempty(tables["params"], sio.scratch_path(spark, "params-csv"))
    sio.write_json_report(tables["params"].select(F.struct(*tables["params"].columns).alias("params")),
                          sio.scratch_path(spark, "params-json"))
    return rnd(tables["params"])


@register("decision_tree_importances")
def q_decision_tree_importances(spark, sf):
    """Feature importances of the tree, ranked, above-75th-percentile flag."""
    from pyspark.ml.classification import DecisionTreeClassifier

    tr, _, feats = _prepared_split(spark, sf, "tree")
    m = DecisionTreeClassifier(maxDepth=8, labelCol="risk_class_encoded", seed=SEED).fit(models.assemble(tr, feats))
    imp = [(f, float(v)) for f, v in zip(feats, m.featureImportances.toArray())]
    q75 = float(np.percentile([v for _, v in imp], 75))
    ranked = sorted(imp, key=lambda t: (-t[1], t[0]))
    rows = [(f, v, i + 1, int(v > q75)) for i, (f, v) in enumerate(ranked)]
    return local_df(spark, rows, "feature string, importance double, rank int, above_p75 int")


@register("lasso_coefficients")
def q_lasso_coefficients(spark, sf):
    """Lasso coefficients with the sparsity flag (|w| < 1e-4)."""
    tr, _, feats = _prepared_split(spark, sf, "linear", C.PrepConfig(use_skew=False, use_scale=False))
    fitted = models.fit_model("lasso_ordinal", tr, feats, "risk_class_encoded", params={"alpha": 0.01})
    rows = [(f, float(w), int(abs(w) < C.SPARSE_COEF)) for f, w in zip(feats, fitted.info["coef"])]
    return local_df(spark, rows, "feature string, coef double, is_zero int")


@register("tuning_random_search_tree")
def q_tuning_random_search(spark, sf):
    """Seeded random search of decision-tree parameters
    on 3 stratified folds (fold-keyed preparation, one fit pass for all folds),
    winner by (F2, F1w, High recall, -std), refit on all train rows, test metrics."""
    raw = seg_split(spark, sf, PREP_COLS)
    raw_tr, raw_te = raw.where(F.col("split") == "train"), raw.where(F.col("split") == "test")
    k = 3
    dealt = folds.stratified_folds(raw_tr.drop("split"), "risk_class", HASH_KEYS, KEY_LIST, k=k, repeats=1, seed=SEED)
    fo = keep_rows(dealt)
    drop_rows(dealt)
    preps = prepare.fit_tree_folds(fo, "fold", k)
    cands = experiment.candidates(models.PARAM_SPACES["decision_tree"], 12, SEED)

    def fit(f: int) -> DataFrame:
        """All candidates on a fold, grown together."""
        part, cols = keep_rows(prepare.transform_tree(fo, preps[f], keep=["repeat", "fold"])), preps[f].feature_cols
        grown = dtree.fit_many(part.where(F.col("fold") != f), "risk_class_encoded", [dtree.Spec(cols, None, c) for c in cands])
        counts = dtree.fold_counts(part, grown, f, [f"cand{ci}" for ci in range(len(cands))], "risk_class_encoded", "_cfg").drop("_cfg")
        drop_rows(part)
        return counts

    preds = None
    for p in experiment.run_concurrently(spark, [lambda f=f: fit(f) for f in range(k)]):
        preds = p if preds is None else preds.unionByName(p)
    drop_rows(fo)
    summary = experiment.cv_summary(experiment.cv_fold_metrics(preds, weight="n"))
    best = experiment.winner(summary).collect()[0]
    best_params = cands[int(best["model"][4:])]
    # Refit preparation and model on all training rows; E14 gate: the test split is scored once
    full = prepare.fit_tree(raw_tr)
    tr = keep_rows(prepare.transform_tree(raw_tr, full))
    te = prepare.transform_tree(raw_te, full)
    fitted = models.fit_model("decision_tree", tr, full.feature_cols, "risk_class_encoded", params=best_params)
    test = metrics.summary(metrics.confusion(fitted.predict(te), "risk_class_encoded", "prediction"))
    return rnd(test.select(F.lit(str(sorted(best_params.items()))).alias("best_params"),
                           F.lit(float(best["f2_macro_mean"])).alias("cv_f2_macro"), "*"))


@register("ablation_feature_groups_tree")
def q_ablation_feature_groups(spark, sf):
    """Feature-group ablation (none, each group, all) for the decision tree on the folds, with
    the difference to the baseline."""
    r = ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.feature_configs(params={"max_depth": 6}), KEY_LIST, "feature_groups")
    return rnd(ranking.delta_vs_baseline(r, ["experiment"], "config", "baseline", "f2_macro_mean"))


def _ablation_folds(spark, sf, k: int) -> DataFrame:
    dealt = folds.stratified_folds(seg_labelled(spark, sf).select(*KEY_LIST, "risk_class", *PREP_COLS), "risk_class", HASH_KEYS, KEY_LIST, k=k, repeats=1, seed=SEED)
    out = keep_rows(dealt)
    drop_rows(dealt)
    return out


@register("ablation_imbalance_tree")
def q_ablation_imbalance(spark, sf):
    """E5 / I4: six imbalance strategies for the decision tree, each fitted on the training rows of every fold."""
    return rnd(ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.imbalance_configs(params={"max_depth": 8}), KEY_LIST, "imbalance"))


@register("ablation_domain_groups_tree")
def q_ablation_domain(spark, sf):
    """Domain feature groups (none, each, all) for the decision tree, with G4 ranks and SMOTE fitted on the training rows of each fold."""
    return rnd(ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.domain_configs(params={"max_depth": 8}), KEY_LIST, "domain_groups"))


@register("ablation_clip_quantile_tree")
def q_ablation_clip(spark, sf):
    """The clipping quantile of the preparation for the decision tree."""
    return rnd(ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.clip_configs(params={"max_depth": 8}), KEY_LIST, "clip_quantile"))


@register("ablation_booster_penalties")
def q_ablation_penalties(spark, sf):
    """L1, L2 and least gain of the booster."""
    params = {"n_estimators": 4, "learning_rate": 0.3, "num_leaves": 8, "max_bin": 32}
    return rnd(ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.booster_penalty_configs(params=params), KEY_LIST, "penalties"))


@register("ablation_losses")
def q_ablation_losses(spark, sf):
    """Squared, Huber, ridge and lasso losses over their parameters."""
    return rnd(ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.loss_configs(), KEY_LIST, "losses"))


@register("ablation_preparation_ridge")
def q_ablation_preparation(spark, sf):
    """The eight preparations for the ridge regression; a failing one keeps a row with its error."""
    return rnd(ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.preparation_configs("ridge_ordinal"), KEY_LIST, "preparation"))


@register("ablation_final_configs")
def q_ablation_final(spark, sf):
    """Each model with its own preparation and strategy; records are read back from the batch table that grows with each model."""
    path = sio.scratch_path(spark, "batches")
    ablation.run_grid(_ablation_folds(spark, sf, 3), 3, ablation.final_configs(), KEY_LIST, "final_configuration", batch_path=path)
    return rnd(spark.read.parquet(path).drop("batch_group"))


@register(
    "row_alignment_raw_prepared",
    f"{base_cte()} SELECT 'matched' AS side, count(*) AS n, CAST(0 AS BIGINT) AS n_class_differs FROM lab",
)
def q_row_alignment(spark, sf):
    """Rows of the raw table against those of the prepared one by key and class."""
    raw = seg_labelled(spark, sf).select(*KEY_LIST, "risk_class")
    prep = prepare.transform_tree(segments(spark, sf), prepare.fit_tree(segments(spark, sf)), KEY_LIST).select(*KEY_LIST, "risk_class")
    return ranking.row_alignment(raw, prep, KEY_LIST, "risk_class")


@register("final_evaluation_gated")
def q_final_evaluation(spark, sf):
    """Fit on the training rows, save the pipeline, note it in the manifest, and let the
    reloaded artefact score the test rows."""
    sp = seg_split(spark, sf, PREP_COLS)
    raw_tr, raw_te = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    prep = prepare.fit_tree(raw_tr)
    fitted = models.fit_model("decision_tree", keep_rows(prepare.transform_tree(raw_tr, prep)), prep.feature_cols, "risk_class_encoded", params={"max_depth": 8})
    path, manifest = sio.scratch_path(spark, "pipeline"), sio.scratch_path(spark, "manifest")
    final.save_pipeline(prep, fitted, path, seed=SEED)
    sio.append_manifest(spark, manifest, "decision_tree", {"stage": "fitted", "artefact": path})
    entry = sio.read_manifest(spark, manifest)["decision_tree"]
    test = final.evaluate_on_test(spark, entry["artefact"], raw_te, {"seed": SEED})
    return rnd(test.select(F.lit("decision_tree").alias("model"), F.lit(entry["stage"]).alias("stage"), "*"))


@register("histogram_boosting_rounds")
def q_histogram_boosting(spark, sf):
    """Softmax gradient boosting (one depth-2 tree per
    class per round, one histogram aggregation per level), training log loss per
    round and test metrics of the final model."""
    from ..operators import trees

    tr, te, feats = _prepared_split(spark, sf, "tree")
    num = [f for f in feats if f not in C.CATEGORICAL_COLS]
    edges = trees.quantile_bin_edges(tr, num, HIST_BINS)
    btr, bte = trees.bin_features(tr, edges), trees.bin_features(te, edges)
    bins = [c + "_bin" for c in num]
    lr = 0.3
    fitted, losses, _, init = trees.boost_trees(keep_rows(btr.select(*bins, "risk_class_encoded")), bins,
                                                "risk_class_encoded", 3, rounds=5, learning_rate=lr, max_depth=2)
    pred = trees.predict_trees(bte, fitted, 3, init, lr)
    s = metrics.summary(metrics.confusion(pred, "risk_class_encoded", "prediction")).collect()[0]
    rows = [(i, float(l), float(s["f2_macro"]), float(s["f1_weighted"])) for i, l in enumerate(losses)]
    return local_df(spark, rows, "round int, train_log_loss double, test_f2_macro double, test_f1_weighted double")


# ------------------------------------------------- nested report, given models ---
from ..sources import report  # noqa: E402

_REPORT_SQL = (
    _per_class_sql("land_use")
    + ", s AS (SELECT land_use, avg(f2) AS f2_macro, sum(recall * support) / sum(support) AS accuracy FROM pcf GROUP BY land_use), "
    "line AS (SELECT land_use, label, list(n ORDER BY prediction) AS l FROM cm GROUP BY ALL) "
    "SELECT 'rules' AS run, land_use AS model, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(f2, 6) AS f2, round(support, 6) AS support, "
    "round(f2_macro, 6) AS f2_macro, round(accuracy, 6) AS accuracy, l[1] AS as_low, l[2] AS as_medium, l[3] AS as_high "
    "FROM pcf JOIN s USING (land_use) JOIN line USING (land_use, label)"
)


@register("nested_report_roundtrip", _REPORT_SQL)
def q_nested_report(spark, sf):
    """The run's JSON document (a map from model to metrics, classes and matrix) written, read back and laid out; each land use stands for a model."""
    path = report.write_report(report.nested_report(rule_predictions(spark, sf), "land_use", "risk_class_encoded", "prediction", "rules"), sio.scratch_path(spark, "report"))
    rows = report.report_rows(report.read_report(spark, path))
    m = [F.element_at("metrics", c).alias(c) for c in ("f2_macro", "accuracy")]
    return rnd(rows.select("run", "model", "label", "precision", "recall", "f1", "f2", "support", *m, *[F.get("line", F.lit(i)).alias(f"as_{n}") for i, n in enumerate(("low", "medium", "high"))]))


#: Coefficients of the imputed numeric features, intercept and thresholds of four ordinal models (M6-M9), as given.
GIVEN_MODELS = {
    "linear": ([-0.004, 0.01, -0.0005, 0.02, 0.001], 0.1, 0.7, 1.4),
    "ridge": ([-0.003, 0.02, -0.0004, 0.018, 0.002], 0.2, 0.8, 1.5),
    "lasso": ([0.0, 0.0, -0.0003, 0.021, 0.0], 0.05, 0.6, 1.3),
    "huber": ([-0.002, 0.015, -0.0006, 0.019, 0.0015], 0.15, 0.75, 1.45),
}


def _given_sql() -> str:
    score = lambda w, b: f"({b}e0 + " + " + ".join(f"{x}e0 * {c}" for x, c in zip(w, NUM)) + ")"
    parts = _union_sql([
        f"SELECT '{k}' AS model, risk_class_encoded AS label, {score(w, b)} AS s, CASE WHEN {score(w, b)} >= {t2}e0 THEN 2 WHEN {score(w, b)} >= {t1}e0 THEN 1 ELSE 0 END AS prediction FROM imp"
        for k, (w, b, t1, t2) in GIVEN_MODELS.items()
    ])
    return f"{_imputed_sql_cte()}, m AS ({parts}) SELECT model, CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n, round(avg(s), 6) AS mean_score FROM m GROUP BY ALL"


@register("ordinal_scores_given_coefficients", _given_sql())
def q_ordinal_given(spark, sf):
    """M6-M9 / P25: scores and classes of ordinal models with given coefficients, through the models' own prediction."""
    d, out = seg_imputed(spark, sf), None
    for k, (w, b, t1, t2) in GIVEN_MODELS.items():
        info = {"intercept": b, "coef": w, "features": NUM, "t1": t1, "t2": t2}
        s = F.lit(b) + sum((F.lit(x) * F.col(c) for x, c in zip(w, NUM)), F.lit(0.0))
        p = models._ordinal_predict(info)(d.withColumn("s", s)).select(F.lit(k).alias("model"), F.col("risk_class_encoded").alias("label"), "prediction", "s")
        out = p if out is None else out.unionByName(p)
    return rnd(out.groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("mean_score")))


def _linear_fixed_sql() -> str:
    """The linear preparation without skew transforms: fitted on the training rows, applied to the test rows."""
    split = _split_sql()
    split = split[: split.rindex("SELECT " + KEYS)]
    keys = ", ".join("lab." + k.strip() for k in KEYS.split(","))
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS med_{i}" for i, c in enumerate(NUM))
    clip = "CASE WHEN storm_drain_proximity_m > clip_upper THEN clip_upper ELSE storm_drain_proximity_m END"
    num = ", ".join(f"coalesce({c}, med_{i}) AS {c}" for i, c in enumerate(NUM))
    hot = ", ".join(f"CASE WHEN coalesce({c}, 'Unknown') = '{v}' THEN 1.0e0 ELSE 0.0e0 END AS {c}_{v}" for c, vs in OHE_DOMAINS.items() for v in vs)
    soil = "CAST((CASE coalesce(soil_group, 'Unknown') " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(C.SOIL_ORDER)) + " ELSE -1 END) AS DOUBLE) AS soil_group"
    cols = [*NUM, "soil_group", *[f"{c}_{v}" for c, vs in OHE_DOMAINS.items() for v in vs]]
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS m{i}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS r{i}" for i, c in enumerate(cols))
    scaled = ", ".join(f"round(({c} - m{i}) / CASE WHEN r{i} = 0 THEN 1.0e0 ELSE r{i} END, 6) AS {c}" for i, c in enumerate(cols))
    return (
        split + ", sp AS (SELECT " + KEYS + ", CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)), "
        f"j AS (SELECT lab.*, sp.split FROM lab JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)), "
        f"q0 AS (SELECT {meds} FROM j WHERE split = 'train'), q1 AS (SELECT quantile_cont(coalesce(storm_drain_proximity_m, med_2), 0.95) AS clip_upper FROM j, q0 WHERE split = 'train'), "
        f"im AS (SELECT {KEYS}, split, risk_class, risk_class_encoded, latitude, longitude, {num}, {hot}, {soil}, clip_upper FROM j, q0, q1), "
        f"cl AS (SELECT * REPLACE ({clip} AS storm_drain_proximity_m) FROM im), st AS (SELECT {stats} FROM cl WHERE split = 'train') "
        f"SELECT {KEYS}, {scaled}, risk_class, risk_class_encoded, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM cl, st WHERE split = 'test'"
    )


@register("linear_preparation_no_skew", _linear_fixed_sql())
def q_linear_preparation_no_skew(spark, sf):
    """T9 without skew transforms: medians, clip, soil order, one-hot and robust scale fitted on the training rows, applied to the test rows."""
    sp = seg_split(spark, sf, PREP_COLS)
    prep = prepare.fit_linear(sp.where(F.col("split") == "train"), C.PrepConfig(fe_groups=[], use_skew=False))
    return rnd(prepare.transform_linear(sp.where(F.col("split") == "test"), prep, KEY_LIST))


@register("model_dummy_stratified_counts", _split_sql().replace(
    f"SELECT {KEYS}, ranked.risk_class, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)",
    f", sp AS (SELECT {KEYS}, CASE WHEN rk < q THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quota USING (risk_class)), "
    "j AS (SELECT lab.*, sp.split FROM lab JOIN sp USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)), "
    "c AS (SELECT avg(CASE WHEN risk_class_encoded = 0 THEN 1.0e0 ELSE 0.0e0 END) AS p0, avg(CASE WHEN risk_class_encoded <= 1 THEN 1.0e0 ELSE 0.0e0 END) AS p1 FROM j WHERE split = 'train'), "
    f"u AS (SELECT j.*, {hash_sql(HASH_KEYS, SEED)} / 4294967296.0e0 AS u FROM j WHERE split = 'test') "
    "SELECT CAST(CASE WHEN u < p0 THEN 0 WHEN u < p1 THEN 1 ELSE 2 END AS INTEGER) AS prediction, CAST(risk_class_encoded AS INTEGER) AS label, count(*) AS n FROM u, c GROUP BY ALL",
))
def q_dummy_stratified(spark, sf):
    """M1: the stratified dummy, saved and loaded: classes drawn by the shares of the training rows."""
    sp = seg_split(spark, sf, ["risk_class_encoded"])
    f = models.fit_model("dummy", sp.where(F.col("split") == "train"), [], "risk_class_encoded", params={"strategy": "stratified", "key_cols": HASH_KEYS, "seed": SEED})
    path = sio.scratch_path(spark, "dummy")
    f.save(path)
    p = models.load_fitted(spark, path).predict(sp.where(F.col("split") == "test"))
    return p.groupBy("prediction", F.col("risk_class_encoded").alias("label")).agg(F.count(F.lit(1)).alias("n"))


from . import catalog_trees  # noqa: E402, F401  (registers the queries of the tree models)
