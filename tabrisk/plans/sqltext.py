"""SQL text shared by the DuckDB oracle queries (the same semantics as the
Spark operators, written independently as plain SQL)."""

from __future__ import annotations

from .. import config as C
from ..sources.fixtures import segments_sql

NUM = C.NUMERIC_COLS
CAT = C.CATEGORICAL_COLS
KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def tokens_sql(col: str) -> str:
    return f"list_transform(string_split({col}, '|'), lambda x: trim(x))"


def assign_class_sql(col: str = "risk_labels") -> str:
    parts = [f"CASE WHEN {col} IS NULL OR trim({col}) = '' THEN '{C.DEFAULT_CLASS}'"]
    for cls, toks in C.LABEL_RULES:
        arr = "[" + ", ".join(f"'{t}'" for t in toks) + "]"
        parts.append(f"WHEN list_has_any({tokens_sql(col)}, {arr}) THEN '{cls}'")
    parts.append(f"ELSE '{C.DEFAULT_CLASS}' END")
    return " ".join(parts)


def class_code_sql(col: str = "risk_class") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.CLASS_TO_CODE.items())
    return f"CAST(CASE {col} {whens} END AS INTEGER)"


def labelled_sql() -> str:
    """Segments with risk_class, risk_class_encoded and the elevation sentinel applied."""
    return (
        f"SELECT s.* REPLACE (nullif(elevation_m, -3.0e0) AS elevation_m), {assign_class_sql()} AS risk_class "
        f"FROM ({segments_sql()}) s"
    )


def base_cte() -> str:
    return (
        f"WITH lab0 AS ({labelled_sql()}), "
        f"lab AS (SELECT *, {class_code_sql()} AS risk_class_encoded FROM lab0)"
    )


def params_cte() -> str:
    """Fitted medians, p10 of elevation and p95 of the imputed proximity (whole table)."""
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS med_{i}" for i, c in enumerate(NUM))
    return (
        f"p0 AS (SELECT {meds}, quantile_cont(elevation_m, 0.1) AS elev_low FROM lab), "
        "p AS (SELECT p0.*, (SELECT quantile_cont(coalesce(storm_drain_proximity_m, p0.med_2), 0.95) FROM lab) "
        "AS clip_upper FROM p0)"
    )


def soil_core_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.SOIL_CODE_CORE.items())
    return f"(CASE {col} {whens} END)"


def soil_domain_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.SOIL_CODE_DOMAIN.items())
    return f"CAST(CASE {col} {whens} END AS DOUBLE)"


def hash_sql(keys: list[str], seed: int) -> str:
    from ..functions.exprs import seeded_hash_sql

    return seeded_hash_sql(keys, seed)


def cls_metrics_sql(src: str, keys: list[str], ncol: str) -> str:
    """Per-group classification summary (A20-A21) from a (keys, y, p, n) confusion table."""
    k = ", ".join(keys)
    f1 = "CASE WHEN precision + recall > 0 THEN 2.0e0 * precision * recall / (1.0e0 * precision + recall) ELSE 0.0e0 END"
    f2 = "CASE WHEN precision + recall > 0 THEN 5.0e0 * precision * recall / (4.0e0 * precision + recall) ELSE 0.0e0 END"
    return (
        f"SELECT {k}, avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro, avg(f2) AS f2_macro, "
        "CASE WHEN sum(support) > 0 THEN sum(f1 * support) / sum(support) ELSE 0.0e0 END AS f1_weighted, "
        "CASE WHEN sum(support) > 0 THEN sum(f2 * support) / sum(support) ELSE 0.0e0 END AS f2_weighted, "
        "max(recall) FILTER (WHERE cls = 0) AS recall_low, max(recall) FILTER (WHERE cls = 1) AS recall_medium, "
        "max(recall) FILTER (WHERE cls = 2) AS recall_high, "
        "CASE WHEN sum(support) > 0 THEN sum(recall * support) / sum(support) ELSE 0.0e0 END AS accuracy FROM ("
        f"SELECT {k}, cls, precision, recall, support, {f1} AS f1, {f2} AS f2 FROM ("
        f"SELECT {k}, cls, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0e0 END AS precision, "
        "CASE WHEN sup > 0 THEN tp / sup ELSE 0.0e0 END AS recall, sup AS support FROM ("
        + " UNION ALL ".join(
            f"SELECT {k}, {c} AS cls, sum(CASE WHEN y = {c} AND p = {c} THEN {ncol} ELSE 0.0e0 END) AS tp, "
            f"sum(CASE WHEN y = {c} THEN {ncol} ELSE 0.0e0 END) AS sup, sum(CASE WHEN p = {c} THEN {ncol} ELSE 0.0e0 END) AS pred "
            f"FROM {src} GROUP BY {k}"
            for c in range(3)
        )
        + f"))) GROUP BY {k}"
    )
