"""Order statistics that stay distributed: exact positions, prefix sums, quantiles.

A global ``Window.orderBy`` without ``partitionBy`` moves every row into one
task, and ``percentile`` merges a value->count map per group in one task. The
helpers below avoid both:

* rows are range-partitioned on ``(group, order..., tie keys)`` so that even a
  value that holds a third of the table is split over many tasks;
* the partitioned, sorted table is checkpointed (reliable storage) so that the
  per-partition totals and the rows see the same partitioning;
* the per-partition totals (a table of at most ``partitions + groups`` rows)
  give each partition its offset; the offset table is joined back, broadcast
  only after its size has been checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_rows, keep_rows

# Estimated bytes under which a derived side table is broadcast.
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024


def _estimated_bytes(df: DataFrame) -> int:
    """Row count times the fixed width plus the measured length of strings, binaries and arrays, in one aggregation."""
    from pyspark.sql import types as T

    var = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var = var + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            var = var + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(var).alias("v")).first()
    return int(r["n"]) * (16 + 8 * len(df.columns)) + int(r["v"] or 0)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """NULL-safe equi-join (a NULL key is a key like any other) with a small derived table.

    The result does not depend on the size of ``small``; only the hint does:
    it is broadcast when its measured bytes stay under ``BROADCAST_BYTE_LIMIT``,
    else Catalyst / AQE pick a sort-merge join with skew splitting. ``small``
    should be cheap to measure (aggregated or checkpointed).
    """
    on = [on] if isinstance(on, str) else list(on)
    right = small.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in small.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    right = F.broadcast(right) if not on or _estimated_bytes(small) <= BROADCAST_BYTE_LIMIT else right
    return big.join(right, cond, how).drop(*[f"_r_{c}" for c in on])


# Rows up to which a fitted table (parameters, codes, quantiles, metrics) is
# re-created as a local relation; the rows are the same either way.
SMALL_TABLE_LIMIT = 10_000


def local_df(spark, data, schema) -> DataFrame:
    """A small table as a JVM-side local relation (Arrow transfer, no Python
    workers in later jobs; its size is known to the planner)."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow_schema = to_arrow_schema(schema)
    if hasattr(data, "to_dict"):  # pandas: columnar conversion
        tbl = pa.Table.from_pandas(data[[f.name for f in schema.fields]], schema=arrow_schema, preserve_index=False)
        return spark.createDataFrame(tbl)
    names = [f.name for f in schema.fields]
    rows = [dict(zip(names, tuple(r))) for r in data]
    for r in rows:
        for f in schema.fields:
            v = r[f.name]
            if hasattr(v, "item"):
                r[f.name] = v.item()
    tbl = pa.Table.from_pylist(rows, schema=arrow_schema)
    return spark.createDataFrame(tbl)


def materialize_small(df: DataFrame, limit: int = SMALL_TABLE_LIMIT) -> DataFrame:
    """Cut the lineage of a small derived table.

    Up to ``limit`` rows it becomes a local relation: its size is then known to
    the planner (a proven broadcast bound) and later plans stay short. Larger
    tables are checkpointed to the reliable checkpoint folder instead.
    """
    ck = cut_lineage(df)  # computed once, whatever its size
    if ck.count() <= limit:
        return local_df(df.sparkSession, ck.toArrow().to_pandas(), df.schema)
    return ck


def _n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    group_cols: Sequence[str] = (),
    weight: str | Column | None = None,
    out_col: str = "pos",
    partitions: int | None = None,
    total_col: str | None = None,
) -> DataFrame:
    """Add ``out_col`` = sum of ``weight`` over the rows strictly before each row.

    Order is ``order_cols`` inside each ``group_cols`` group (a NULL group is a
    group); with ``weight=None`` every row weighs 1, so ``out_col`` is the exact
    0-based position. The order must be total (add key columns as the last order
    columns) for positions to be deterministic. ``total_col`` adds the group's
    total weight. See :func:`prefix_sums_multi` for the execution strategy.
    """
    w = F.lit(1).cast("long") if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    return prefix_sums_multi(df, order_cols, group_cols, {out_col: w}, partitions, {total_col: out_col} if total_col else {})


def prefix_sums_multi(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    group_cols: Sequence[str],
    weights: dict,
    partitions: int | None = None,
    totals: dict | None = None,
) -> DataFrame:
    """Several exclusive running sums at once (``weights``: out column -> weight column).

    One path for every size: the table is range-partitioned on (group, order),
    so a hot group or value is split across tasks; each partition is summed on
    its own and the offsets of the partitions (a table of at most
    partitions + groups rows) are added back by a NULL-safe join. ``totals``
    (out column -> weight's out column) adds group totals from the same table.
    """
    group_cols = list(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    wcols = {o: f"_w_{i}" for i, o in enumerate(weights)}
    keyed = df.select("*", *[(F.col(w) if isinstance(w, str) else w).alias(wcols[o]) for o, w in weights.items()])
    n = partitions or _n_partitions(df)
    ranged = keyed.repartitionByRange(n, *[F.col(g) for g in group_cols], *order).withColumn(
        "_pid", F.spark_partition_id()
    )
    # The range bounds come from sampling; materialise once so that totals and
    # rows see the same partitioning (and survive executor loss).
    ranged = keep_rows(ranged)
    sums = ranged.groupBy("_pid", *group_cols).agg(*[F.sum(wc).alias(f"_tot{wc}") for wc in wcols.values()])
    whole = Window.partitionBy(*group_cols)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    named = {o: wcols[w] for o, w in (totals or {}).items()}
    offsets = sums.select(
        "_pid", *group_cols, *[F.coalesce(F.sum(f"_tot{wc}").over(before), F.lit(0)).alias(f"_off{wc}") for wc in wcols.values()],
        *[F.sum(f"_tot{wc}").over(whole).alias(o) for o, wc in named.items()],
    )
    within = Window.partitionBy("_pid", *group_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged
    for wc in wcols.values():
        local = local.withColumn(f"_loc{wc}", F.coalesce(F.sum(wc).over(within), F.lit(0)))
    out = join_small(local, offsets, ["_pid", *group_cols])
    for o, wc in wcols.items():
        out = out.withColumn(o, F.col(f"_off{wc}") + F.col(f"_loc{wc}"))
    drop = ["_pid", *wcols.values(), *[f"_off{wc}" for wc in wcols.values()], *[f"_loc{wc}" for wc in wcols.values()]]
    return out.drop(*drop)


#: Bits of ``monotonically_increasing_id`` that number a partition's rows.
ROW_BITS = 33


def positions(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    group_cols: Sequence[str] = (),
    out_col: str = "pos",
    total_col: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Exact 0-based row position within each group (``row_number() - 1``), moving and sorting the rows once.

    The rows are range-partitioned on (group, order), sorted in their partitions and written with their partition and
    place in it. A (partition, group) holds consecutive rows, so where it begins and how many of its
    group come before (a table of at most partitions + groups rows) give the positions.
    """
    group_cols = list(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    by = [*[F.col(g) for g in group_cols], *order]
    ranged = df.repartitionByRange(partitions or _n_partitions(df), *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ranged = keep_rows(ranged).withColumn("_pid", F.shiftright("_at", ROW_BITS))
    sizes = ranged.groupBy("_pid", *group_cols).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group_cols)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", *group_cols, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"),
                           *([F.sum("_n").over(whole).alias(total_col)] if total_col else []))
    out = join_small(ranged, offsets, ["_pid", *group_cols]).withColumn(out_col, F.col("_at") + F.col("_off"))
    return out.select(*df.columns, out_col, *([total_col] if total_col else []))


#: Leading bits of a hash by which :func:`hashed_positions` deals rows out.
PLACE_BITS = 15


def hashed_positions(
    df: DataFrame,
    hash_col: str,
    bits: int,
    order_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    out_col: str = "pos",
) -> DataFrame:
    """:func:`positions` in order of a hash of ``bits`` bits, then ``order_cols``, moving the rows once.

    A hash spreads rows evenly, so its leading bits deal them out in order
    without a sample: the rows of a (group, place) are numbered in their task, and the
    places' sizes (at most ``2**PLACE_BITS`` a group) give what comes before.
    """
    group_cols = list(group_cols)
    placed = df.withColumn("_place", F.shiftright(F.col(hash_col), max(0, bits - PLACE_BITS)).cast("int"))
    sizes = placed.groupBy("_place", *group_cols).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(sizes.select("_place", *group_cols, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    within = Window.partitionBy("_place", *group_cols).orderBy(hash_col, *order_cols)
    out = join_small(placed.withColumn("_at", F.row_number().over(within) - 1), offsets, ["_place", *group_cols])
    return out.withColumn(out_col, F.col("_before") + F.col("_at")).drop("_place", "_before", "_at")


def ranked_counts(counts: DataFrame, value_col: str, group_cols: Sequence[str]) -> DataFrame:
    """A (group..., value, cnt) table with ``before`` (rows of the group before the value; a NULL value comes last) and ``n`` (rows of the group)."""
    return prefix_sums(counts, [F.col(value_col).asc_nulls_last()], group_cols, "cnt", "before", total_col="n")


def value_counts_ranked(df: DataFrame, value_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct values per group with ``cnt``, ``before`` and ``n``, see :func:`ranked_counts`.

    The (group, value) aggregation is map-side combined, so a hot value costs
    one row per partition, never a hot task; NULL groups and values are kept."""
    group_cols = list(group_cols)
    return ranked_counts(df.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("cnt")), value_col, group_cols)


def group_sizes(df: DataFrame, group_cols: Sequence[str], out_col: str = "n") -> DataFrame:
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(out_col))


def to_long(df: DataFrame, value_cols: Sequence[str], keep: Sequence[str] = (), name_col: str = "feature",
            value_col: str = "value", drop_nulls: bool = True) -> DataFrame:
    """Unpivot numeric columns to (keep..., column, value) rows."""
    keep = list(keep)
    cast = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in value_cols])
    long = cast.unpivot(keep, list(value_cols), name_col, value_col)
    return long.where(F.col(value_col).isNotNull()) if drop_nulls else long


def exact_quantiles(
    df: DataFrame,
    value_cols: Sequence[str],
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    long_form: bool = False,
) -> DataFrame:
    """A1: exact, linearly interpolated quantiles ignoring NULL.

    Same definition as ``percentile`` / ``quantile_cont`` / pandas: with ``n``
    non-null values sorted, ``h = (n-1) p`` and ``q = v[floor h] + (h - floor h)
    (v[ceil h] - v[floor h])``. Output: one row per (group..., column) with a
    column ``q_<p>`` per probability (``p`` written with ``_`` for ``.``), plus
    ``n``. Work: one range-partitioned sort of the long table, no per-group
    map and no single-task merge. Without groups only the values of the ranges
    that hold a quantile are sorted (:func:`reduced_counts`).
    """
    group_cols = list(group_cols)
    keys = group_cols + ["feature"]
    if not group_cols:
        return quantiles_from_counts(reduced_counts(df, value_cols, probs)[0], keys, probs, long_form)
    long = to_long(df, value_cols, group_cols)
    agg = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("cnt"))
    return quantiles_from_counts(agg, keys, probs, long_form)


#: Ranges into which :func:`reduced_counts` cuts a column, and rows drawn to set their bounds (no result depends on them).
CELLS, DRAWN = 1024, 40_000


def reduced_counts(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    fold_col: str | None = None,
    k: int = 0,
    imputed: tuple[str, float] | None = None,
) -> tuple[DataFrame, dict]:
    """A ((fold,) feature, value, cnt) table with the same quantiles at ``probs`` as all non-null values, and the NULLs of each column.

    Rows are counted by range first; only the values of ranges that hold a wanted
    rank are then counted one by one. Any other range becomes one row, its
    lower bound with its count, which keeps all ranks. So what is shuffled and
    sorted is a small share of the values, also where hardly any occurs twice.
    With ``fold_col`` there is a table for each of ``k`` folds, of the rows outside it. ``imputed``
    (column, prob) also keeps the ranges of a quantile of the column with its NULLs at the median.
    The NULLs are ``{(fold or None, column): count}``.
    """
    import numpy as np
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql import types as T

    cols = list(cols)
    # + 0.0: no negative zeros, which a binary search tells from zero
    fold = [] if fold_col is None else [F.col(fold_col).cast("int").alias("_fold")]
    rows = df.select(*fold, *[(F.col(c).cast("double") + F.lit(0.0)).alias(f"_v{i}") for i, c in enumerate(cols)])
    names = [f"_v{i}" for i in range(len(cols))]
    n = max(1, df.count())
    drawn = (rows.select(*names).sample(min(1.0, DRAWN / n), 42) if n > DRAWN else rows.select(*names)).toArrow()
    bounds = []
    for v in names:
        x = np.sort(drawn[v].drop_null().to_numpy())
        x = x[np.isfinite(x)]
        bounds.append([float(b) for b in np.unique(x[(np.arange(1, CELLS) * len(x)) // CELLS])] if len(x) else [0.0])
    # bounds below -> number of the range; NaN has a range of its own after all others, NULL the number -1
    cut = Bucketizer(splitsArray=[[-np.inf, *b, np.inf] for b in bounds], inputCols=names, outputCols=[f"_b{i}" for i in range(len(cols))], handleInvalid="keep")
    cell = lambda i: F.when(F.col(f"_v{i}").isNull(), -1).otherwise(F.col(f"_b{i}").cast("int"))
    keep = ["_fold"] if fold else []
    in_cells = cut.transform(rows).select(*keep, *names, *[cell(i).alias(f"_b{i}") for i in range(len(cols))])
    long = in_cells.select(*keep, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_b{i}").alias("b")) for i in range(len(cols))])).alias("x"))
    counted = long.groupBy(*keep, "x.i", "x.b").agg(F.count(F.lit(1)).alias("cnt")).toArrow().to_pylist()
    members = [None] if fold_col is None else list(range(k))
    sizes = {(f, i): np.zeros(len(bounds[i]) + 2, np.int64) for f in members for i in range(len(cols))}
    nulls = {(f, c): 0 for f in members for c in cols}
    for r in counted:
        for f in members:
            if f is not None and r["_fold"] == f:
                continue
            if r["b"] < 0:
                nulls[f, cols[r["i"]]] += r["cnt"]
            else:
                sizes[f, r["i"]][r["b"]] += r["cnt"]
    wanted: list[set[int]] = [set() for _ in cols]
    for (f, i), size in sizes.items():
        wanted[i] |= _cells_of(size, probs)
        if imputed and cols[i] == imputed[0]:
            half = _cells_of(size, [0.5])
            wanted[i] |= half
            for b in half:  # the median lies in one of these ranges or between them
                wanted[i] |= _cells_of(size + nulls[f, cols[i]] * (np.arange(len(size)) == b), [imputed[1]])
    # the values of wanted ranges, NULL elsewhere
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.when(F.col(f"_b{i}").isin(sorted(w)), F.col(f"_v{i}")).alias("value")) for i, w in enumerate(wanted) if w])).alias("x")
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("x.i") + 1).alias("feature")
    rest_schema = T.StructType([*([T.StructField(fold_col, T.IntegerType())] if fold else []), T.StructField("feature", T.StringType()),
                                T.StructField("value", T.DoubleType()), T.StructField("cnt", T.LongType())])
    lower = [[-np.inf, *b, np.nan] for b in bounds]
    rest = [(*([f] if fold else []), cols[i], float(lower[i][b]), int(m)) for (f, i), size in sizes.items() for b, m in enumerate(size) if m and b not in wanted[i]]
    rest = local_df(df.sparkSession, rest, rest_schema)
    if not any(wanted):
        return rest, nulls
    found = in_cells.select(*[F.col("_fold").alias(fold_col)] if fold else [], values).where(F.col("x.value").isNotNull())
    found = found.groupBy(*([fold_col] if fold else []), name, F.col("x.value").alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
    if fold:
        found = fold_train_counts(found, fold_col, k, ["feature"])
    return found.select(*rest.columns).unionByName(rest), nulls


def _cells_of(sizes, probs: Sequence[float]) -> set[int]:
    """Ranges of a column, given how many values each has, that hold the ranks from which the quantiles at ``probs`` are taken."""
    import math

    import numpy as np

    upto = np.cumsum(sizes)
    n = int(upto[-1])
    ranks = {r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))} if n else set()
    return {int(np.searchsorted(upto, r, side="right")) for r in ranks}


def quantiles_from_counts(agg: DataFrame, keys: Sequence[str], probs: Sequence[float], long_form: bool = False) -> DataFrame:
    """Interpolated quantiles from a (keys..., value, cnt) table of non-null values."""
    keys = list(keys)
    ranked = keep_rows(ranked_counts(agg, "value", keys))
    sizes = ranked.select(*keys, "n").distinct()
    probs_arr = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.lit(i).alias("pidx")) for i, p in enumerate(probs)])
    targets = sizes.select(*keys, "n", F.explode(probs_arr).alias("_p")).select(*keys, "n", "_p.p", "_p.pidx")
    targets = targets.withColumn("h", (F.col("n") - 1) * F.col("p")).withColumn(
        "lo", F.floor("h").cast("long")
    ).withColumn("hi", F.ceil("h").cast("long"))
    targets = targets.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "n", "p", "pidx", "h", "lo", "hi")
    cond = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys] + [
        F.col("before") <= F.col("hi"), F.col("lo") < F.col("before") + F.col("cnt")
    ]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    # targets: groups x columns x probs rows, broadcast when measured small
    targets = materialize_small(targets)
    hit = ranked.drop("n").join(F.broadcast(targets) if _estimated_bytes(targets) <= BROADCAST_BYTE_LIMIT else targets, cond_all)
    in_lo = (F.col("before") <= F.col("lo")) & (F.col("lo") < F.col("before") + F.col("cnt"))
    in_hi = (F.col("before") <= F.col("hi")) & (F.col("hi") < F.col("before") + F.col("cnt"))
    vals = hit.groupBy(*keys, "n", "pidx", "h", "lo").agg(
        F.max(F.when(in_lo, F.col("value"))).alias("v_lo"), F.max(F.when(in_hi, F.col("value"))).alias("v_hi")
    )
    vals = vals.withColumn("q", F.col("v_lo") + (F.col("h") - F.col("lo")) * (F.col("v_hi") - F.col("v_lo")))
    if long_form:
        probs_map = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("pidx") + 1)
        out = materialize_small(vals.select(*keys, "n", probs_map.alias("p"), "q"))
        drop_rows(ranked)
        return out
    out = vals.groupBy(*keys, "n").pivot("pidx", list(range(len(probs)))).agg(F.first("q"))
    for i, p in enumerate(probs):
        out = out.withColumnRenamed(str(i), quantile_name(p))
    # groups x columns rows: materialise the small result so reuse does not re-sort.
    out = materialize_small(out)
    drop_rows(ranked)
    return out


def fold_train_counts(counts: DataFrame, fold_col: str, k: int, keys: Sequence[str], value_col: str = "value") -> DataFrame:
    """Training-side counts of every fold without copying rows k times.

    ``counts`` holds (fold, keys..., value, cnt) from the natural rows; the
    training part of fold f is everything outside f, so its count of a value
    is total - own. Works on the distinct-value table, not on the rows."""
    keys = list(keys)
    tot = counts.groupBy(*keys, value_col).agg(F.sum("cnt").alias("_tot"))
    grid = tot.select(*keys, value_col, "_tot", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold_col))
    own = counts.select(fold_col, *keys, value_col, F.col("cnt").alias("_own"))
    j = grid.join(own, [fold_col, *keys, value_col], "left")
    out = j.select(fold_col, *keys, value_col, (F.col("_tot") - F.coalesce("_own", F.lit(0))).alias("cnt"))
    return out.where(F.col("cnt") > 0)


def quantile_name(p: float) -> str:
    s = f"{p:.4f}".rstrip("0").rstrip(".")
    return "q_" + s.replace(".", "_")
