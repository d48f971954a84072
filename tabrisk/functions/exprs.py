"""Column expressions (JVM-side, whole-stage codegen friendly).

Every helper returns a ``Column``; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_tokens(labels: str | Column, sep_regex: str = "[|]") -> Column:
    """Split a multi-label string and trim every token."""
    return F.transform(F.split(col_(labels), sep_regex), lambda t: F.trim(t))


def assign_class(
    labels: str | Column,
    rules: Sequence[tuple[str, Sequence[str]]] = C.LABEL_RULES,
    default: str = C.DEFAULT_CLASS,
) -> Column:
    """Priority rules over the tokens of a ``|``-separated label string.

    NULL or blank -> default; the first rule owning any token wins.
    """
    lab = col_(labels)
    toks = label_tokens(lab)
    expr = F.when(lab.isNull() | (F.trim(lab) == ""), F.lit(default))
    for cls, tokens in rules:
        expr = expr.when(F.arrays_overlap(toks, F.array(*[F.lit(t) for t in tokens])), F.lit(cls))
    return expr.otherwise(F.lit(default))


def map_values(c: str | Column, mapping: dict, default=None) -> Column:
    """CASE mapping of literal keys (small, fixed maps)."""
    cc = col_(c)
    items = list(mapping.items())
    expr = F.when(cc == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(cc == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def encode_class(c: str | Column, mapping: dict = C.CLASS_TO_CODE) -> Column:
    """Class name -> int code (NULL when unknown; callers validate)."""
    return map_values(c, mapping).cast("int")


def null_sentinel(c: str | Column, sentinel: float = C.ELEVATION_SENTINEL) -> Column:
    """Sentinel value -> NULL."""
    return F.nullif(col_(c), F.lit(float(sentinel)))


def to_double(c: str | Column) -> Column:
    """Coerce to double; unparsable -> NULL."""
    return col_(c).cast("string").try_cast("double")


def clip_upper(c: str | Column, upper: str | Column | float) -> Column:
    """Upper clip; NULL stays NULL (``least`` would turn NULL into the bound)."""
    cc = col_(c)
    u = upper if isinstance(upper, Column) else (F.col(upper) if isinstance(upper, str) else F.lit(float(upper)))
    return F.when(cc > u, u).otherwise(cc)


def clip_lower(c: str | Column, lower: float) -> Column:
    """Lower clip with NULL kept NULL."""
    cc = col_(c)
    return F.when(cc < F.lit(float(lower)), F.lit(float(lower))).otherwise(cc)


def yeo_johnson(c: str | Column, lam: str | Column | float) -> Column:
    """Yeo-Johnson transform with a given lambda."""
    x = col_(c)
    lm = lam if isinstance(lam, Column) else (F.col(lam) if isinstance(lam, str) else F.lit(float(lam)))
    pos_nonzero = (F.pow(x + 1.0, lm) - 1.0) / lm
    pos_zero = F.log1p(x)
    neg_not_two = -(F.pow(1.0 - x, 2.0 - lm) - 1.0) / (2.0 - lm)
    neg_two = -F.log1p(-x)
    eps = 1e-12
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when((x >= 0) & (F.abs(lm) < eps), pos_zero)
        .when(x >= 0, pos_nonzero)
        .when(F.abs(lm - 2.0) < eps, neg_two)
        .otherwise(neg_not_two)
    )


def right_closed_bins(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut`` with right-closed bins (-inf, e1], (e1, e2], ... (ek, inf)."""
    cc = col_(c)
    expr = F.when(cc.isNull(), F.lit(None).cast("string"))
    for e, lab in zip(edges, labels):
        expr = expr.when(cc <= F.lit(float(e)), F.lit(lab))
    return expr.otherwise(F.lit(labels[len(edges)]))


def is_event_token(t: str | Column) -> Column:
    """``event_YYYY-MM-DD`` tokens."""
    return col_(t).rlike(C.EVENT_TOKEN_PATTERN)


def threshold_classes(score: str | Column, t1: str | Column | float, t2: str | Column | float) -> Column:
    """P25: ordinal thresholds: score >= t2 -> 2, >= t1 -> 1, else 0."""
    s = col_(score)
    a = t1 if isinstance(t1, Column) else F.lit(float(t1))
    b = t2 if isinstance(t2, Column) else F.lit(float(t2))
    return F.when(s >= b, F.lit(2)).when(s >= a, F.lit(1)).otherwise(F.lit(0))


def softmax(scores: str | Column) -> Column:
    """Numerically stable softmax of an array<double> column."""
    arr = col_(scores)
    m = F.array_max(arr)
    ex = F.transform(arr, lambda v: F.exp(v - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(ex, lambda v: v / tot)


def sigmoid(x: str | Column) -> Column:
    return 1.0 / (1.0 + F.exp(-col_(x)))


def argmax(arr: str | Column) -> Column:
    """Index of the largest element; ties go to the lowest index."""
    a = col_(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def huber_loss(residual: str | Column, delta: float) -> Column:
    """Huber loss of a residual."""
    r = F.abs(col_(residual))
    return F.when(r <= delta, 0.5 * r * r).otherwise(delta * (r - 0.5 * delta))


def huber_grad(residual: str | Column, delta: float) -> Column:
    r = col_(residual)
    return F.when(F.abs(r) <= delta, r).otherwise(delta * F.signum(r))


def overfit_flag(gap: str | Column, limit: float = C.OVERFIT_GAP) -> Column:
    """Train-CV gap above the limit."""
    return (col_(gap) > F.lit(limit)).cast("int")


def overfit_risk(gap: str | Column) -> Column:
    g = col_(gap)
    return F.when(g > C.OVERFIT_GAP, "high").when(g > C.OVERFIT_GAP_WARN, "moderate").otherwise("low")


def skew_severity(skew: str | Column) -> Column:
    """Abs skew > 1 heavy, > 0.5 moderate, else low."""
    s = F.abs(col_(skew))
    return F.when(s > C.SKEW_HEAVY, "heavy").when(s > C.SKEW_MODERATE, "moderate").otherwise("low")


def class_weight(label: str | Column, weights: dict = C.DEFAULT_CLASS_WEIGHTS, default: float = 1.0) -> Column:
    """Explicit per-class row weight, default for unlisted classes."""
    return F.coalesce(map_values(label, {int(k): float(v) for k, v in weights.items()}), F.lit(float(default)))


#: Numbers that :func:`seeded_hash` can give: 0 .. 2**32 - 1.
HASH_SIZE = 2**32


def seeded_hash(key_cols: Sequence[str], seed: int) -> Column:
    """Deterministic pseudo-random integer in [0, 2**32) from a seed and integer key columns.

    The first eight hex digits of the MD5 of seed and keys: another seed gives an
    unrelated order, the same in every engine and for every partitioning. Used
    for seeded sampling and stratified assignment.
    """
    text = F.concat_ws("|", F.lit(str(int(seed))), *[F.col(k).cast("long").cast("string") for k in key_cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def seeded_hash_sql(key_cols: Sequence[str], seed: int) -> str:
    """The same hash as SQL text."""
    keys = ", ".join(f"CAST(CAST({k} AS BIGINT) AS VARCHAR)" for k in key_cols)
    return f"CAST('0x' || substr(md5(concat_ws('|', '{int(seed)}', {keys})), 1, 8) AS BIGINT)"


# ------------------------------------------------------- tail probabilities ---
#: Coefficients of Lanczos' approximation of the gamma function for g = 7 (fixed values).
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function for x >= 0.5."""
    z = x - 1.0
    s = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        s = s + F.lit(c) / (z + float(i))
    t = z + 7.5
    return F.lit(0.9189385332046727) + (z + 0.5) * F.log(t) - t + F.log(s)


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function by Lentz's method; it stands still once it has settled."""
    tiny = F.lit(1e-300)
    away = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def turn(state: Column, term: Column) -> Column:
        d, c = away(term * state["d"] + 1.0), away(term / state["c"] + 1.0)
        return F.struct((F.lit(1.0) / d).alias("d"), c.alias("c"), (state["h"] * c / d).alias("h"), F.lit(False).alias("done"))

    def step(state: Column, i: Column) -> Column:
        m = i.cast("double")
        even = m * (b - m) * x / ((a + m * 2.0 - 1.0) * (a + m * 2.0))
        odd = -(a + m) * (a + b + m) * x / ((a + m * 2.0) * (a + m * 2.0 + 1.0))
        first = turn(state, even)
        second = turn(first, odd)
        settled = F.struct(second["d"].alias("d"), second["c"].alias("c"), second["h"].alias("h"), (F.abs(second["d"] * second["c"] - 1.0) < 1e-15).alias("done"))
        return F.when(state["done"], state).otherwise(settled)

    d0 = F.lit(1.0) / away(F.lit(1.0) - (a + b) * x / (a + 1.0))
    start = F.struct(d0.alias("d"), F.lit(1.0).alias("c"), d0.alias("h"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["h"])


def student_t_two_sided(t: Column, dof: Column, steps: int = 2000) -> Column:
    """The probability of a t at least that far from 0, by the incomplete beta function; null without a t or degree of freedom.

    For small tables: it evaluates a continued fraction of up to ``steps`` turns a row.
    More than four million degrees of freedom count as four million.
    """
    v = F.least(dof.cast("double"), F.lit(4e6))
    x, y = v / (v + t * t), t * t / (v + t * t)
    a, b = v / 2.0, F.lit(0.5)
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(y))
    near = front * _beta_fraction(a, b, x, steps) / a
    far = F.lit(1.0) - front * _beta_fraction(b, a, y, steps) / b
    p = F.when(t == 0, 1.0).when(F.abs(t) == float("inf"), 0.0).when(x < (a + 1.0) / (a + b + 2.0), near).otherwise(far)
    return F.when(t.isNotNull() & (dof >= 1), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
