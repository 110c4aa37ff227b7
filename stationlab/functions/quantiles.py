"""Exact and approximate quantiles.

The built-in exact percentile keeps every distinct value of a group in one buffer. The exact path here takes two scans,
whatever the data. The first makes a mergeable KLL sketch per (group, column); its error bound gives each wanted rank a
bracket of values. The second counts the rows below each bracket and, by value, those inside; rows outside all brackets
are combined into counts before the shuffle. The wanted rank is then found among the values of its bracket.

A sketch keeps its bound only almost surely. The second scan tells whether a rank lies in its bracket; one that does not,
and one whose bracket has very many values, is narrowed down by histograms: buckets that hold a wanted rank are split, by
value and by logarithm in turn, until each holds one value. No group is ever gathered, and the answer is exact either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import literal, quoted, value_sql
from .scale import durable

BUCKETS = 2048
#: Size of a sketch, and the part of the rows to both sides of a rank that a bracket takes: three times the sketch's
#: error at 99 % (0.0024).
SKETCH, MARGIN = 2000, 0.0075
#: A bracket with more different values than this is narrowed down by histograms.
SORTED = 1_000_000


def _long(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"named_struct('column', {literal(c)}, 'value', {value_sql(df, c)})" for c in cols)
    return df.selectExpr(*map(quoted, keys), f"inline(array({pairs}))").filter("value IS NOT NULL")


def _flat(x: Column) -> Column:
    """Sign and logarithm of a value, infinities at the ends of the scale."""
    return F.signum(x) * F.least(F.log1p(F.abs(x)), F.lit(800.0))


def _bucket(x: Column, lo: Column, hi: Column, by_log: bool) -> Column:
    """Bucket of a value between two different bounds; the bounds never share one."""
    plain, log = (x, lo, hi), (_flat(x), _flat(lo), _flat(hi))
    wide = hi - lo == float("inf")  # also where a bound is infinite
    even = log[2] - log[1] <= 0

    def step(v, a, b):
        return F.least(F.floor(F.try_divide(v - a, b - a) * F.lit(BUCKETS)), F.lit(BUCKETS - 1))

    use_log = wide | (F.lit(by_log) & ~even)
    return F.when(x == hi, F.lit(BUCKETS)).when(use_log, step(*log)).otherwise(step(*plain)).cast("int")


def _locate(counted: DataFrame, wanted: DataFrame, group: list[str], by: str) -> DataFrame:
    """Find for each wanted rank the ``by`` entry that holds it; the rank becomes relative to it."""
    w = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = counted.withColumn("_end", F.sum("_n").over(w)).withColumn("_start", F.col("_end") - F.col("_n"))
    ask = wanted.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(group)], *[c for c in wanted.columns if c not in group])
    hit = run.join(ask, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(group)]))
    return (
        hit.filter((F.col("_start") <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
        .withColumn("_rank", F.col("_rank") - F.col("_start"))
        .drop("_start", "_end", "_n", *[f"_w{i}" for i in range(len(group))])
    )


def _ranks(prob: float, kind: str, place: int) -> Column:
    n = F.col("_count")
    if kind == "disc":
        r = F.greatest(F.ceil(F.lit(prob) * n) - 1, F.lit(0))
        lo, hi, frac = r, r, F.lit(0.0)
    else:
        pos = F.lit(prob) * (n - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        frac = pos - lo
    return F.array(
        F.struct(F.lit(place).alias("_j"), F.lit(prob).alias("prob"), F.lit(0).alias("_side"), lo.cast("long").alias("_rank"), frac.alias("_frac")),
        F.struct(F.lit(place).alias("_j"), F.lit(prob).alias("prob"), F.lit(1).alias("_side"), hi.cast("long").alias("_rank"), frac.alias("_frac")),
    )


def _narrowed(rows: DataFrame, at: DataFrame, group: list[str]) -> list[DataFrame]:
    """Values of the wanted ranks ``at(group.., prob, _side, _rank, _frac, _lo, _hi)`` among ``rows(group.., value, _n)``.

    ``_lo`` and ``_hi`` bound the rank's value. The located buckets are small tables and are stored between the passes.
    """
    found, passes = [at.filter("_lo = _hi")], 0
    at = at.filter("_lo < _hi")
    while not at.isEmpty():
        cells = at.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(group)], "_lo", "_hi").distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(group)]
        inside = rows.join(cells, reduce(Column.__and__, same)).filter("value BETWEEN _lo AND _hi")
        b = _bucket(F.col("value"), F.col("_lo"), F.col("_hi"), passes % 2 == 1)
        cell = [*group, "_lo", "_hi"]
        counted = inside.groupBy(*cell, b.alias("_b")).agg(F.sum("_n").alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high"))
        hit = _locate(counted, at, cell, "_b").drop("_lo", "_hi", "_b")
        at = durable(hit.withColumnsRenamed({"_low": "_lo", "_high": "_hi"}))
        found.append(at.filter("_lo = _hi"))
        at, passes = at.filter("_lo < _hi"), passes + 1
    return [f.withColumn("value", F.col("_lo")) for f in found]


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), kind: str = "cont"
) -> DataFrame:
    """Rows ``(keys..., column, prob, value)``; NULL and NaN are left out.

    ``kind="cont"`` interpolates linearly between neighbours, ``kind="disc"`` returns the smallest
    value whose cumulative share reaches ``prob``. ``df`` is read twice: store it first if it is dear to make.
    """
    keys, probs = list(keys), list(probs)
    group = [*keys, "column"]
    rows = _long(df, cols, keys)
    # first scan: a bracket for each probability; its ends are the extremes where the margin reaches beyond them
    sketch = F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("_s")
    made = rows.groupBy(*group).agg(F.count("*").alias("_count"), F.min("value").alias("_min"), F.max("value").alias("_max"), sketch)
    few = F.col("_count") * MARGIN < 4

    def ends(shift, extreme):
        wanted = [min(max(p + shift, 0.0), 1.0) for p in probs]
        got = F.kll_sketch_get_quantile_double("_s", F.array(*map(F.lit, wanted)))
        return F.array(*[F.when(few | F.lit(w in (0.0, 1.0)), F.col(extreme)).otherwise(got[j]) for j, w in enumerate(wanted)])

    brackets = durable(made.select(*group, "_count", "_min", "_max", ends(-MARGIN, "_min").alias("_low"), ends(MARGIN, "_max").alias("_high")))
    # second scan: per row and bracket b (below), i (inside) or a (above)
    named = brackets.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(group)], "_low", "_high")
    v = F.col("value")
    place = F.concat(*[F.when(v < F.col("_low")[j], "b").when(v > F.col("_high")[j], "a").otherwise("i") for j in range(len(probs))])
    joined = rows.join(named, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(group)]))
    placed = joined.select(*group, place.alias("_place"), v).withColumn("value", F.when(F.contains("_place", F.lit("i")), v))
    counted = durable(placed.groupBy(*group, "_place", "value").agg(F.count("*").alias("_n")))

    cells = counted.select("*", F.posexplode(F.split("_place", "")).alias("_j", "_where")).drop("_place")
    inside = F.col("_where") == "i"
    totals = cells.groupBy(*group, "_j").agg(
        F.sum(F.when(F.col("_where") == "b", F.col("_n")).otherwise(0)).alias("_below"), F.sum(F.when(inside, F.col("_n")).otherwise(0)).alias("_in"), F.count_if(inside).alias("_values")
    )
    asked = F.flatten(F.array(*[_ranks(p, kind, j) for j, p in enumerate(probs)]))
    known = totals.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(group)], F.col("_j").alias("_gj"), "_below", "_in", "_values")
    same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(group)]
    at = brackets.select("*", F.inline(asked)).join(known, reduce(Column.__and__, same, F.col("_j") == F.col("_gj")), "left")
    hit = F.coalesce((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_in")), F.lit(False))
    at = durable(at.withColumn("_hit", hit).drop(*[f"_g{i}" for i in range(len(group))], "_gj"))
    wanted = ["prob", "_side", "_frac"]
    within = F.col("_rank") - F.col("_below")
    easy = at.filter(F.col("_hit") & (F.col("_values") <= SORTED)).select(*group, "_j", *wanted, within.alias("_rank"))
    lines = cells.filter(inside).select(*group, "_j", "value", "_n")
    found = [_locate(lines, easy, [*group, "_j"], "value")]
    if not at.filter(~F.col("_hit") | (F.col("_values") > SORTED)).isEmpty():
        bounds = [F.get("_low", F.col("_j")).alias("_lo"), F.get("_high", F.col("_j")).alias("_hi")]
        large = at.filter(F.col("_hit") & (F.col("_values") > SORTED)).select(*group, "_j", *wanted, within.alias("_rank"), *bounds)
        found += _narrowed(lines, large, [*group, "_j"])
        missed = at.filter(~F.col("_hit")).select(*group, *wanted, "_rank", F.col("_min").alias("_lo"), F.col("_max").alias("_hi"))
        found += _narrowed(rows.withColumn("_n", F.lit(1)), missed, group)
    cols_ = [*group, "prob", "_side", "_frac", "value"]
    values = reduce(DataFrame.union, [f.select(*cols_) for f in found])
    sides = values.groupBy(*group, "prob").agg(
        F.max(F.when(F.col("_side") == 0, F.col("value"))).alias("_low"),
        F.max(F.when(F.col("_side") == 1, F.col("value"))).alias("_high"),
        F.max("_frac").alias("_frac"),
    )
    v = F.when((F.col("_frac") == 0) | (F.col("_low") == F.col("_high")), F.col("_low")).otherwise(
        F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")
    )
    return sides.select(*group, "prob", v.alias("value"))


def approx_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), relative_error: float = 0.01
) -> DataFrame:
    """The same table from one mergeable sketch per (group, column): one scan, bounded memory."""
    accuracy = F.lit(max(int(round(1 / relative_error)), 1))
    rows = _long(df, cols, keys)
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    sketch = rows.groupBy(*keys, "column").agg(F.percentile_approx("value", wanted, accuracy).alias("_v"))
    pairs = F.arrays_zip(wanted.alias("prob"), F.col("_v").alias("value"))
    return sketch.select(*keys, "column", F.inline(pairs).alias("prob", "value"))


def quantiles(df, cols, probs, keys=(), exact: bool = True, relative_error: float = 0.01) -> DataFrame:
    if exact:
        return exact_quantiles(df, cols, probs, keys)
    return approx_quantiles(df, cols, probs, keys, relative_error)


def quantile_row(long: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """An ungrouped quantile table as one row with columns ``q__<i>__<j>`` (column, probability by position)."""
    cells = [
        f"max(CASE WHEN column = {literal(c)} AND prob = {float(p)!r}D THEN value END) AS q__{i}__{j}"
        for i, c in enumerate(cols)
        for j, p in enumerate(probs)
    ]
    return long.selectExpr(*cells)
