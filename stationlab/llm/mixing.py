"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Only DataFrame expressions run here. Null sources form a source of their own, null texts have no words, repeated
ids and rows are rows of their own, an empty table gives an empty mix, further columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.indexing import dense_index
from ..functions.scale import durable
from .common import join_small, word_count

#: Docs of a source are laid out by hash into so many buckets; only the one that holds the cut is looked at row by row.
BUCKETS = 1024


def order_hash(ident: Column, seed: int) -> Column:
    """60 seeded bits of an id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("?")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def measured(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> list[Column]:
    """The narrow columns that every step works on: id, source, size, place in the sampling order."""
    text = F.col(text_col)
    return [
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(text).alias("_size"),
        order_hash(F.col(id_col), seed).alias("_h"), F.md5(F.coalesce(text, F.lit(""))).alias("_t"),
    ]


def source_targets(totals: DataFrame, weights: Sequence[float], share: float, max_epochs: float) -> DataFrame:
    """Targets of ``totals(_source, source_size)``: the water level rises until no share is above its source's clamp.

    Sources in code point order, null last, take ``weights`` in turn. Each round clamps the sources whose share passes
    ``max_epochs`` times their size and deals what is left by weight among the others; a round is one aggregate of the
    stored source table, and the level only rises, so the rounds end.
    """
    ids = dense_index(totals, ["_source"], "_rank")
    n = ids.count()
    rank = F.coalesce(F.col("_rank"), F.lit(n))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = durable(totals.join(ids, "_source", "left").withColumn("_w", weight).drop("_rank"))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    used = ranked.filter(F.col("source_size") > 0)
    total, all_w = used.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0.0))).first()
    budget = share * total
    level, clamped = (budget / all_w if all_w else 0.0), 0
    while all_w:
        over = cap <= F.col("_w") * F.lit(level)
        full, n_full, free = used.agg(
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(over.cast("int")), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("_w"))), F.lit(0.0))
        ).first()
        if n_full == clamped or not free:
            level = level if free else float("inf")
            break
        level, clamped = (budget - full) / free, n_full
    target = F.when(F.col("source_size") > 0, F.least(cap, F.col("_w") * F.lit(level))).otherwise(F.lit(0.0))
    return ranked.select("_source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The measured documents and, per source, its size, target, whole repetitions and where the fractional one is cut.

    The fraction takes documents in hash order as long as their middle lies below the words that are wanted. Bucket sums
    find the bucket that holds the cut, so no task sorts more than a 1024th of a source.
    """
    sized = durable(docs.select(*measured(docs, seed, id_col, text_col, source_col)))
    bucket = F.shiftright("_h", 50)
    sums = durable(sized.groupBy("_source", bucket.alias("_b")).agg(F.sum("_size").alias("_words")))
    targets = durable(source_targets(sums.groupBy("_source").agg(F.sum("_words").alias("source_size")), weights, share, max_epochs))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = targets.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    before = F.coalesce(F.sum("_words").over(Window.partitionBy("_source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = join_small(sums.withColumn("_before", before), plan, ["_source"], "inner").filter(
        (F.col("_before") <= F.col("extra")) & (F.col("extra") < F.col("_before") + F.col("_words"))
    )
    cuts = durable(at.select("_source", "_b", "_before", "extra"))
    inside = join_small(sized.withColumn("_b", bucket), cuts, ["_source", "_b"], "inner")
    order = Window.partitionBy("_source").orderBy("_h", "_size", "_t").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("_before") + F.coalesce(F.sum("_size").over(order), F.lit(0)) + F.col("_size") / 2
    last = inside.withColumn("_mid", middle).filter(F.col("_mid") <= F.col("extra")).groupBy("_source").agg(F.max(F.struct("_h", "_size", "_t")).alias("_cut"))
    tail = _with_cut(cuts.select("_source", "_b"), last)
    return sized, durable(_with_cut(plan.drop("extra"), tail))


def _with_cut(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of two per-source tables, null sources included."""
    r = right.select(F.col("_source").alias("_s"), *[c for c in right.columns if c != "_source" and c not in left.columns])
    return left.join(r, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")


def repetitions() -> Column:
    """How often the plan takes a measured document."""
    key = F.struct("_h", "_size", "_t")
    bucket = F.shiftright("_h", 50)
    below = (bucket < F.col("_b")) | ((bucket == F.col("_b")) & F.coalesce(key <= F.col("_cut"), F.lit(False)))
    return F.col("whole") + F.coalesce(below, F.lit(False)).cast("long")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: id, size, its source's size and target, and the words that the mix takes."""
    sized, plan = mix_plan(docs, **options)
    return join_small(sized, plan, ["_source"], "inner").select(
        F.col("_id").alias(options.get("id_col", "doc_id")), F.col("_size").alias("size"), "source_size", "target",
        (repetitions() * F.col("_size")).alias("taken"), repetitions().alias("repetitions"), F.col("_source").alias("source"),
    )


def mix(docs: DataFrame, copy_col: str = "repetition", **options) -> DataFrame:
    """The mixed corpus itself: every document as often as the plan takes it, numbered from 1 in ``copy_col``.

    A column of that name in ``docs`` gives way to the numbers.
    """
    names = {k: options.get(k, d) for k, d in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    _, plan = mix_plan(docs, **options)
    kept = [c for c in docs.columns if c.lower() != copy_col.lower()]
    rows = docs.select(F.struct(*kept).alias("_row"), *measured(docs, options.get("seed", 7), **names))
    taken = join_small(rows, plan, ["_source"], "inner").filter(repetitions() > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), repetitions())).alias("_copy")).select("_row.*", F.col("_copy").alias(copy_col))
