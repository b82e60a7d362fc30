"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entitylake.llm.batches import column, word_count
from entitylake.session import materialized

WEIGHTS = (1, 2, 3)
MOST = 3
# Characters that lower a text's quality weight.
SYMBOLS = "0123456789#*$%&|<>!=_{}[]~^\\"
STEPS = (64, 65_536)


def quality(text: Column) -> Column:
    """A weight between 0.1 and 1: the share of characters that are no digits or symbols."""
    plain = F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.lit(0.1) + F.lit(0.9) * plain / F.nullif(F.length(text), F.lit(0)), F.lit(0.1))


def exponential(key: Column, text: Column, weight: Column) -> Column:
    """An exponential variate over ``weight``; the draw follows from the key, without one from the text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.md5(text), F.lit(""))), 1, 13)
    drawn = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(drawn) / weight


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place``, a source's place by code points from 0, null last."""
    ranges = materialized(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    sizes = ranges.groupBy("part").count()  # a row per partition
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return ranges.withColumn("own", own).join(before, "part").withColumn("place", F.col("before") + F.col("own") - 1)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` for ``sizes (source, source_size)``.

    Sources weigh ``weights`` in turn and share the total. No target goes above ``most`` times
    its source's size; what is above is shared among the others by weight, again and again.
    """
    weigh = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1)
    own = materialized(_ranked(sizes).select("source", "source_size", weigh.cast("long").alias("weight")), "weights")
    total, every = own.agg(F.sum("source_size"), F.sum("weight")).first()
    level, known = ((total or 0) / every if every else 0.0), 0
    while True:
        above = F.col("source_size") * most < F.col("weight") * F.lit(level)
        held = own.where(above).agg(F.sum("source_size"), F.sum("weight"), F.count("*")).first()
        if held[2] == known:
            break
        known, level = held[2], (total - most * held[0]) / (every - held[1])
    capped = (F.col("source_size") * most).cast("double")
    return own.select("source", "source_size", F.least(capped, F.col("weight") * F.lit(level)).alias("target"))


def _crossing(rows: DataFrame, sources: DataFrame, step: int) -> DataFrame:
    """Adds to ``sources`` the bucket of keys in which its ``rest`` is used up, and what is left there."""
    sums = rows.groupBy("source", F.floor(F.log("draw") * step).alias("bucket")).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    sums = sums.withColumn("upto", upto).alias("s")
    joined = sources.alias("t").join(
        sums,
        F.col("t.source").eqNullSafe(F.col("s.source"))
        & (F.col("rest") < F.col("upto"))
        & (F.col("rest") >= F.col("upto") - F.col("words")),
        "left",
    )
    left = (F.col("rest") - F.col("upto") + F.col("words")).alias("left")
    return joined.select("t.*", F.col("bucket").alias(f"at{step}"), left).drop("rest").withColumnRenamed("left", "rest")


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """``(row, size, source_size, target, taken)``; ``row`` is a struct of all columns of ``docs``.

    Each source gets its target in words: first as many complete epochs as fit, then documents in
    the order of their exponential keys over their quality weights, until the rest is used up. The
    document that crosses the end is taken whole if at least half of it lies before the end, else
    not at all, so a source misses its target by at most half that document. Keys are drawn from the
    document's key, without one from its text, so reruns agree. A hot source's prefix sums are cut into buckets of keys, in
    two levels; only the rows of the last bucket are ordered one by one. Null texts have size 0
    and are never taken; a null source is one more source.
    """
    body = column(docs, text).cast("string")
    own = docs.select(
        F.struct(*(column(docs, name) for name in docs.columns)).alias("row"),
        column(docs, source).alias("source"),
        column(docs, key).cast("string").alias("key"),
        word_count(body).alias("size"),
        exponential(column(docs, key), body, quality(body)).alias("draw"),
    )
    slim = materialized(own.select("source", "size", "draw"), "sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    words = F.round("target").cast("long")
    size = F.nullif(F.col("source_size"), F.lit(0))
    plan = targets(sizes, weights, most).select(
        "*", F.coalesce(F.floor(words / size), F.lit(0)).alias("epochs"),
        F.coalesce(words % size, F.lit(0)).alias("rest"),
    )
    plan = materialized(plan, "plan")
    coarse, fine = STEPS
    plan = materialized(_crossing(slim, plan, coarse), "plan")
    bucket = lambda step: F.floor(F.log("draw") * step)
    last = (
        slim.alias("d")
        .join(plan.select("source", f"at{coarse}").alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .where(bucket(coarse) == F.col(f"at{coarse}"))
        .select("d.*")
    )
    plan = materialized(_crossing(last, plan, fine), "plan")
    joined = own.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    joined = joined.select("d.*", "source_size", "target", "epochs", "rest", f"at{coarse}", f"at{fine}")
    at, near = F.col(f"at{coarse}"), F.col(f"at{fine}")
    on_edge = F.coalesce((bucket(coarse) == at) & (bucket(fine) == near), F.lit(False))
    inside = F.coalesce((bucket(coarse) < at) | ((bucket(coarse) == at) & (bucket(fine) < near)), F.lit(False))
    names = ["row", "size", "source_size", "target"]
    whole = joined.where(~on_edge).select(
        *names, (F.col("size") * (F.col("epochs") + inside.cast("long"))).alias("taken")
    )
    text_hash = F.md5(F.col("row")[text].cast("string"))
    order = Window.partitionBy("source").orderBy("draw", "key", "size", text_hash).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("size").over(order) - F.col("size")
    taken = (2 * (F.col("rest") - before) >= F.col("size")).cast("long")
    edge = joined.where(on_edge).select(*names, (F.col("size") * (F.col("epochs") + taken)).alias("taken"))
    return whole.union(edge)


def rows_of_mix(docs: DataFrame, **names: str) -> DataFrame:
    """The mix itself: a document comes once, unchanged, for each time it is taken."""
    mix = mixed(docs, **names)
    times = F.coalesce(F.col("taken") / F.nullif(F.col("size"), F.lit(0)), F.lit(0)).cast("int")
    copies = mix.select("row", F.explode(F.array_repeat(F.lit(0), times)))
    return copies.select(*(F.col("row")[name].alias(name) for name in docs.columns))
