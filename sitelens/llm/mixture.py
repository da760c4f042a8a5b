"""Mixing sources to target weights with a time-varying curriculum.

Every source has a target number of words: its weight's share of all words,
but at most ``cap`` times its own size, the excess reshared by weight until
no target is above its cap. The source's rate over training time is a
piecewise-linear schedule; its integral, scaled to the target, is the
cumulative demand. The source's documents follow each other in a fixed
pseudo-random order, pass after pass; a document's training position is the
time at which the demand reaches the document's first word, found by
inverting the integral. Sorting by position gives the training order.

All of it is DataFrame functions. Cumulative word counts go through buckets
of the order key (sums of buckets first, then rows within a bucket), so no
task ever holds a whole source.

Defined cases: a null text has no words; a null source is a source of its
own that sorts last; a null id counts as the text ``null``; rows with the
same id and size are interchangeable; sources without words have target 0;
an empty table gives an empty result. Columns of the input with names of the
output's own columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.textops import WORD, staged
from sitelens.operators.ranking import grouped_row_number

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
#: For each weight, knots (time, rate) of its schedule: heavy sources early,
#: light ones late. Only the shape matters; the integral is scaled to the target.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
_ROWS_A_BUCKET = 400
_MOST_BUCKET_BITS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(id_col: Column) -> Column:
    """60 pseudo-random bits of the id, the same in every run and engine."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with weight_class, weight and target.

    The level L with target = min(cap * size, L * weight) is found by
    repeating the reshare: each round is one aggregate over the sources."""
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    rank = grouped_row_number(sizes, [], [F.col("source").asc_nulls_last()], "_rank")
    table = staged(rank.withColumn("weight_class", ((F.col("_rank") - 1) % len(weights)).cast("int"))
                        .withColumn("weight", kinds[F.col("weight_class")]).drop("_rank"), "mix_sources")
    limit = F.col("source_size") * float(cap)

    def level_after(level: float) -> float:
        over = F.col("weight") * level > limit
        r = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, limit).otherwise(0.0)).alias("capped"),
                      F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        return (r["all"] - r["capped"]) / r["open"] if r["open"] else level

    level, last = level_after(0.0), -1.0
    while level > last:
        level, last = level_after(level), level
    return table.withColumn("target", F.least(limit, F.col("weight") * level))


def position(share: Column, weight_class: Column, schedules=SCHEDULES) -> Column:
    """The time at which ``share`` of a source's demand is used up: the
    inverse of the integral of its piecewise-linear rate."""
    out = F.lit(None).cast("double")
    for kind, knots in enumerate(schedules):
        areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        before, whole = 0.0, sum(areas)
        expr = F.lit(float(knots[-1][0]))
        steps = []
        for ((t0, r0), (t1, r1)), area in zip(zip(knots, knots[1:]), areas):
            need = share * whole - before
            slope = (r1 - r0) / (t1 - t0)
            # r0 x + slope x^2 / 2 = need, in the form that also holds for slope 0
            root = F.lit(t0) + need * 2 / (F.sqrt(F.greatest(F.lit(r0 * r0) + need * (2 * slope), F.lit(0.0))) + r0)
            steps.append(((before + area) / whole, F.least(F.greatest(root, F.lit(t0)), F.lit(t1))))
            before += area
        for end, root in reversed(steps):
            expr = F.when(share <= end, root).otherwise(expr)
        out = F.when(weight_class == kind, expr).otherwise(out)
    return out


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: Sequence[float] = WEIGHTS, cap: int = CAP, schedules=SCHEDULES, cut: bool = True,
          keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: id, source, the ``keep`` columns, size, source_size,
    target, taken, and ``uses``: an array of (pass, words, position), at most
    ``cap`` long, one for each time the mix takes the document.

    With ``cut`` the last document of a source's last pass is taken up to the
    word at which the target is reached; without, it is taken whole if more
    than half of it lies before the target."""
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), word_count(F.col(text_col)).alias("_n"),
                       order_key(F.col(id_col)).alias("_key"), *kept)
    if not kept:  # counted once; rows that carry more are too wide to be worth a copy
        rows = staged(rows, "mix_sizes")
    n = docs.count()
    bits = max(0, min(_MOST_BUCKET_BITS, math.ceil(math.log2(max(1, n / _ROWS_A_BUCKET)))))
    rows = rows.withColumn("_bucket", F.shiftright("_key", 60 - bits))
    sums = staged(rows.groupBy("_src", "_bucket").agg(F.sum("_n").alias("_sum")), "mix_buckets")
    sizes = sums.groupBy(F.col("_src").alias("source")).agg(F.sum("_sum").alias("source_size"))
    targets = source_targets(sizes, weights, cap)
    earlier = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (sums.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
               .join(targets, F.col("_src").eqNullSafe(F.col("source")))
               .select(F.col("_src").alias("_bsrc"), F.col("_bucket").alias("_bbucket"), "_base", "source_size", "target", "weight_class"))
    within = (Window.partitionBy("_src", "_bucket").orderBy("_key", F.col("_id").asc_nulls_first(), "_n")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.join(buckets, F.col("_src").eqNullSafe(F.col("_bsrc")) & (F.col("_bucket") == F.col("_bbucket")))
              .withColumn("_at", F.col("_base") + F.coalesce(F.sum("_n").over(within), F.lit(0))))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    passes = F.least(passes, F.lit(cap)).cast("int")
    rest = F.col("target") - F.col("_passes") * F.col("source_size")
    if cut:
        last = F.least(F.col("_n"), F.greatest(F.round(rest).cast("long") - F.col("_at"), F.lit(0)))
    else:
        last = F.when(F.col("_at") + F.col("_n") / 2 < rest, F.col("_n")).otherwise(0)

    def use(number: Column, words: Column) -> Column:
        share = F.when(F.col("target") > 0, (number * F.col("source_size") + F.col("_at")) / F.col("target")).otherwise(0.0)
        return F.struct(number.cast("int").alias("pass"), words.cast("long").alias("words"),
                        position(share, F.col("weight_class"), schedules).alias("position"))

    full = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: use(i, F.col("_n")))
    # A document without words takes no room: it belongs to every full pass, and to the last one if it starts before the target.
    in_last = (F.col("_last") > 0) | ((F.col("_n") == 0) & (F.col("_at") < rest))
    uses = F.concat(F.slice(full, F.lit(1), F.col("_passes")), F.when(in_last, F.array(use(F.col("_passes"), F.col("_last")))).otherwise(
        F.slice(full, 1, 0)))
    return (placed.withColumn("_passes", passes).withColumn("_last", last).withColumn("uses", uses)
            .select(F.col("_id").alias(id_col), F.col("_src").alias(source_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                    F.col("_n").alias("size"), F.col("source_size").cast("long").alias("source_size"), "target",
                    F.aggregate("uses", F.lit(0).cast("long"), lambda a, u: a + u["words"]).alias("taken"), "uses"))


def training_order(mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each use of a document, range-sorted by training position."""
    used = mix.select("*", F.inline("uses")).drop("uses")
    keys = [F.col("position"), F.col(id_col).asc_nulls_first(), F.col("pass")]
    return used.repartitionByRange(*keys).sortWithinPartitions(*keys)


def by_first_use(mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``mixed`` with the ``position`` of their first use, range-sorted by it, as
    ``training_order`` first takes them; documents without a use have none and come last."""
    keys = [F.col("position").asc_nulls_last(), F.col(id_col).asc_nulls_first(), F.col("size")]
    first = mix.withColumn("position", F.get("uses", F.lit(0))["position"])
    return first.repartitionByRange(*keys).sortWithinPartitions(*keys)
