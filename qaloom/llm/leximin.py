"""Problem 4: one ranking from several differently-scaled scores.

Method: leximin ordering. Each score becomes its percentile among the candidates of the
same item, each candidate's own percentiles are sorted ascending, and candidates are
compared lexicographically on these arrays, so that a weak score cannot be masked.

Edge cases: a null or NaN score gets the mean of the candidate's own other percentiles
(one half where it has none), which neither lifts nor sinks it; equal scores share their
mid-rank; a pair delivered again, reversed or scored again is one pair with the mean of
its scores; null keys and pairs of a row with itself are left out; remaining ties go to
the smaller ``j``; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.runtime import HOT_SHARE, Scratch, join_sized

#: Groups above this many rows are ranked over range partitions instead of in one task.
LARGE_GROUP = 100_000


def standing(df: DataFrame, group: str, value: str, less: str, same: str) -> DataFrame:
    """``df`` with the numbers of rows of its group with a smaller and with the same value.

    For groups of any size: distinct values are counted, sorted by range partition, and
    summed in two levels (within a partition, then over partitions). The ranges are written
    once, so both levels see the same ones; a value with very many rows is broadcast.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias(same))
    parted = counts.repartitionByRange(F.col(group), F.col(value)).withColumn("__part", F.spark_partition_id())
    parted = Scratch(df.sparkSession, "standing").put(parted)
    within = Window.partitionBy("__part", group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    totals = parted.groupBy(group, "__part").agg(F.sum(same).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    parted = parted.withColumn("__below", F.coalesce(F.sum(same).over(within), F.lit(0)))
    ranked = parted.join(totals, [group, "__part"]).select(group, value, same, (F.col("__below") + F.col("__before")).alias(less), F.col(same).alias("__rows"))
    known = join_sized(df.filter(F.col(value).isNotNull()), ranked, [group, value], "__rows", df.count())
    rest = df.filter(F.col(value).isNull()).withColumns({same: F.lit(None).cast("long"), less: F.lit(None).cast("long")})
    return known.select(*df.columns, same, less).unionByName(rest)


def percentiles(df: DataFrame, group: str, scores: list[str], large: int = LARGE_GROUP) -> DataFrame:
    """``df`` with ``p_<score>`` in (0, 1), null where the score is, and ``n``, the group's rows.

    ``df`` is a written table. Groups are counted by the same window that ranks them; the
    few above ``large`` rows, if the table can hold one at all, go by ``standing``.
    """
    total = df.count()
    sizes = df.groupBy(group).agg(F.count("*").alias("n"), *[F.count(s).alias(f"n_{s}") for s in scores])
    hot_keys = sizes.filter(F.col("n") > max(large, total // HOT_SHARE)) if total > large else None
    few = df if hot_keys is None else df.join(F.broadcast(hot_keys.select(group)), group, "left_anti")
    w = Window.partitionBy(group)
    few = few.withColumns({"n": F.count("*").over(w), **{f"n_{s}": F.count(s).over(w) for s in scores}})
    for s in scores:
        less = F.rank().over(w.orderBy(F.col(s).asc_nulls_last())) - 1
        same = F.count(s).over(w.orderBy(F.col(s).asc_nulls_last()).rangeBetween(0, 0))
        few = few.withColumn(f"p_{s}", F.when(F.col(s).isNotNull(), (less + same / 2) / F.col(f"n_{s}")))
    few = few.drop(*[f"n_{s}" for s in scores])
    if hot_keys is None:
        return few
    # Fewer than one key in HOT_SHARE rows is hot: a broadcast of bounded size.
    hot = df.join(F.broadcast(hot_keys), group)
    for s in scores:
        hot = standing(hot, group, s, "__less", "__same")
        hot = hot.withColumn(f"p_{s}", F.when(F.col(s).isNotNull(), (F.col("__less") + F.col("__same") / 2) / F.col(f"n_{s}"))).drop("__less", "__same")
    return few.unionByName(hot.select(*few.columns))


def one_per_pair(df: DataFrame, i: str, j: str, scores: list[str]) -> DataFrame:
    """Each unordered pair once, smaller key first, with the mean of its scores."""
    clean = [F.avg(F.when(~F.isnan(F.col(s).cast("double")), F.col(s).cast("double"))).alias(s) for s in scores]
    pairs = df.filter(F.col(i).isNotNull() & F.col(j).isNotNull() & (F.col(i) != F.col(j)))
    return pairs.groupBy(F.least(i, j).alias("i"), F.greatest(i, j).alias("j")).agg(*clean)


def weakest_first(scores: list[str]) -> Column:
    """The sorted vector of a candidate; larger arrays rank higher."""
    ps = [F.col(f"p_{s}") for s in scores]
    known = reduce(lambda a, b: a + b, [p.isNotNull().cast("int") for p in ps])
    mean = F.when(known > 0, reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in ps]) / known).otherwise(0.5)
    return F.sort_array(F.array(*[F.round(F.coalesce(p, mean), 12) for p in ps]))


def scored(df: DataFrame, i: str, j: str, scores: list[str], large: int = LARGE_GROUP) -> DataFrame:
    """``i, j, n, fused``: each pair, the candidates of its ``i``, its leximin vector."""
    pairs = Scratch(df.sparkSession, "pairs").put(one_per_pair(df, i, j, scores))
    pairs = percentiles(pairs, "i", scores, large)
    return pairs.select("i", "j", "n", weakest_first(scores).alias("fused"))


def ranking(df: DataFrame, i: str, j: str, scores: list[str], large: int = LARGE_GROUP) -> DataFrame:
    """``i, j, place, weakest``: all pairs in order within their ``i``."""
    s = Scratch(df.sparkSession, "scored").put(scored(df, i, j, scores, large))
    few = s.filter(F.col("n") <= large).withColumn("place", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("fused"), "j")).cast("long"))
    if s.count() <= large:
        return few.select("i", "j", "place", F.element_at("fused", 1).alias("weakest"))
    hot = s.filter(F.col("n") > large).withColumn("__key", F.struct("fused", (-F.col("j")).alias("j")))
    hot = standing(hot, "i", "__key", "__less", "__same").withColumn("place", F.col("n") - F.col("__less"))
    both = few.unionByName(hot.select(*few.columns))
    return both.select("i", "j", "place", F.element_at("fused", 1).alias("weakest"))


def first(df: DataFrame, i: str, j: str, scores: list[str], at_least: int = 1, large: int = LARGE_GROUP) -> DataFrame:
    """``i, j``: the best pair of each ``i`` with ``at_least`` candidates."""
    s = scored(df, i, j, scores, large).filter(F.col("n") >= at_least)
    best = s.groupBy("i").agg(F.max(F.struct("fused", (-F.col("j")).alias("j"))).alias("top"))
    return best.select("i", (-F.col("top.j")).alias("j"))
