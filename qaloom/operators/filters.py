"""Stage 1: normalise, filter with reasons, account for them, and number what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.functions import text
from qaloom.runtime import Scratch, require


def clean(df: DataFrame, question: str = "question", answer: str = "answer", keep_null: bool = False, **lists) -> DataFrame:
    """``df`` with the normalised question and its ``reason``; other columns pass through.

    Null questions are dropped; with ``keep_null`` they become the text ``None``, as text
    conversion would make them.
    """
    require(df, question, answer)
    q = F.coalesce(F.col(question).cast("string"), F.lit("None")) if keep_null else F.col(question)
    kept = df if keep_null else df.filter(F.col(question).isNotNull())
    kept = kept.withColumn(question, text.normalize(q))
    return kept.withColumn("reason", text.filter_reason(F.col(question), **lists))


def keep(df: DataFrame) -> DataFrame:
    """The rows whose reason lets them stay, without the reason."""
    return df.filter(F.col("reason") != "blacklist").drop("reason")


def dense_position(df: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """``df`` with ``name`` = 0..n-1 in the order of the columns; rows that tie follow in any order.

    One range shuffle. Each range is sorted and its rows are numbered where they lie; that
    frame is written once, so the sizes of the ranges, which shift the numbers, and the rows
    themselves come from the same ranges. No task sees more than its range.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ranged = Scratch(df.sparkSession, "positions").put(ranged)
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    # One row per range, so never more than there are shuffle partitions.
    out = ranged.withColumn("__part", part).join(F.broadcast(shift), "__part")
    return out.withColumn(name, F.col("__shift") + row).drop("__part", "__at", "__shift")


def renumbered(kept: DataFrame) -> DataFrame:
    """The rows left by the filter with a new dense ``pos``, in the order of the former
    ``pos`` where there is one, then of ``id`` and the texts; ``pos`` serves as a missing ``id``."""
    kept = kept.withColumnRenamed("pos", "__pos")
    order = [x for x in ("__pos", "id", "question", "answer") if x in kept.columns]
    out = dense_position(kept, "pos", *[F.col(x).asc_nulls_last() for x in order]).drop("__pos")
    return out if "id" in out.columns else out.withColumn("id", F.col("pos"))


def with_id(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` with an ``id`` 0..n-1 where it has none."""
    return df if "id" in df.columns else dense_position(df, "id", *order)


def reason_counts(df: DataFrame, top: int = 20) -> DataFrame:
    """``reason, n``: the most frequent reasons."""
    return df.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(top)


def filter_stats(df: DataFrame) -> DataFrame:
    """``input, kept, keep_rate`` in one row."""
    kept = F.count_if(F.col("reason") != "blacklist")
    return df.agg(F.count("*").alias("input"), kept.alias("kept"), (kept / F.greatest(F.lit(1), F.count("*"))).alias("keep_rate"))
