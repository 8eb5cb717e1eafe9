"""Problem 6: the best representative of each duplicate group.

Two ways to the surviving values, over the same candidates:

* ``fuse`` is the method named for the problem: Bayesian fusion with copy detection.
  Source accuracies and value posteriors are estimated in turns; sources that share
  values believed false are held to copy, and a copied vote is discounted where its
  original votes for the same value; the value of maximum posterior survives.
* ``survivors`` is the rule the project's tables state (trust, then recency, then key).
  It is no special case of ``fuse``: a vote of several weak sources may never outweigh a
  more trusted one there, which no finite weighting gives.

Edge cases: null or empty member lists and members without a row give no candidate;
repeated members, clusters and rows count once; missing values (null, blank, stand-ins,
stand-in dates) are no candidates; unknown trust and missing edit times rank last; a field
without any candidate gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.operators.filters import dense_position
from qaloom.runtime import Scratch

# Texts that stand in for a missing value, without case, blanks and punctuation.
STAND_INS = ["null", "none", "nan", "na", "nil", "nul", "undefined", "unknown", "tbd", "todo", "missing", "empty", "未知", "未填", "未填写", "待补充", "待定", "待填", "暂无", "无", "空", "不详"]
# Dates that stand in for a missing date.
STAND_IN_DATES = ["0001-01-01", "1900-01-01", "1970-01-01", "2099-12-31", "2999-12-31", "9999-12-31"]
#: Sources are compared in blocks of so many, one matrix of a pair of blocks at a time.
SOURCE_BLOCK = 2048
ALTERNATIVES, COPY_RATE, PRIOR_COPY = 10, 0.8, 0.05
#: Accuracy that a source of unknown trust starts with.
UNKNOWN = 0.8

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))


def bare(c: Column) -> Column:
    """A text without markup, blanks, invisible characters, punctuation and case."""
    c = F.translate(c, _WIDE, _HALF)
    c = F.regexp_replace(c, r"<[^<>]*>|&[A-Za-z#0-9]+;", "")
    return F.lower(F.regexp_replace(c, r"[\p{Z}\p{C}\p{P}\p{S}\s]+", ""))


def has_value(c: Column, kind: str) -> Column:
    """Whether a cell holds a real value."""
    if kind in ("date", "timestamp"):
        return c.isNotNull() & ~c.cast("date").cast("string").isin(STAND_IN_DATES)
    text = bare(c.cast("string"))
    return c.isNotNull() & (text != "") & ~text.isin(STAND_INS)


def candidates(clusters: DataFrame, rows: DataFrame, sources: DataFrame, cluster: str, members: str, key: str, fields: list[str], source: str, trust: str, edited: str, values: bool) -> DataFrame:
    """One row per cluster and member: flags (or value digests) of each field, source, trust, time."""
    kinds = dict(rows.dtypes)
    held = [F.when(has_value(F.col(f), kinds[f]), F.xxhash64(bare(F.col(f).cast("string"))) if values else F.lit(True)).alias(f"has_{f}") for f in fields]
    # The kept columns are narrow: texts are judged before the shuffle and stay behind.
    facts = rows.select(F.col(key).alias("pos"), F.col(source).alias("source"), F.col(edited).alias("edited"), *held).dropDuplicates(["pos"])
    known = sources.filter(F.col(source).isNotNull()).groupBy(F.col(source).alias("source")).agg(F.max(trust).alias("trust"))
    wanted = clusters.filter(F.col(cluster).isNotNull()).select(F.col(cluster).alias("cluster"), F.explode(members).alias("pos")).distinct()
    return wanted.join(facts, "pos").join(known, "source", "left")


def survivors(clusters: DataFrame, rows: DataFrame, sources: DataFrame, cluster: str, members: str, key: str, fields: list[str], source: str, trust: str, edited: str) -> DataFrame:
    """``<cluster>, field_name, <key>``: the member whose value of the field survives."""
    c = candidates(clusters, rows, sources, cluster, members, key, fields, source, trust, edited, values=False)
    order = F.struct(
        F.coalesce(F.col("trust").cast("double"), F.lit(float("-inf"))).alias("trust"),
        F.col("edited").isNotNull().alias("dated"),
        F.coalesce(F.col("edited").cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("edited"),
        (-F.col("pos")).alias("pos"),
    )
    best = c.groupBy("cluster").agg(*[F.max(F.when(F.col(f"has_{f}"), order)).alias(f) for f in fields])
    long = best.select("cluster", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), (-F.col(f"{f}.pos")).alias("pos")) for f in fields])).alias("x")).select("cluster", "x.*")
    return long.filter(F.col("pos").isNotNull()).select(F.col("cluster").alias(cluster), "field_name", F.col("pos").alias(key))


def _together(votes: DataFrame, item: list[str], weight: str, block: int = SOURCE_BLOCK) -> DataFrame:
    """``a, b, w``: how much each two sources share, over the rows grouped by ``item``.

    Each task multiplies the sparse incidence of its items with itself, block of sources by
    block of sources, into one ``block x block`` matrix at a time; what leaves a task is
    bounded by the pairs of sources, however many rows share an item.
    """
    sets = votes.groupBy(*item).agg(F.sort_array(F.collect_set("sid")).alias("sids"), F.first(weight).alias("w")).filter(F.size("sids") > 1)
    blocks = F.array_sort(F.array_distinct(F.transform("sids", lambda s: F.floor(s / block))))
    sets = sets.select("sids", F.col("w").cast("double").alias("w"), blocks.alias("blocks")).select("sids", "w", "blocks", F.explode("blocks").alias("p"))
    sets = sets.select("sids", "w", "p", F.explode("blocks").alias("q")).filter("p <= q").sortWithinPartitions("p", "q")

    def pairs(p, q, total):
        a, b = np.nonzero(np.triu(total, 1) if p == q else total)
        return pd.DataFrame({"a": a + p * block, "b": b + q * block, "w": total[a, b]})

    def multiply(batches):
        at, total = None, None
        for pdf in batches:
            for sids, w, p, q in zip(pdf["sids"], pdf["w"], pdf["p"], pdf["q"], strict=True):
                if at != (p, q):
                    if at is not None:
                        yield pairs(*at, total)
                    at, total = (p, q), np.zeros((block, block))
                ids = np.asarray(sids)
                total[np.ix_(ids[ids // block == p] - p * block, ids[ids // block == q] - q * block)] += w
        if at is not None:
            yield pairs(*at, total)

    return sets.mapInPandas(multiply, "a long, b long, w double").groupBy("a", "b").agg(F.sum("w").alias("w"))


def _origins(believed: DataFrame, acc: DataFrame, block: int) -> DataFrame:
    """``sid, from, p, kf``: the sources held to copy, each with its likeliest original.

    Shared values that are believed false speak most for copying, shared true ones little,
    different values on the same item against it.
    """
    same = believed.withColumn("false", (F.col("posterior") < 0.5).cast("double")).withColumn("one", F.lit(1.0))
    false = _together(same, ["cluster", "field", "value"], "false", block).withColumnRenamed("w", "kf")
    agree = _together(same, ["cluster", "field", "value"], "one", block).withColumnRenamed("w", "ks")
    meet = _together(same, ["cluster", "field"], "one", block).withColumnRenamed("w", "km")
    a, b = (acc.select(F.col("sid").alias(x), F.col("acc").alias(f"acc_{x}")) for x in "ab")
    pair = agree.join(false, ["a", "b"], "left").join(meet, ["a", "b"]).join(a, "a").join(b, "b").withColumn("kf", F.coalesce("kf", F.lit(0.0)))
    pf = (1 - F.col("acc_a")) * (1 - F.col("acc_b")) / ALTERNATIVES
    pt = F.col("acc_a") * F.col("acc_b")
    gain = lambda p: F.log((COPY_RATE + (1 - COPY_RATE) * p) / p)
    log_odds = F.log(F.lit(PRIOR_COPY / (1 - PRIOR_COPY))) + F.col("kf") * gain(pf) + (F.col("ks") - F.col("kf")) * gain(pt) + (F.col("km") - F.col("ks")) * F.log(F.lit(1 - COPY_RATE))
    pair = pair.withColumn("p", 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), log_odds))))).filter("p > 0.5")
    # The less accurate of two dependent sources is the copy; each copy keeps its likeliest original.
    copier = F.when((F.col("acc_a") < F.col("acc_b")) | ((F.col("acc_a") == F.col("acc_b")) & (F.col("a") > F.col("b"))), F.col("a")).otherwise(F.col("b"))
    pair = pair.select(copier.alias("sid"), F.when(copier == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("from"), "p", "kf")
    best = F.struct("p", -F.col("from"))
    return pair.groupBy("sid").agg(F.max_by("from", best).alias("from"), F.max("p").alias("p"), F.max_by("kf", best).alias("kf"))


def fuse(clusters: DataFrame, rows: DataFrame, sources: DataFrame, cluster: str, members: str, key: str, fields: list[str], source: str, trust: str, edited: str, turns: int = 3, block: int = SOURCE_BLOCK) -> DataFrame:
    """``<cluster>, field_name, <key>, posterior``: the value of maximum posterior.

    ``<key>`` is the smallest member that holds the winning value. Votes of one source
    for one value count once. Any number of sources is held, ``block`` at a time.
    """
    scratch = Scratch(clusters.sparkSession, "fusion")
    c = candidates(clusters, rows, sources, cluster, members, key, fields, source, trust, edited, values=True)
    long = c.select("cluster", "pos", "source", "trust", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"has_{f}").alias("value")) for f in fields])).alias("x"))
    votes = long.select("cluster", "x.*", "pos", F.coalesce("source", F.lit("")).alias("source"), "trust").filter(F.col("value").isNotNull())
    votes = scratch.put(votes.groupBy("cluster", "field", "value", "source").agg(F.min("pos").alias("pos"), F.max("trust").alias("trust")))
    prior = F.least(F.lit(0.95), F.coalesce(0.45 + 0.09 * F.col("trust"), F.lit(UNKNOWN)))
    known = votes.groupBy("source").agg(F.max(prior).alias("acc"))
    ids = scratch.put(dense_position(known.select("source"), "sid", "source"))
    acc = known.join(ids, "source").select("sid", "acc")
    votes = scratch.put(votes.join(ids, "source").drop("source", "trust"))
    # Copies are looked for before the first vote too, lest a clique of them be believed.
    origin = scratch.put(_origins(votes.withColumn("posterior", F.lit(1.0)), acc, block).select("sid", "from", "p"))
    for turn in range(turns):
        w = votes.join(acc, "sid").withColumn("vote", F.log(ALTERNATIVES * F.col("acc") / (1 - F.col("acc"))))
        w = w.join(origin, "sid", "left")
        backed = votes.select("cluster", "field", "value", F.col("sid").alias("from"), F.lit(True).alias("backed"))
        w = w.join(backed, ["cluster", "field", "value", "from"], "left")
        w = w.withColumn("vote", F.when(F.col("backed"), F.col("vote") * (1 - COPY_RATE * F.col("p"))).otherwise(F.col("vote")))
        values = w.groupBy("cluster", "field", "value").agg(F.sum("vote").alias("score"), F.min("pos").alias("pos"))
        peak = values.groupBy("cluster", "field").agg(F.max("score").alias("peak"))
        values = values.join(peak, ["cluster", "field"]).withColumn("e", F.exp(F.col("score") - F.col("peak")))
        mass = values.groupBy("cluster", "field").agg((F.sum("e") + F.greatest(F.lit(0), F.lit(ALTERNATIVES + 1) - F.count("*")) * F.exp(-F.max("peak"))).alias("mass"))
        values = scratch.put(values.join(mass, ["cluster", "field"]).select("cluster", "field", "value", "pos", (F.col("e") / F.col("mass")).alias("posterior")))
        if turn == turns - 1:
            break
        believed = scratch.put(votes.join(values.drop("pos"), ["cluster", "field", "value"]))
        acc = scratch.put(believed.groupBy("sid").agg(F.least(F.lit(0.99), F.greatest(F.lit(0.05), F.avg("posterior"))).alias("acc")))
        origin = scratch.put(_origins(believed, acc, block).filter("kf > 0").select("sid", "from", "p"))
    top = values.groupBy("cluster", "field").agg(F.max(F.struct("posterior", (-F.col("pos")).alias("pos"))).alias("t"))
    return top.select(F.col("cluster").alias(cluster), F.col("field").alias("field_name"), (-F.col("t.pos")).alias(key), F.round("t.posterior", 9).alias("posterior"))
