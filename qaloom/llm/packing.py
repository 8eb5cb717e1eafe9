"""Problem 9: filling fixed-capacity containers with items.

Method: variable-capacity best fit. Items go, largest first, into the open container
with the least room that still holds them; where none does, the permitted length that
the items still to come would leave least empty is opened; at the end each container is
downsized to the smallest permitted length that holds its contents. With one permitted
length this is best-fit decreasing.

Items are spread by hash over buckets of about ``BUCKET`` items, each packed in one task:
the work per task is bounded at any corpus size, and a bucket fills thousands of
containers and leaves about one of them partly empty. Those few ill-filled containers of
all buckets are emptied and packed once more, again in bounded buckets.

Edge cases: an item above the largest length, and no other, is split: into full
containers and one remainder that is packed like an item; an item of size 0 takes a place
in a container and no room; null or negative sizes count as 0; null keys are left out; of
a repeated key the largest size is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.runtime import Scratch

BUCKET = 25_000
#: Containers filled less than this are packed again across buckets.
WELL_FILLED = 0.98


def best_fit(sizes: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The container of each item, and the permitted length of each container."""
    lengths = tuple(sorted(lengths))
    most = lengths[-1]
    order = np.argsort(-sizes, kind="stable")
    waiting = np.bincount(sizes, minlength=most + 1)
    room_sets: list[list[int]] = [[] for _ in range(most + 1)]
    rooms = 0  # bit r: a container with r tokens of room is open
    sizes_left = 0  # bit s: an item of size s waits
    for s in np.flatnonzero(waiting):
        sizes_left |= 1 << int(s)
    bins = np.empty(len(sizes), np.int64)
    length_of: list[int] = []
    used: list[int] = []
    for at in order.tolist():
        s = int(sizes[at])
        waiting[s] -= 1
        if not waiting[s]:
            sizes_left &= ~(1 << s)
        fits = rooms >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room_sets[r].pop()
            if not room_sets[r]:
                rooms &= ~(1 << r)
        else:
            b = len(length_of)
            r = _open(s, lengths, waiting, sizes_left) if len(lengths) > 1 else most
            length_of.append(r)
            used.append(0)
        bins[at] = b
        used[b] += s
        r -= s
        room_sets[r].append(b)
        rooms |= 1 << r
    fitted = np.array(lengths)[np.searchsorted(lengths, np.array(used, dtype=np.int64))] if used else np.empty(0, np.int64)
    return bins, fitted


def _open(size: int, lengths: tuple[int, ...], waiting: np.ndarray, sizes_left: int) -> int:
    """The length with the least expected waste per token, were it filled greedily."""
    best, cost = lengths[-1], 2.0
    for c in lengths:
        if c < size:
            continue
        room, taken = c - size, {}
        while room > 0:
            fit = sizes_left & ((1 << (room + 1)) - 2)
            while fit:
                t = fit.bit_length() - 1
                if taken.get(t, 0) < waiting[t]:
                    break
                fit &= ~(1 << t)
            if not fit:
                break
            taken[t] = taken.get(t, 0) + 1
            room -= t
        if room / c <= cost:
            best, cost = c, room / c
    return best


def _packed(items: DataFrame, lengths: tuple[int, ...], salt: int, rows: int) -> DataFrame:
    """``key, part, start, size, bucket, bin, length`` of the items."""
    buckets = max(1, -(-rows // BUCKET))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "key", "part"], ascending=[False, True, True], kind="stable")
        bins, fitted = best_fit(pdf["size"].to_numpy(), lengths)
        return pdf.assign(bin=bins, length=fitted[bins])

    kind = dict(items.dtypes)["key"]
    spread = items.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(buckets)))
    return spread.groupBy("bucket").applyInPandas(run, f"key {kind}, part long, start long, size long, bucket long, bin long, length long")


def pack(df: DataFrame, key: str, size: str, lengths: tuple[int, ...] = (2048,)) -> DataFrame:
    """``key, part, start, size, container, length``: each piece and its container.

    ``part`` and ``start`` are 0 but for split items; ``length`` is the container's
    permitted length after downsizing.
    """
    most = max(lengths)
    scratch = Scratch(df.sparkSession, "packing")
    items = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.greatest(F.max(F.coalesce(F.col(size).cast("long"), F.lit(0))), F.lit(0)).alias("whole"))
    items = scratch.put(items)
    parts = F.greatest(F.ceil(F.col("whole") / most), F.lit(1)).cast("long")
    pieces = items.select("key", "whole", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    pieces = pieces.select("key", "part", (F.col("part") * most).alias("start"), F.least(F.lit(most), F.col("whole") - F.col("part") * most).alias("size"))
    full = pieces.filter(F.col("size") == most).select("key", "part", "start", "size", F.concat_ws("-", F.lit("f"), "key", "part").alias("container"), F.lit(most).cast("long").alias("length"))
    rest = pieces.filter(F.col("size") < most)
    first = scratch.put(_packed(rest, lengths, 1, items.count()))
    fill = first.groupBy("bucket", "bin").agg((F.sum("size") / F.max("length")).alias("fill"))
    weak = fill.filter(F.col("fill") < WELL_FILLED).drop("fill")
    name = lambda x: F.concat_ws("-", F.lit(x), "bucket", "bin").alias("container")
    good = first.join(weak, ["bucket", "bin"], "left_anti").select("key", "part", "start", "size", name("a"), "length")
    again = scratch.put(first.join(weak, ["bucket", "bin"], "left_semi").select("key", "part", "start", "size"))
    second = _packed(again, lengths, 2, again.count()).select("key", "part", "start", "size", name("b"), "length")
    return full.unionByName(good).unionByName(second).withColumnRenamed("key", key)
