"""Problem 3: the most similar vectors for every vector.

Method: permutation index. Pivots are drawn by a fixed hash of the key (a bounded
sample); every vector is represented by its ordered nearest pivots, posted in pivot
inverted files, candidates are ranked by footrule distance and the best are reranked by
exact cosine.

The inverted files are partitioned by row block (a shard of at most ``SHARD`` rows per
task at a time), as search engines do: postings and vectors never shuffle, only the
``k`` best of each query and partition do. Queries travel to the shards in blocks of at
most ``QUERY_BLOCK`` vectors, one block at a time: its result is written before the next
block is read, so neither what is sent out nor what the driver holds grows with the data.

Edge cases: null vectors, vectors with null, NaN or infinite entries, all-zero ones and
those of another length than most of the sample are no queries and nobody's neighbours;
length does not matter; a query is not its own neighbour; equal cosines go to the smaller
key; an empty table gives an empty result; fewer than ``k`` others give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.runtime import Scratch

SHARD = 32_768
QUERY_BLOCK = 16_384


def matrix(keys: pa.Array, vectors: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The usable rows: keys and unit vectors in double precision, so that near ties stay apart."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if isinstance(keys, pa.ChunkedArray):
        keys = keys.combine_chunks()
    size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if dim is None:
        size_of = size[size > 0]
        dim = int(np.bincount(size_of).argmax()) if len(size_of) else 0
    take = (size == dim) & (dim > 0) & ~np.asarray(keys.is_null())
    if not take.any():
        return np.empty(0, np.int64), np.empty((0, dim or 1))
    mask = pa.array(take)
    flat = vectors.filter(mask).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    wide = flat.astype(np.float64)
    norm = np.sqrt((wide * wide).sum(1))
    good = np.isfinite(norm) & (norm > 0)
    key = keys.filter(mask).to_numpy(zero_copy_only=False)[good]
    return key, wide[good] / norm[good][:, None]


def permutations(v: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """The ``posted`` nearest pivots of each vector, nearest first."""
    out = np.empty((len(v), posted), np.int32)
    for a in range(0, len(v), 4096):
        near = v[a : a + 4096].astype(np.float32) @ pivots.T
        top = np.argpartition(-near, posted - 1, axis=1)[:, :posted] if posted < len(pivots) else np.broadcast_to(np.arange(posted), (len(near), posted))
        order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
        out[a : a + 4096] = np.take_along_axis(top, order, 1)
    return out


def search(key, v, perm, qkey, qv, qperm, n_pivots: int, k: int, rerank: int):
    """(query row, key, cosine) of the best ``k`` of this shard for each query."""
    posted = perm.shape[1]
    flat = perm.ravel()
    order = np.argsort(flat, kind="stable")
    start = np.searchsorted(flat[order], np.arange(n_pivots + 1))
    ids, rank = (order // posted).astype(np.int32), (order % posted).astype(np.int32)
    found = []
    for q in range(len(qkey)):
        spans = [(start[p], start[p + 1]) for p in qperm[q]]
        row = np.concatenate([ids[a:b] for a, b in spans])
        if not len(row):
            continue
        # Footrule distance to the query's permutation, as credit over absence.
        credit = np.concatenate([posted - np.abs(rank[a:b] - r) for r, (a, b) in enumerate(spans)])
        total = np.bincount(row, credit)
        at = np.flatnonzero(total)
        if len(at) > rerank:
            least = np.partition(total[at], len(at) - rerank)[len(at) - rerank]
            at = at[total[at] >= least]
        at = at[key[at] != qkey[q]]
        cos = np.round(v[at] @ qv[q], 9)
        best = np.lexsort((key[at], -cos))[:k]
        found.append((np.full(len(best), q), key[at][best], cos[best]))
    if not found:
        return np.empty(0, int), np.empty(0, np.int64), np.empty(0)
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= SHARD:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def similar(df: DataFrame, key: str, vector: str, queries: DataFrame | Column, k: int = 10, pivots: int = 1024, posted: int = 32, rerank: int = 2048) -> DataFrame:
    """``query, neighbour, cosine, place``: the ``k`` most similar rows of each query.

    ``queries`` is a frame with the column ``key``, or a condition on ``df``. The index
    covers every row; only the pivots are a sample of at most ``pivots`` rows. ``rerank``
    candidates per shard (ties kept) get their exact cosine. Measured recall: README.
    """
    spark = df.sparkSession
    base = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>").alias("vec"))
    asked = base.filter(F.col("key").isNotNull() & F.col("vec").isNotNull())
    asked = base.filter(queries) if isinstance(queries, Column) else asked.join(queries.select(F.col(key).cast("long").alias("key")).distinct(), "key", "left_semi")
    empty = spark.createDataFrame([], "query long, neighbour long, cosine double, place int")
    sample = base.filter(F.col("vec").isNotNull()).orderBy(F.xxhash64("key"), "key").limit(2 * pivots).toArrow()
    _, piv = matrix(sample["key"], sample["vec"], None)
    piv = piv[:pivots].astype(np.float32)
    if not len(piv):
        return empty
    dim, n_piv = piv.shape[1], len(piv)
    m = min(posted, n_piv)

    def index(batches):
        for b in batches:
            ks, v = matrix(b["key"], b["vec"], dim)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), dim).cast(pa.list_(pa.float64()))
            perm = pa.FixedSizeListArray.from_arrays(pa.array(permutations(v, piv, m).ravel()), m).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), lists, perm], ["key", "vec", "perm"])

    n_asked = asked.count()
    blocks = max(1, -(-n_asked // QUERY_BLOCK))
    indexed = base
    if blocks > 1:
        indexed = Scratch(spark, "permutations").put(base.mapInArrow(index, "key long, vec array<double>, perm array<int>"))

    def searcher(qkey, qv, qperm):
        def run(batches):
            parts = []
            for t in _shards(batches):
                ks, v = matrix(t["key"], t["vec"], dim)
                if not len(ks):
                    continue
                if "perm" in t.column_names:
                    perm = t["perm"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, m)
                else:
                    perm = permutations(v, piv, m)
                parts.append(search(ks, v, perm, qkey, qv, qperm, n_piv, k, rerank))
                if len(parts) > 1:  # keep the best k of each query over the shards so far
                    q, n, c = map(np.concatenate, zip(*parts, strict=True))
                    o = np.lexsort((n, -c, q))
                    place = np.arange(len(o)) - np.searchsorted(q[o], q[o])
                    o = o[place < k]
                    parts = [(q[o], n[o], c[o])]
            if parts:
                q, n, c = parts[0]
                yield pa.RecordBatch.from_arrays([pa.array(qkey[q], pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.float64())], ["query", "neighbour", "cosine"])

        return run

    scratch = Scratch(spark, "neighbours")
    out = empty.drop("place")
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b) if blocks > 1 else asked
        got = block.toArrow()
        qkey, qv = matrix(got["key"], got["vec"], dim)
        if len(qkey):
            part = indexed.mapInArrow(searcher(qkey, qv, permutations(qv, piv, m)), "query long, neighbour long, cosine double")
            out = part if blocks == 1 else out.unionByName(scratch.put(part))
    best = Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour")
    return out.distinct().withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def linked(found: DataFrame, key: str) -> DataFrame:
    """``<key>_a, <key>_b``, the smaller key first, each pair once."""
    return found.select(F.least("query", "neighbour").alias(f"{key}_a"), F.greatest("query", "neighbour").alias(f"{key}_b")).distinct()
