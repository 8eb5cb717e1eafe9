"""Problem 8: encoding of the whole corpus with a public tokenizer (byte-level BPE).

Method: two-tier lookup. A minimal perfect hash resolves whole pre-tokens that are in the
vocabulary; the others are merged with a heap over linked bytes.

The vocabulary file is read once on the driver (its path is a parameter) and broadcast;
its size is the vocabulary's, about 1 MB, whatever the corpus. Rows are encoded where
they lie: no shuffle. Each distinct pre-token of a batch is looked up once, and a bounded
memo carries results from batch to batch of a task.

Edge cases: null and empty texts give an empty list; special tokens in a text are
ordinary text; a text or pre-token of any length is encoded whole (``n log n``).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public tokenizers lie; override with the Spark setting of this name.
PATH_SETTING = "spark.qaloom.tokenizers"
DEFAULT_PATH = "/opt/tokenizers"
#: The pre-token pattern published with the byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO, MEMO_BYTES = 1 << 17, 96


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """Minimal perfect hash of the vocabulary: hash, displace, verify.

    Keys fall into as many buckets as there are keys; crowded buckets search a
    displacement that sends all their keys to free slots, single keys take what is left.
    """

    def __init__(self, ids: dict[bytes, int]):
        self.n = n = max(1, len(ids))
        keys = list(ids)
        h = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        bucket = (h % np.uint64(n)).astype(np.int64)
        self.shift = np.zeros(n, np.int64)
        slot_of = np.empty(len(keys), np.int64)
        free = np.ones(n, bool)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(n + 1))
        sizes = np.diff(edges)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own = order[edges[b] : edges[b + 1]]
            d = 0
            while True:
                s = self._displaced(h[own], np.int64(d))
                if free[s].all() and len(set(s.tolist())) == len(s):
                    break
                d += 1
            free[s] = False
            slot_of[own] = s
            self.shift[b] = d
        left = iter(np.flatnonzero(free))
        for b in np.flatnonzero(sizes == 1):
            s = next(left)
            slot_of[order[edges[b]]] = s
            self.shift[b] = -s - 1
        self.keys: list[bytes] = [b""] * n
        self.ids = np.full(n, -1, np.int32)
        for k, s in zip(keys, slot_of.tolist(), strict=True):
            self.keys[s] = k
            self.ids[s] = ids[k]

    def _displaced(self, h: np.ndarray, d) -> np.ndarray:
        step = (h >> np.uint64(40)) | np.uint64(1)
        with np.errstate(over="ignore"):
            return (((h >> np.uint64(17)) + np.asarray(d).astype(np.uint64) * step) % np.uint64(self.n)).astype(np.int64)

    def lookup(self, pieces: list[bytes]) -> np.ndarray:
        """The id of each piece, -1 where it is no token."""
        if not pieces:
            return np.empty(0, np.int32)
        h = np.fromiter(map(xxhash.xxh64_intdigest, pieces), np.uint64, len(pieces))
        d = self.shift[(h % np.uint64(self.n)).astype(np.int64)]
        slot = np.where(d < 0, -d - 1, self._displaced(h, np.maximum(d, 0)))
        same = np.fromiter((self.keys[s] == p for s, p in zip(slot.tolist(), pieces, strict=True)), bool, len(pieces))
        return np.where(same, self.ids[slot], -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges in order of rank, leftmost first, by a heap over linked spans."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the span that starts at i ends; 0 once merged away
    before = list(range(-1, n))
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if end[i] != j or end[j] != e:
            continue
        end[i], end[j] = e, 0
        if e < n:
            before[e] = i
            r = ranks.get(piece[i : end[e]])
            if r is not None:
                heapq.heappush(heap, (r, i, e, end[e]))
        k = before[i]
        if k >= 0:
            r = ranks.get(piece[k:e])
            if r is not None:
                heapq.heappush(heap, (r, k, i, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes texts by a vocabulary; one per task."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash):
        self.ranks, self.table = ranks, table
        self.split = regex.compile(PATTERN).findall
        self.memo: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as packed 32-bit integers."""
        parts = [self.split(t) if t else [] for t in texts]
        memo = self.memo
        if len(memo) > MEMO:
            memo = self.memo = {}
        new = list({p for ps in parts for p in ps if p not in memo})
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        for p, b, i in zip(new, raw, self.table.lookup(raw).tolist(), strict=True):
            memo[p] = np.int32(i).tobytes() if i >= 0 else np.array(merge(b, self.ranks), np.int32).tobytes()
        out = [b"".join([memo[p] for p in ps]) for ps in parts]
        for p, b in zip(new, raw, strict=True):
            if len(b) > MEMO_BYTES:
                del memo[p]
        return out


def tokenizer_file(df: DataFrame, name: str) -> str:
    return f"{df.sparkSession.conf.get(PATH_SETTING, DEFAULT_PATH)}/{name}.tiktoken"


def _encoded(df: DataFrame, key: str, text: str, path: str, finish, schema: str) -> DataFrame:
    ranks = read_ranks(path)
    shared = df.sparkSession.sparkContext.broadcast((ranks, PerfectHash(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for b in batches:
            for a in range(0, b.num_rows, 2048):
                part = b.slice(a, 2048)
                yield pa.RecordBatch.from_arrays([part["key"], finish(encoder.encode(part["text"].to_pylist()))], [key, schema.split()[0]])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, {schema}")


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def encode(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key, ids``: the token ids of every row's text, without special tokens."""
    return _encoded(df, key, text, path, _lists, "ids array<int>")


def count_tokens(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``key, tokens``: the number of token ids of every row's text."""
    return _encoded(df, key, text, path, lambda xs: pa.array([len(x) // 4 for x in xs], pa.int64()), "tokens bigint")
