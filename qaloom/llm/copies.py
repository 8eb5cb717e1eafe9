"""Problem 2: duplicates hidden by formatting differences.

Method: Merkle-style bottom-up hashing. A text is read as a nested record (labelled
fields or JSON), leaves are normalised, the digests of an unordered node's children are
sorted, the root digests are grouped, and each group is confirmed by comparing the whole
canonical structure.

Edge cases: null text and text without any letter or digit belong to no group; a plain
sentence is a record with one leaf; broken JSON falls back to labelled fields, then to a
plain leaf; records nested to any depth are folded without recursion; repeated keys are all
kept; labels and texts of any length are read and hashed whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.looks import Table, form_of, lookalikes, per_distinct, reading
from qaloom.runtime import Scratch, join_sized

_DROPPED = Table(lambda ch: "" if unicodedata.category(ch)[0] in "PSZC" else ch)
_FIELDS = regex.compile(r"[:={\[]")
_SPLIT = regex.compile(r"\s*[;|/\n]\s*|\s*,\s*(?=[^:=,;|/\n]+[:=])")
_FIELD = regex.compile(r"\s*([^:=]+)[:=]\s*(.*)", regex.S)
_QUOTED = regex.compile(r'"([^"]+)"\s*:\s*(?:"([^"]*)"|([^",{}\[\]]+))')
_JSON = regex.compile(r'\s*(?:([{}\[\],:])|("(?:[^"\\]|\\.)*+")|([^\s{}\[\],:"]+))', regex.S)


def leaf(text: str, form: Callable[[str], str] = form_of) -> str:
    """A text without blanks, case, punctuation and width; ``form`` gives the consistent form."""
    return form(text).translate(_DROPPED)


def fold(text: str) -> tuple[bytes, str] | None:
    """(digest, canonical) of a JSON object or array, children first, on a stack of its
    own; None where it is broken."""
    open_: list[list] = []  # of each open node: its kind, finished children, label, what may follow
    at, end = 0, len(text.rstrip())
    done = None
    while at < end:
        m = _JSON.match(text, at)
        if m is None or done is not None:
            return None
        at = m.end()
        mark, quoted, bare = m.groups()
        if mark in ("{", "["):
            if open_ and open_[-1][3] != "value":
                return None
            open_.append([mark, [], None, "label" if mark == "{" else "value"])
            continue
        if not open_:
            return None
        top = open_[-1]
        if mark in ("}", "]"):
            if (top[0] == "{") != (mark == "}") or top[3] not in (("next",) if top[1] else ("label", "value")) or top[2] is not None:
                return None
            open_.pop()
            node = unordered(top[1]) if mark == "}" else ordered(top[1])
        elif mark == ",":
            if top[3] != "next":
                return None
            top[3] = "label" if top[0] == "{" else "value"
            continue
        elif mark == ":":
            if top[3] != "colon":
                return None
            top[3] = "value"
            continue
        else:
            try:
                word = json.loads(quoted, strict=False) if quoted else bare
            except ValueError:
                return None
            if top[3] == "label" and quoted:
                top[2], top[3] = leaf(word), "colon"
                continue
            if top[3] != "value" or not quoted and not _LITERAL.fullmatch(word):
                return None
            node = single(leaf("" if word == "null" and bare else word))
        if open_:
            top = open_[-1]
            top[1].append((top[2], node) if top[0] == "{" else node)
            top[2], top[3] = None, "next"
        else:
            done = node
    return done


_LITERAL = regex.compile(r"true|false|null|nan|-?infinity|-?\d+(?:\.\d+)?(?:e[+-]?\d+)?", regex.I)


def parse(text: str) -> list[tuple[str, str]] | None:
    """The labelled fields of a text, (label, value) in no order; None for a plain sentence."""
    if text[:1] in "{[":
        found = [(a, b or c) for a, b, c in _QUOTED.findall(text)]
        if len(found) > 1:
            return found
    fields: list[list[str]] = []
    for piece in _SPLIT.split(text.strip()):
        m = _FIELD.fullmatch(piece)
        if m and leaf(m[1]):
            fields.append([m[1], m[2]])
        elif fields:
            fields[-1][1] += piece
        elif leaf(piece):
            return None
    return list(map(tuple, fields)) if len(fields) > 1 else None


def unify_breaks(text: str, form: Callable[[str], str] = form_of) -> str:
    """The consistent form line by line, so that line breaks still part the fields."""
    return "\n".join(map(form, text.splitlines())) if "\n" in text or "\r" in text else form(text)


# A node is (digest, canonical): the Merkle digest of 16 bytes and the whole structure as one string.


def single(value: str) -> tuple[bytes, str]:
    return _hash(b"l" + value.encode()), value


def unordered(fields: list[tuple[str, tuple[bytes, str]]]) -> tuple[bytes, str]:
    """A node whose children have labels and no order: their digests are sorted."""
    own = b"".join(sorted(_hash(b"f" + label.encode() + b"\0" + node[0]) for label, node in fields))
    return _hash(b"u" + own), "{" + ",".join(sorted(f"{label}:{node[1]}" for label, node in fields)) + "}"


def ordered(nodes: list[tuple[bytes, str]]) -> tuple[bytes, str]:
    return _hash(b"o" + b"".join(n[0] for n in nodes)), "[" + ",".join(n[1] for n in nodes) + "]"


def _hash(x: bytes) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def signed(text: str | None, form: Callable[[str], str] = form_of) -> tuple[bytes | None, str | None]:
    """(digest, canonical) of a text, or (None, None) when nothing of it counts."""
    plain = None if text is None else leaf(text, form)
    if not plain:
        return None, None
    if not _FIELDS.search(form(text)):
        return single(plain)
    # The parts of a text in its consistent form only lose blanks and punctuation.
    seen = unify_breaks(text, form).strip()
    node = fold(seen) if seen[:1] in ("{", "[") else None
    if node is not None:
        return node
    fields = parse(seen)
    return unordered([(leaf(k), single(leaf(v))) for k, v in fields]) if fields else single(plain)


def merkle(spark: SparkSession):
    """The column function that gives ``digest`` and ``canon`` of a text."""
    table = lookalikes(spark)

    @F.pandas_udf(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("canon", T.StringType())]))
    def run(values: pd.Series) -> pd.DataFrame:
        form = reading(table).form_of
        return pd.DataFrame(per_distinct(values, lambda x: signed(x, form)), columns=["digest", "canon"])

    return run


def copy_links(df: DataFrame, key: str, text: str) -> DataFrame:
    """``keep_<key>, copy_<key>``: each row but the first of its group, with the first.

    Root digests are counted first, on the map side, so a group of a third of all rows
    shrinks before the shuffle. Only rows of digests that repeat travel with their
    structure, which is compared in full; once it agrees, digests alone name the groups.
    """
    scratch = Scratch(df.sparkSession, "copies")
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), merkle(df.sparkSession)(F.col(text).cast("string")).alias("m"))
    rows = scratch.put(rows.select("key", "m.*").filter(F.col("digest").isNotNull()))
    found = rows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    dup = rows.join(found, "digest", "left_semi")
    groups = dup.groupBy("digest", "canon").agg(F.min("key").alias("keep"), F.count("*").alias("size"))
    # A digest has one structure unless two different ones collide.
    groups = scratch.put(groups.groupBy("digest").agg(F.count("*").alias("kinds"), F.min("keep").alias("keep"), F.sum("size").alias("size")))
    hit = join_sized(rows.select("key", "digest"), groups.filter("kinds = 1").drop("kinds"), ["digest"], "size", rows.count())
    apart = groups.filter("kinds > 1").select("digest")
    if not apart.isEmpty():
        same = rows.join(apart, "digest", "left_semi")
        heads = same.groupBy("digest", "canon").agg(F.min("key").alias("keep"))
        hit = hit.unionByName(same.join(heads, ["digest", "canon"]).select("key", "digest", "keep"))
    return hit.filter("key <> keep").select(F.col("keep").alias(f"keep_{key}"), F.col("key").alias(f"copy_{key}")).distinct()


def collapse(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per record: ``df``'s row with the smallest key, plus ``copies``.

    Rows without a usable text stand for themselves (``copies`` 1). The count column is
    named ``copies``, or ``copies_`` and so on where ``df`` has that name already.
    """
    links = copy_links(df, key, text).withColumnRenamed(f"keep_{key}", "__keep").withColumnRenamed(f"copy_{key}", "__copy")
    name = "copies"
    while name in df.columns:
        name += "_"
    counts = links.groupBy("__keep").agg((F.count("*") + 1).alias("__n"))
    kept = df.join(links.select("__copy"), df[key] == F.col("__copy"), "left_anti").dropDuplicates([key])
    return kept.join(counts, kept[key] == F.col("__keep"), "left").select(*[kept[c] for c in df.columns], F.coalesce("__n", F.lit(1)).alias(name))
