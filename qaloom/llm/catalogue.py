"""The queries of the ten problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.llm import copies, defects, leximin, linkage, looks, neighbours, packing, residue, survivor, tokens
from qaloom.llm.sql import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return looks.seen_alike(table(spark, folder, "stage1_clean"), "pos", "question", "answer")


@query
def p1_forms(spark: SparkSession, folder: str) -> DataFrame:
    return looks.normalise_columns(table(spark, folder, "stage1_clean").select("pos", "question", "answer"), "question", "answer")


@query
def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Each row that looks like differently spelt ones, with its class and how many those are."""
    return looks.alike(table(spark, folder, "stage1_clean"), "pos", "question", "answer")


@query
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return copies.copy_links(table(spark, folder, "stage1_clean"), "pos", "question")


@query
def p2_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return copies.collapse(table(spark, folder, "stage1_clean").select("pos", "question"), "pos", "question")


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbours.similar(table(spark, folder, "emb_a"), "pos", "emb_a", table(spark, folder, "emb_probes"), k=10)
    return neighbours.linked(found, "pos")


@query
def p3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Queries are the rows whose ``pos`` is divisible by 20, against all rows."""
    return neighbours.similar(table(spark, folder, "emb_a"), "pos", "emb_a", F.col("key") % 20 == 0, k=10)


SCORES = ["ce_main", "ce_aux1", "ce_aux2"]


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return leximin.first(table(spark, folder, "stage3_ranked_pairs"), "i", "j", SCORES, at_least=8)


@query
def p4_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return leximin.ranking(table(spark, folder, "stage3_ranked_pairs"), "i", "j", SCORES)


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "stage3_ranked_pairs").filter((F.col("ce_final") >= 0.83) & ~F.isnan("ce_final"))
    return linkage.groups(links, "i", "j").select(F.col("group").alias("group_pos"), F.col("node").alias("pos"))


FIELDS = ["answer", "category", "valid_from"]
MEMBERS = {"cluster": "cluster_id", "members": "members", "key": "pos", "fields": FIELDS, "source": "kb", "trust": "trust", "edited": "updated_at"}


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    t = [table(spark, folder, x) for x in ("final_clusters", "stage1_clean", "kb_sources")]
    return survivor.survivors(*t, **MEMBERS)


@query
def p6_fused(spark: SparkSession, folder: str) -> DataFrame:
    t = [table(spark, folder, x) for x in ("final_clusters", "stage1_clean", "kb_sources")]
    return survivor.fuse(*t, **MEMBERS)


@query
def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return tokens.encode(d, "doc_id", "text", tokens.tokenizer_file(d, "byte_bpe_50k"))


@query
def p9_packed(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    sizes = tokens.count_tokens(d, "doc_id", "text", tokens.tokenizer_file(d, "byte_bpe_50k"))
    return packing.pack(sizes, "doc_id", "tokens", (2048,))


@query
def p9_packed_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Several permitted lengths, packed jointly and downsized."""
    d = table(spark, folder, "documents")
    sizes = tokens.count_tokens(d, "doc_id", "text", tokens.tokenizer_file(d, "byte_bpe_50k"))
    return packing.pack(sizes, "doc_id", "tokens", (256, 512, 1024, 2048))


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return defects.defects(table(spark, folder, "stage1_clean"), "pos", "question", "answer")


@query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue_rows(table(spark, folder, "documents"), "doc_id", "text", "title", "source")


@query
def p10_kept(spark: SparkSession, folder: str) -> DataFrame:
    return residue.without_residue(table(spark, folder, "documents"), "doc_id", "text", "title", "source").select("doc_id", "text")
