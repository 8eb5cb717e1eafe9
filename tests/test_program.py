"""Sources, settings, the whole pipeline, the stream, and the query catalogue with its SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from qaloom import config, runtime
from qaloom.plans import catalogue
from qaloom.plans.pipeline import STAGES, Pipeline
from qaloom.runtime import join_sized
from qaloom.sources import files
from qaloom.streaming import filtering

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("encoding,sep", [("utf-8", ","), ("gbk", "\t"), ("utf-8", ";")])
def test_csv_sniffing(spark, tmp_path, encoding, sep):
    p = tmp_path / "t.csv"
    p.write_bytes(f"question{sep}answer\n如何开票{sep}申请即可\n退款{sep}三天\n".encode(encoding))
    assert [tuple(r) for r in files.read_table(spark, str(p)).collect()] == [("如何开票", "申请即可"), ("退款", "三天")]


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b\"c"), (2, None)], "id long, t string")
    files.write_parquet(df, str(tmp_path / "x.parquet"))
    assert files.read_table(spark, str(tmp_path / "x.parquet")).count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path / "none.parquet"))
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(ValueError):
        files.read_table(spark, str(tmp_path / "x.txt"))
    with pytest.raises(FileNotFoundError):
        files.load_input(spark, str(tmp_path / "none.csv"))
    assert files.load_input(spark, str(tmp_path / "none.csv"), "q", "a", "sample").columns == ["id", "q", "a"]
    with pytest.raises(ValueError):
        files.load_input(spark, str(tmp_path / "x.parquet"))
    files.dump_json(spark, str(tmp_path / "d.json"), {"一": 1})
    assert "一" in (tmp_path / "d.json").read_text(encoding="utf-8")
    if files.importlib.util.find_spec("openpyxl") is None:
        assert files.write_excel(df, str(tmp_path / "x.xlsx")) is False
        (tmp_path / "x.xlsx").write_bytes(b"")
        with pytest.raises(RuntimeError):
            files.read_table(spark, str(tmp_path / "x.xlsx"))


def test_config(tmp_path):
    c = config.load(environ={})
    assert c.get("recall.topk") == 200 and c.get("no.such", 7) == 7 and c.seed == 42 and c.output_dir == "./outputs"
    c.set("a.b.c", 1)
    assert c.get("a.b.c") == 1 and c.to_dict()["a"] == {"b": {"c": 1}}
    assert [config.coerce(x) for x in ("true", "False", "12", "1.5", "x", "1.x")] == [True, False, 12, 1.5, "x", "1.x"]
    assert config.load(environ={"QA_BATCH_SIZE": "32"}).get("embeddings.batch_size") == 32
    for path, bad in (("embeddings.batch_size", 0), ("embeddings.batch_size", 1000), ("recall.topk", 5), ("recall.topk", 2000), ("consistency.cos_a", 0.3), ("consistency.cos_a", 1.5)):
        tree = config.load(environ={})
        tree.set(path, bad)
        with pytest.raises(config.ConfigError):
            config.validate(tree.tree)
    (tmp_path / "c.yaml").write_text("pipeline: {}\n")
    with pytest.raises(config.ConfigError):
        config.load(str(tmp_path / "c.yaml"), environ={})
    assert config.load(profile="high_precision", environ={}).get("consistency.vote_2_of_3") is False
    c.set("rerank.ce_aux_1", "m")
    assert c.scorer_model("ce_aux1") == "m"


QA = [(f"q{i}", q, a) for i, (q, a) in enumerate(
    [("如何开具电子发票？", "登录后申请，1天内发送。"), ("如何开具电子发票呢？", "登录后申请，1天内发送。"), ("如何开具电子发票吗？", "登录后申请，3天内发送。")] * 4
    + [("退款流程是什么样的？", "提交申请即可。"), ("退款流程是什么样的呢？", "提交申请即可。"), ("今天营业吗", "营业"), (None, "无"), ("价格是多少", "100元")]
)]


def test_whole_pipeline(spark, tmp_path):
    spark.createDataFrame(QA, "id string, question string, answer string").write.parquet(str(tmp_path / "in.parquet"))
    c = config.load(environ={})
    for k, v in (("recall.topk", 12), ("consistency.cos_a", 0.6), ("consistency.cos_b", 0.6), ("consistency.cos_c", 0.6), ("consistency.std_max", 0.3)):
        c.set(k, v)
    p = Pipeline(spark, c, str(tmp_path / "in.parquet"), str(tmp_path / "out"))
    stats = p.run()
    assert stats["stage1"]["input"] == 16 and stats["stage1"]["kept"] == 15
    final = p.get("final_clusters.parquet").collect()
    assert any(len(r.members) == 12 and r.conflict for r in final)
    assert os.path.exists(tmp_path / "out" / "stage_stats.json")
    assert files.read_table(spark, str(tmp_path / "out" / "final_clusters.csv")).count() == len(final)
    assert {"num_questions", "topk", "self_removed", "pairs_ngram_raw", "encode_seconds", "search_seconds"} <= set(stats["stage2"])
    assert any("environment" in (tmp_path / "out" / "logs" / f).read_text() for f in os.listdir(tmp_path / "out" / "logs") if f.endswith(".jsonl"))
    c.set("cluster.engine", "parallel")
    p.run(4, 5)
    c.set("recall.input", "raw")
    c.set("recall.faiss.persist_path", str(tmp_path / "index"))
    raw = Pipeline(spark, c, str(tmp_path / "in.parquet"), str(tmp_path / "raw"))
    assert raw.run(2, 2)["stage2"]["num_questions"] == sum(q is not None for _, q, _ in QA) and os.path.exists(tmp_path / "index" / "rows")
    for start, end in ((3, 2), (0, 1), (1, len(STAGES) + 1)):
        with pytest.raises(ValueError):
            p.run(start, end)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(QA, "id string, question string, answer string")
    df.write.parquet(str(tmp_path / "in"))
    stream = filtering.filter_stream(filtering.read_stream(spark, str(tmp_path / "in"), df.schema))
    for _ in range(2):  # a second run finds nothing new
        filtering.run_once(filtering.signal_stream(stream).select("id", "question"), str(tmp_path / "out"), str(tmp_path / "log"))
    got = sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(x for x, q, _ in QA if q and q != "今天营业吗")


CHEAP = ["qa_pipeline", "normalize_text", "filter_reason_counts", "dense_position", "ngram_jaccard_pairs", "fusion_tiers", "connected_components", "center_metrics", "protected_pairs", "modularity", "hard_conflict", "merge_answers", "score_histogram", "consistency_vote"]


@pytest.mark.parametrize("name", CHEAP)
def test_query_equals_sql(spark, name):
    got = catalogue.QUERIES[name](spark, TINY)
    cols = sorted(got.columns)
    con = duckdb.connect()
    for f in os.listdir(TINY):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{TINY}/{f}'")
    want = con.execute(f"select {', '.join(cols)} from ({catalogue.SQL[name]})").fetchall()
    tidy = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
    assert tidy(map(tuple, got.select(*cols).collect())) == tidy(want)


def test_every_query_has_a_name_and_sql_is_known():
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)


def test_copies_do_not_crowd_out_other_wordings(spark, tmp_path):
    a, b = "如何申请开具电子发票呢", "如何申请开具电子发票吗"
    qa = [(f"{i:02d}", a if i < 15 else b, "在订单页申请") for i in range(30)] + [("30", "会员积分多久会过期", "一年"), ("31", "会员积分多久会过期", "一年")]
    spark.createDataFrame(qa, "id string, question string, answer string").write.parquet(str(tmp_path / "in.parquet"))
    c = config.load(environ={})
    for k, v in (("recall.topk", 10), ("consistency.cos_a", 0.6), ("consistency.cos_b", 0.6), ("consistency.cos_c", 0.6), ("consistency.std_max", 0.3), ("cluster.engine", "parallel")):
        c.set(k, v)
    p = Pipeline(spark, c, str(tmp_path / "in.parquet"), str(tmp_path / "out"))
    p.run(1, 4)
    linked = {(r.i, r.j) for r in p.get("pairs_voted.parquet").collect()}
    assert (0, 15) in linked
    sizes = sorted(len(r.members) for r in p.get("clusters.parquet").collect())
    assert sum(sizes) == 32 and sizes in ([2, 30], [2, 15, 15])


def test_join_sized_gives_the_plain_join(spark):
    rows = spark.range(2000).select((F.col("id") % 7).alias("k"), "id").unionByName(spark.range(9000).select(F.lit(3).cast("long").alias("k"), "id"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low")).filter("k <> 5")
    want = sorted(map(tuple, rows.join(groups.drop("n"), ["k"]).select("k", "id", "low").collect()))
    for hot in (10, 2000, 10**9):
        assert sorted(map(tuple, join_sized(rows, groups, ["k"], "n", 11000, hot).select("k", "id", "low").collect())) == want


def test_gbk_after_a_long_ascii_start(spark, tmp_path):
    text = "question,answer\n" + "plain,text\n" * 20_000 + "如何开票,申请即可\n"
    (tmp_path / "late.csv").write_bytes(text.encode("gbk"))
    df = files.read_csv(spark, str(tmp_path / "late.csv"), multi_line=False)
    assert df.count() == 20_001 and [tuple(r) for r in df.filter("question <> 'plain'").collect()] == [("如何开票", "申请即可")]


def test_environment_record(spark):
    record = runtime.environment(spark)
    assert record["needed"]["pyspark"] and record["spark"] == spark.version and "openpyxl" in record["optional"]
    assert [runtime.workers(n, 8) for n in (-1, 0, None, 3, 99, -5)] == [8, 8, 8, 3, 8, 1]


def test_scratch_tables_are_released(spark):
    since = len(runtime.Scratch.roots)
    scratch = runtime.Scratch(spark, "mine")
    kept = scratch.put(spark.range(5))
    assert kept.count() == 5 and runtime.exists(spark, scratch.root)
    runtime.release(spark, since)
    assert not runtime.exists(spark, scratch.root) and len(runtime.Scratch.roots) == since
