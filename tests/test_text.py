"""Normalisation, rules, n-grams and similarity against literal vectors and plain Python."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from qaloom.functions import signals, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def two(spark, a, b, f):
    return spark.createDataFrame([(a, b)], "a string, b string").select(f(F.col("a"), F.col("b")).alias("y")).first().y


@pytest.mark.parametrize("x,y", [("１２３ＡＢＣ", "123ABC"), ("！？（）", "!?()"), ("你　好", "你 好"), ("", "")])
def test_halfwidth(spark, x, y):
    assert one(spark, x, text.to_halfwidth) == y


@pytest.mark.parametrize(
    "x,y",
    [
        ("你好，世界！", "你好,世界!"),
        ("你好    世界", "你好 世界"),
        ("你好\n\t世界", "你好 世界"),
        ("  你好世界  ", "你好世界"),
        ("　　你好，世界！！！\n\t这是一个测试。　　", "你好,世界!!! 这是一个测试."),
        ("【】「」、《》—", '[]"","""-'.replace('""', '""', 1)),
        ("", ""),
        (None, None),
    ],
)
def test_normalize(spark, x, y):
    if x == "【】「」、《》—":
        y = '[]' + '""' + "," + '""' + "-"
    assert one(spark, x, text.normalize) == y


def test_normalize_is_idempotent_and_stable_set_is_stable():
    for c in [*range(0x80), *range(0x4E00, 0xA000), 0x3001, 0x3002, *range(0x300A, 0x3012), 0x201C, 0x201D, 0x2014]:
        assert unicodedata.normalize("NFKC", chr(c)) == chr(c)
    rng = random.Random(1)
    pool = "aＡ１，。 \t é⼀㎏①ﬁ你好《"
    for _ in range(300):
        once = text.normalized("".join(rng.choices(pool, k=rng.randint(0, 12))))
        assert text.normalized(once) == once


@pytest.mark.parametrize(
    "q,reason",
    [
        ("请问发票流程是什么？", "whitelist"), ("售后政策如何？", "whitelist"), ("申请材料有哪些？", "whitelist"), ("今天营业吗？", "blacklist"),
        ("附近哪家店比较好？", "blacklist"), ("你好，在吗？", "blacklist"), ("测试一下", "blacklist"), ("明天几点开门？", "blacklist"),
        ("这是一个普通问题", "keep"), ("价格是多少？", "keep"), ("", "keep"), ("！？。", "keep"), ("今天的发票政策是什么？", "whitelist"), ("which one", "blacklist"),
    ],
)
def test_reason(spark, q, reason):
    assert one(spark, q, lambda c: text.filter_reason(text.normalize(c))) == reason


def test_empty_pattern_list_matches_nothing(spark):
    assert one(spark, "x", lambda c: text.match_any(c, [])) is False


def test_char_ngrams(spark):
    grams = lambda x, n=3: sorted(one(spark, x, lambda c: text.char_ngrams(c, n)))
    assert grams("hello") == ["ell", "hel", "llo"]
    assert grams("你好世界") == sorted(["你好世", "好世界"])
    assert grams("abc", 4) == [] and grams("", 3) == [] and grams("hello", 0) == [] and grams("hello", -1) == []
    assert grams("aaaa") == ["aaa"]


@pytest.mark.parametrize("a,b,s", [("如何开发票", "怎么开发票", 0.2), ("ab", "cd", 1.0), ("", "", 1.0), ("abc", "", 0.0), ("abcd", "abcd", 1.0)])
def test_ngram_jaccard(spark, a, b, s):
    assert two(spark, a, b, text.ngram_jaccard) == pytest.approx(s)
    assert two(spark, b, a, text.ngram_jaccard) == pytest.approx(s)


@pytest.mark.parametrize("a,b,d", [("cat", "cart", 1), ("hello", "helloworld", 5), ("hello", "world", 4), ("kitten", "sitting", 3), ("如何开发票", "怎么开发票", 2), ("你好", "您好", 1), ("你好世界", "你好", 2)])
def test_edit_distance(spark, a, b, d):
    assert two(spark, a, b, text.edit_distance) == d


def test_adaptive_threshold(spark):
    assert two(spark, "short", "a much longer text", text.adaptive_threshold) == 0.50
    assert two(spark, "a longer text too", "a much longer text", text.adaptive_threshold) == 0.45


def test_signals(spark):
    s = one(spark, "需付100元,占5%,2024年1月2日前到支行办理,不支持 本周", lambda c: signals.signals(text.normalize(c)))
    assert "100元" in s.money and s.percent == ["5%"] and s.date == ["2024年1月2日", "本周"]
    assert s.neg == ["不", "不支持"] and s.cond == ["需"] and s.orgloc == ["支行"] and s.nums == ["100", "5", "2024", "1", "2"]


@pytest.mark.parametrize(
    "a,b,conflict",
    [
        ("费用100元", "费用104元", False), ("办理费用100元", "办理费用200元", True), ("支持", "不支持", True), ("2024年1月1日", "2024年1月2日", False),
        ("2024年1月1日", "2024年1月3日", True), ("本周", "2024年1月3日", False), ("", "", False), ("2024年13月40日", "2024年1月3日", False), ("无", "", True),
    ],
)
def test_pair_conflict(spark, a, b, conflict):
    assert two(spark, a, b, signals.pair_conflict) is conflict
