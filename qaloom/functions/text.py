"""Text functions on columns: normalisation, rule matching, character n-grams, similarity.

Everything but normalisation is a built-in expression. Compatibility normalisation has no
built-in, so normalisation is an Arrow function, worked out once per distinct value of a
batch.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Punctuation that differs from its usual half-width form.
PUNCTUATION = {
    "，": ",", "。": ".", "：": ":", "；": ";", "！": "!", "？": "?", "（": "(", "）": ")", "【": "[", "】": "]",
    "「": '"', "」": '"', "、": ",", "《": '"', "》": '"', "—": "-", "－": "-", "～": "~", "｜": "|",
}
# Words of questions to drop, one group per line (time, place, small talk, tests).
BLACKLIST = [
    "今天|明天|后天|昨天|大前天|本周|下周|上周|这个月|下个月|月底|年初|当月|次月|季度末",
    "附近|哪家店|哪个店|门店|网点|营业厅|分行|支行|这里|那里|本地|当地|就近",
    "聊聊|你好|您好|在吗|有人吗|早上好|中午好|下午好|晚上好|再见|拜拜|谢谢|不客气",
    "测试|test|hello|hi|呵呵|哈哈|嗯|嗯嗯|好的|知道了|明白了",
]
# Words of questions to keep whatever else they hold.
WHITELIST = [
    "流程|政策|规定|制度|材料|资费|资格|条件|要求|标准|规范",
    "发票|售后|退款|开发票|报销|发货|寄回|邮寄|快递|物流|配送",
    "积分|账单|套餐|合同|协议|保修|理赔|年费|手续费|服务费|违约金",
    "申请|办理|手续|证明|证件|资质|审核|批准|登记|注册|变更",
]

FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
HALF_WIDTH = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
#: Characters that compatibility normalisation leaves alone, alone and side by side.
_STABLE = re.compile("[\\x00-\\x7f一-鿿、。《-】“”—]*")


def to_halfwidth(c: Column) -> Column:
    """Full-width ASCII and the ideographic space in half width."""
    return F.translate(c, FULL_WIDTH, HALF_WIDTH)


_CLEAN = str.maketrans(dict(zip(FULL_WIDTH, HALF_WIDTH, strict=True)) | PUNCTUATION | {chr(c): " " for c in (*range(32), 127)})


def normalized(x: str) -> str:
    """The normalised form of one text."""
    if not _STABLE.fullmatch(x):
        x = unicodedata.normalize("NFKC", x)
    return " ".join(x.translate(_CLEAN).split())


@F.pandas_udf(T.StringType())
def _normalize(values: pd.Series) -> pd.Series:
    codes, distinct = pd.factorize(values)
    out = [normalized(x) for x in distinct] + [None]
    return pd.Series([out[i] for i in codes], dtype=object)


def normalize(c: Column) -> Column:
    """Compatibility forms, half width, control characters, punctuation and runs of space unified.

    One Arrow function does it all: what follows reads its result as a plain column,
    where a chain of expressions would be worked out again by each expression above it.
    """
    return _normalize(c.cast("string"))


def match_any(c: Column, patterns: list[str]) -> Column:
    """Whether any pattern occurs; never for an empty list."""
    return c.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def filter_reason(c: Column, whitelist: list[str] = WHITELIST, blacklist: list[str] = BLACKLIST) -> Column:
    """``whitelist`` before ``blacklist`` before ``keep``, of a normalised question."""
    return F.when(match_any(c, whitelist), "whitelist").when(match_any(c, blacklist), "blacklist").otherwise("keep")


def char_ngrams(c: Column, n: int = 3) -> Column:
    """The distinct character n-grams; none for a text shorter than ``n`` or ``n`` below 1."""
    if n < 1:
        return F.array().cast("array<string>")
    grams = F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n)))
    return F.when(F.length(c) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets: 1 where both are empty, 0 where one is."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def ngram_jaccard(a: Column, b: Column, n: int = 3) -> Column:
    return jaccard(char_ngrams(a, n), char_ngrams(b, n))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance in characters."""
    return F.levenshtein(a, b)


def adaptive_threshold(a: Column, b: Column, usual: float = 0.45, short: float = 0.50, short_len: int = 10) -> Column:
    """The n-gram threshold of a pair; stricter where one text is short."""
    return F.when(F.least(F.length(a), F.length(b)) < short_len, short).otherwise(usual)
