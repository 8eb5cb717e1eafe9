"""Problem 10: template residue and error-page text.

Method: title, host and body are compared, and low-information responses that recur
under unrelated titles and hosts are flagged together with placeholder detectors.

Two ways lead to a flag, and word patterns are only one sign in each.

Every body is read clause by clause, numbers masked. A body low in information (few
different words, no amount, no product code) is a template if

* none of its clauses stands beside real content: of the documents that hold the clause,
  next to all are as empty as this one (counted over the whole table),
* a clause of it recurs under three titles or hosts (two, if a word pattern hits), and
* it shares no term with its own title.

Bodies in which a detector hits are also read sentence by sentence, in full:

* an unfilled place (a variable of a template language, a form's "fill in here", the
  printed form of a missing object) outside of a sentence that explains it is residue;
* the other sentences are navigation, a notice (error, script, filler) or content. A
  body with a notice and next to no content is low in information; its evidence is the
  strength of its notices, whether its masked body recurs under several titles and
  sources, and whether it shares no term with its title. Enough evidence flags it.

A document with real content that tells about such things keeps its content sentences
and is left alone. Copies of a case have the same text, so each is flagged.

Edge cases: null, empty and blank texts are no cases; null titles and sources count as no
overlap and as one host; a text of any length is read whole; repeated rows give one row; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.defects import STOPWORDS
from qaloom.llm.looks import look_of
from qaloom.runtime import Scratch, join_sized

_C = regex.compile

# Element names of the public HTML standard, which are markup and no places.
ELEMENTS = (
    "a abbr address area article aside audio b base bdi bdo big blockquote body br button canvas caption center cite code col colgroup data datalist dd del details dfn dialog "
    "div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html i iframe img input ins kbd label legend li link "
    "main map mark meta meter nav noscript object ol optgroup option output p param picture pre progress q rp rt ruby s samp script section select slot small source span strike "
    "strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr"
)
_HTML = rf"(?:{'|'.join(ELEMENTS.split())})\b"

#: Unfilled places of template languages, of forms, and printed missing objects.
PLACE = _C(
    r"\{\{[^{}\n]{0,60}\}\}|\{%[^%\n]{1,60}%\}|<%=?[^%\n]{1,60}%>|[$#&]\{[^{}\n]{0,60}\}|\[\[[^\[\]\n]{1,60}\]\]|@@[\w.]+@@|##?[\w.]*\w##?(?!\d)"
    r"|%\([\w.]+\)[sd]|%[sd](?![A-Za-z])|\$[A-Za-z_][\w.]*\$|\$\d(?=\p{Han})|<(?!" + _HTML + r")[A-Za-z_][\w.]*>|\{\}|\{[A-Za-z_][\w.]*\}|\{\d\}|\{\p{Han}{1,12}\}|<\p{Han}{1,12}>|__[A-Za-z][\w.]*?__"
    r"|(?<![A-Za-z])(?:undefined|NaN)(?![A-Za-z])|\[object Object\]|(?<![A-Za-z])null(?=\p{Han}|[,;:!])"
    r"|[(\[{<〔【《「][^()\[\]{}<>〔〕【】《》「」\n]{0,6}(?:请填写|待填写?|在此输入|此处插入|此处填写|请输入|请插入|插入此处)[^()\[\]{}<>〔〕【】《》「」\n]{0,20}[)\]}>〕】》」]"
    r"|[(\[{<〔【《「][^()\[\]{}<>〔〕【】《》「」\n]{1,14}(?:待定|待补充|待填)[)\]}>〕】》」]"
    r"|〔(?:产品名称|客户姓名|联系电话|订单编号|门店地址|金额|日期|正文|[^〔〕\n]{2,8})〕"
)
#: Words of a sentence that explains a place or a notice instead of being one.
MENTION = _C(r"模板里|变量名|写法|怎么写|语法|替换为|自动换成|预览时|占位文字试|上线前|检查表|怎么办|通常是|是因为|请记下|如何在|属于正常|for example|is replaced|placeholder text is", regex.I)
NAVIGATION = _C(
    r"(?:登录|注册|购物车|首页|商品|详情|返回首页|返回顶部|联系我们|上一篇|下一篇|当前位置|帮助中心|正在加载|产品介绍|商品介绍|版权归本店所有|home|login|sign in|cart|menu|contact us|back to top|loading|all rights reserved|\p{Han}{1,6}商城|[\s|>:./·,&©-])+",
    regex.I,
)
ERROR = regex.compile(
    r"\b(?:40[0-9]|50[0-9])\b|错误|出错|报错|异常|失败|超时|繁忙|维护中|稍后(?:再试|重试)|点击重试|重试|不存在|移走|被移除|已删除|下架|走丢|没有权限|无权|权限不足|已过期|失效|联系管理员|过于频繁|滑块|验证后继续|网址是否正确|拒绝访问|无法访问|加载不出|恢复访问|刷新或返回|暂时无法|找不到|看看别的"
    r"|not (?:be )?found|forbidden|\berror\b|exception|traceback|expired|went wrong|blocked|unavailable|try (?:again|reloading)|could not|cannot be|request id|bad gateway|oops|denied|timed? ?out|unauthorized|contact the administrator|home page|reload to|most recent call|file \"|null pointer|maintenance|too many requests|temporarily",
    regex.I,
)
SCRIPT = regex.compile(r"java ?script|\bjs\b|脚本|noscript|cookies?|浏览器|scripts?\b|拦截插件|功能不可用|内容无法显示|开启后刷新|升级后重试", regex.I)
FILLER = regex.compile(
    r"占位(?:文本|文字|内容|符)?|\btodo\b|\btbd\b|\bfixme\b|待补充|待完善|待填充|补写|占个位|示例(?:文字|文本|内容)|说明文字|(?:这里|此处)(?:填写|输入|放)|测试(?:数据|内容|文本)?|(?:标题|内容|段落|正文)(?=$|[\s,、。;:])|lorem|ipsum|dolor|(?:asdf|qwer|zxcv|hjkl)\w*|\b(?:x{2,}|a{3,})\b|\b(?:12345|123456|1234)\b|敬请期待|内容建设中",
    regex.I,
)
_TAG = _C(r"</?(?:p|br|div|span|noscript|html|body|head|title|h\d|a|ul|li|b|i|center|hr|script|meta)\b[^<>]*>", regex.I)
_SENTENCE = _C(r"[^。!?！？;；\n]+[。!?！？;；]*")
_STOPS = {w for words in STOPWORDS.values() for w in words.split() if len(w) > 1}
_WORD = _C(r"\p{Han}|[\p{L}\p{N}]+")
#: Content characters a low-information body may have per character of its notices, and in all.
SHARE, SPARE = 0.5, 12
ENOUGH = 2
FEW_WORDS = 24
#: Different words (Chinese characters) that a body low in information has at most.
PLAIN_WORDS = 64
#: Least share of a clause's documents that are low in information; titles or hosts it recurs under.
PURE, SPREAD = 0.9, 3


def tidy(text: str) -> str:
    """The text as seen, line by line, without plain markup."""
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    lines = (look_of(x) for x in (_TAG.sub("\n", text) if "<" in text else text).splitlines())
    return "\n".join(x for x in lines if x)


def repetitive(words: list[str]) -> bool:
    """Few words said over and over, with nothing else."""
    return len(words) >= 8 and len(own := set(words)) <= FEW_WORDS and len(own) <= 0.4 * len(words)


def meaningless(words: list[str]) -> bool:
    """Latin words of no language: none of the words that every language needs."""
    return len(words) >= 5 and _STOPS.isdisjoint(words) and all(w.isalpha() and w[0] < "\u0250" for w in words)


#: What a real page names: an amount or date, a product code.
_PARTICULAR = re.compile(r"\d ?(?:[\u4e00-\u9fff]|%|°|(?:day|hour|month|minute|working|yuan)s?)|[A-Za-z]{2}-?\d{4}")
_MASKED = re.compile(r"[0-9a-f]*\d[0-9a-f]*")
_CLAUSE = re.compile(r"[,.!?;:。、!?\n]+")


def parts(body: str) -> list[int]:
    """The clauses of a body that are no navigation, numbers masked, as hashes."""
    out = {c for x in _CLAUSE.split(_MASKED.sub("0", body.lower())) if len(c := x.strip()) > 1}
    return [xxhash.xxh64_intdigest(c) - (1 << 63) for c in out if len(c) > 40 or not NAVIGATION.fullmatch(c)]


def in_title(title: str | None, body: str) -> bool:
    """Whether four characters of the title stand in the body."""
    if not title:
        return False
    seen, flat = (_JOINED.sub("", x).lower() for x in (look_of(title), body))
    return len(seen) >= 4 and any(seen[i : i + 4] in flat for i in range(len(seen) - 3))


_JOINED = re.compile(r"\W+")


def examine(text: str | None, title: str | None) -> tuple[bool, bool, int, bool, str, list[int], list[int], bool]:
    """(unfilled place, low information by the detectors, strength of notices, shares a term
    with the title, masked body, clauses of a body low in information, clauses of any other
    body, whether a detector hits)."""
    if text is None or not text.strip():
        return False, False, 0, False, "", [], [], False
    body = tidy(text)
    found = parts(body)
    plain = not _PARTICULAR.search(body) and len(set(_WORD.findall(body.lower()))) <= PLAIN_WORDS
    cue = PLACE.search(body) or ERROR.search(body) or SCRIPT.search(body) or FILLER.search(body)
    own = (found, []) if plain else ([], found)
    shares = plain and in_title(title, body)
    # A few words over and over use few different characters.
    dull = len(set(body)) <= 4 * FEW_WORDS and repetitive(_WORD.findall(body.lower()))
    # Mostly ASCII and without any function word: the sentences are looked at.
    dull = dull or (len(body.encode()) < 1.35 * len(body) + 80 and _STOPS.isdisjoint(body.lower().split()))
    if not dull and not cue:
        return False, False, 0, shares, "", *own, False
    place, notice, content, kinds = False, 0, 0, set()
    words, told = [], []
    headed = False
    for m in _SENTENCE.finditer(body):
        s = m[0].strip()
        if not s or NAVIGATION.fullmatch(s.rstrip("。!?.…")):
            continue
        explained = MENTION.search(s) is not None
        if not explained:
            place = place or PLACE.search(s) is not None
            words += _WORD.findall(s.lower())
        hit = [k for k, p in (("error", ERROR), ("script", SCRIPT), ("filler", FILLER)) if p.search(s)]
        if hit and not explained:
            cue = sum(len(x[0]) for p in (ERROR, SCRIPT, FILLER) for x in p.finditer(s))
            if cue >= 0.12 * len(s) or len(s) <= 40:
                told += _WORD.findall(s.lower())
                notice += len(s)
                kinds.update(hit)
                if cue >= 0.3 * len(s) or len(hit) > 1:
                    kinds.add("strong")
                continue
        if not headed and len(s) <= 32 and s[-1] not in "。!?.;":
            headed = True  # a first line without an end is a headline
            continue
        headed = True
        told += _WORD.findall(s.lower())
        content += len(s)
    mass = (meaningless(told) and (not kinds or "filler" in kinds)) or repetitive(words) and ("filler" in kinds or not any(c.isdigit() for w in words for c in w))
    low = mass or (notice > 0 and content <= max(SPARE, SHARE * notice))
    masked = low and regex.sub(r"[0-9a-fA-F]{6,}|\d+|[A-Za-z]{2}-?\d+", "#", body)
    shares = shares or low and in_title(title, body)
    strength = len(kinds - {"strong"}) + ("strong" in kinds) + 2 * mass
    return place, low, strength, shares, masked or "", *own, bool(cue)


_COLUMNS = ["place", "low", "strength", "shares", "masked", "parts", "used", "cue"]
_SHAPE = T.StructType([T.StructField(n, t) for n, t in zip(_COLUMNS, (T.BooleanType(), T.BooleanType(), T.IntegerType(), T.BooleanType(), T.StringType(), T.ArrayType(T.LongType()), T.ArrayType(T.LongType()), T.BooleanType()), strict=True)])


@F.pandas_udf(_SHAPE)
def examined(text: pd.Series, title: pd.Series) -> pd.DataFrame:
    rows = [examine(t, h) for t, h in zip(text, title, strict=True)]
    return pd.DataFrame(rows, columns=_COLUMNS).astype({"strength": "int32"})


def templates(seen: DataFrame, total: int) -> DataFrame:
    """``key`` of the bodies low in information whose clauses recur, but never beside content."""
    bare = seen.filter((F.size("parts") > 0) & F.col("mismatch"))
    held = seen.filter(F.size("parts") > 0).select("key", "title", "host", F.explode("parts").alias("hash"))
    beside = seen.select(F.explode("used").alias("hash")).groupBy("hash").agg(F.count("*").alias("beside"))
    stats = held.groupBy("hash").agg(F.count("*").alias("size"), F.greatest(F.countDistinct("title"), F.countDistinct("host")).alias("spread"))
    stats = stats.join(beside, "hash", "left").select("hash", "size", "spread", (F.col("size") >= PURE * (F.col("size") + F.coalesce("beside", F.lit(0)))).alias("pure"))
    stats = Scratch(seen.sparkSession, "clauses").put(stats)
    asked = bare.select("key", "cue", F.explode("parts").alias("hash"))
    by = join_sized(asked, stats, ["hash"], "size", total).groupBy("key").agg(F.min("pure").alias("pure"), F.max("spread").alias("spread"), F.max("cue").alias("cue"))
    return by.filter(F.col("pure") & (F.col("spread") >= F.when(F.col("cue"), SPREAD - 1).otherwise(SPREAD))).select("key")


def evidence(df: DataFrame, key: str, text: str, title: str, host: str) -> DataFrame:
    """``<key>, place, low, strength, mismatch, spread, template, residue`` of every row with a text.

    ``spread``: the masked low-information body recurs under at least three titles or
    hosts. Only digests of clauses and of low-information bodies are shuffled.
    """
    seen = df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(title).alias("title"), F.coalesce(F.col(host), F.lit("")).alias("host"), examined(F.col(text), F.col(title)).alias("x")
    )
    body = F.when(F.col("x.masked") != "", F.unhex(F.md5("x.masked"))).alias("body")
    seen = seen.select("key", F.xxhash64("title").alias("title"), F.xxhash64("host").alias("host"), "x.place", "x.low", "x.strength", (~F.col("x.shares")).alias("mismatch"), body, "x.parts", "x.used", "x.cue")
    seen = Scratch(df.sparkSession, "residue").put(seen)
    total = seen.count()
    found = templates(seen, total).withColumn("template", F.lit(True))
    narrow = seen.drop("title", "host", "parts", "used", "cue")
    # Only bodies low in information are looked up; the others share one key.
    spread = seen.filter("low").groupBy("body").agg(F.count("*").alias("size"), (F.greatest(F.countDistinct("title"), F.countDistinct("host")) >= SPREAD).alias("spread"))
    low = join_sized(narrow.filter("low"), spread, ["body"], "size", total)
    other = narrow.filter("not low").withColumn("spread", F.lit(False))
    out = low.select(*other.columns).unionByName(other).join(found, "key", "left")
    template = F.coalesce("template", F.lit(False))
    score = F.col("strength") + F.col("mismatch").cast("int") + F.col("spread").cast("int")
    residue = F.col("place") | (F.col("low") & (score >= ENOUGH)) | template
    return out.select(F.col("key").alias(key), "place", "low", "strength", "mismatch", "spread", template.alias("template"), residue.alias("residue")).distinct()


def residue_rows(df: DataFrame, key: str, text: str, title: str, host: str) -> DataFrame:
    """The keys of the rows to leave out."""
    return evidence(df, key, text, title, host).filter("residue").select(key).distinct()


def without_residue(df: DataFrame, key: str, text: str, title: str, host: str) -> DataFrame:
    """``df`` without residue; rows that have no text stay."""
    return df.join(residue_rows(df, key, text, title, host), key, "left_anti")
