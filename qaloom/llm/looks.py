"""Problem 1: one consistent form for text that looks the same.

Method: compatibility normalisation (composed form), full case folding, mapped white
space and removal of default-ignorable characters, once per distinct value of a batch.

Two forms come out of one pass:

* ``look``: what the reader sees. Width variants, presentation forms, radicals,
  accents, look-alike letters, invisible characters and special spaces are unified;
  letter case and other punctuation stay.
* ``form``: the consistent form for comparison: ``look``, compatibility-normalised in
  full and case-folded.

Edge cases: null stays null; empty, blank and invisible-only text gives ``''``; a text
of any length is processed whole; repeated rows give repeated rows; an empty table gives
an empty table; other columns pass through untouched.
"""

from __future__ import annotations

import unicodedata
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.runtime import Scratch, join_sized

# Look-alike letters come from the public Unicode confusables data, which Spark's own class
# path carries (``lookalikes``). The tables below are the readings that go before it.
# Cyrillic and Greek letters drawn like a Latin letter (public Unicode data).
LATIN_LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Ѕ": "S", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ԁ": "D", "Ӏ": "I",
    "а": "a", "е": "e", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "ѕ": "s", "у": "y", "ү": "y",
    "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "ı": "i", "ɑ": "a", "ɡ": "g",
}
# Greek letters drawn like a Cyrillic one that has no Latin twin.
OTHER_LOOKALIKES = {"Γ": "Г", "Π": "П", "Φ": "Ф"}
# CJK radicals without a decomposition, with the ideograph they are drawn like.
RADICALS = {
    "⺁": "厂", "⺄": "乙", "⺅": "亻", "⺆": "冂", "⺈": "刀", "⺉": "刂", "⺊": "卜", "⺎": "兀", "⺏": "尣", "⺐": "尢",
    "⺒": "巳", "⺓": "幺", "⺔": "彑", "⺕": "彐", "⺖": "忄", "⺘": "扌", "⺙": "攵", "⺛": "旡", "⺝": "月", "⺞": "歺",
    "⺠": "民", "⺡": "氵", "⺢": "氺", "⺣": "灬", "⺤": "爫", "⺦": "丬", "⺧": "牛", "⺨": "犭", "⺩": "王", "⺪": "疋",
    "⺬": "示", "⺭": "礻", "⺮": "竹", "⺯": "糹", "⺰": "纟", "⺱": "罓", "⺲": "罒", "⺶": "羊", "⺹": "耂", "⺺": "肀",
    "⺻": "聿", "⺽": "臼", "⺾": "艹", "⺿": "艹", "⻀": "艹", "⻁": "虎", "⻂": "衤", "⻃": "覀", "⻄": "西", "⻅": "见",
    "⻆": "角", "⻈": "讠", "⻉": "贝", "⻋": "车", "⻌": "辶", "⻍": "辶", "⻎": "辶", "⻐": "钅", "⻑": "長", "⻒": "镸",
    "⻓": "长", "⻔": "门", "⻖": "阝", "⻗": "雨", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食",
    "⻟": "飠", "⻠": "饣", "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻧": "卤", "⻨": "麦", "⻩": "黄",
    "⻪": "黾", "⻫": "斉", "⻬": "齐", "⻭": "歯", "⻮": "齿", "⻯": "竜", "⻰": "龙", "⻱": "龜", "⻲": "亀",
}

_INVISIBLE = regex.compile(r"[\p{Default_Ignorable_Code_Point}\p{Cc}--[\t\n\v\f\r\x85]]", regex.V1)
_BLANK = regex.compile(r"[\s\p{Z}]")
_MARK = regex.compile(r"\p{M}")
_OWN = LATIN_LOOKALIKES | OTHER_LOOKALIKES | RADICALS
#: Decompositions whose two sides are drawn alike. Circled, superscript, fraction and other styled forms show.
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>")


def _glyph(ch: str) -> str:
    """The usual character(s) drawn like ``ch``."""
    kind = unicodedata.decomposition(ch)
    if kind.startswith(_SAME_LOOK):
        return unicodedata.normalize("NFKC", ch)
    if kind.startswith("<compat>"):
        plain = unicodedata.normalize("NFKC", ch)
        if len(plain) == 1 and unicodedata.category(plain) == "Lo" or "\ufb00" <= ch <= "\ufb06":
            return plain
    return ch


class Table(dict):
    """A translation table that works out each character when it is first met."""

    def __init__(self, rule):
        self.rule = rule

    def __missing__(self, code: int) -> str:
        self[code] = out = self.rule(chr(code))
        return out


def lookalikes(spark: SparkSession) -> dict[str, str]:
    """Every letter or ideograph of the basic plane with the usual one it is confusable with.

    By the skeletons of the Unicode confusables: a letter stands for the ASCII letter of its
    case with the same skeleton, else for the skeleton itself if that is one character of
    its kind. ASCII stays as it is, and so do unified ideographs, which are letters of their
    own however alike (士 and 土). Raises where the class path has no such data: without
    it most look-alikes would be missed, and the result would not show that.
    """
    known = _CONFUSABLES.get("table")
    if known is None:
        chars = [c for c in map(chr, range(0xA1, 0xFFF0)) if not "\u4e00" <= c <= "\u9fff" and unicodedata.category(c) in ("Lu", "Ll", "Lo", "So") and unicodedata.normalize("NFKD", c) == c]
        latin = [chr(c) for c in (*range(65, 91), *range(97, 123))]
        try:
            checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
            skeletons = checker.getSkeleton("\n".join(latin + chars)).split("\n")
        except Exception as e:
            raise RuntimeError("no Unicode confusables: ICU (icu4j) of Spark's class path could not be used") from e
        ascii_ = {(s, c.isupper()): c for c, s in zip(latin, skeletons[: len(latin)], strict=True)}
        known = {}
        for c, s in zip(chars, skeletons[len(latin) :], strict=True):
            kind = unicodedata.category(c)
            to = ascii_.get((s, kind == "Lu")) if kind in ("Lu", "Ll") else None
            if to is None and len(s) == 1 and unicodedata.category(s) == ("Lo" if kind == "So" else kind):
                to = s
            if to is not None and to != c:
                known[c] = to
        _CONFUSABLES["table"] = known
    return known


_CONFUSABLES: dict[str, dict[str, str]] = {}


class Looks:
    """Reads texts as they are seen, by a table of look-alikes."""

    def __init__(self, table: dict[str, str]):
        # Own readings go first, for the targets too, so that a second pass changes nothing.
        ends = {k: _OWN.get(v, v) for k, v in table.items()} | _OWN
        self.table = table
        self.letters = str.maketrans({k: v for k, v in ends.items() if k != v})
        self.characters = Table(self._seen)

    def _seen(self, ch: str) -> str:
        if _INVISIBLE.match(ch):
            return ""
        if _BLANK.match(ch):
            return " "
        return unicodedata.normalize("NFC", unicodedata.normalize("NFD", _glyph(ch)).translate(self.letters))

    def look_of(self, text: str | None) -> str | None:
        """``text`` as it is seen: equal looks give equal results."""
        if text is None:
            return None
        text = text.translate(self.characters)
        if not text.isascii() and _MARK.search(text):
            text = unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(self.letters))
        return " ".join(text.split())

    def form_of(self, text: str | None) -> str | None:
        """The consistent form: compatibility-normalised, case-folded ``look_of``."""
        return folded(self.look_of(text))


#: By the tables above alone; and the last one made of the confusables, for the texts of a task.
PLAIN = Looks({})
_LAST: list[Looks] = []


def reading(table: dict[str, str]) -> Looks:
    """``Looks`` of a table, made once in a process."""
    if not _LAST or _LAST[0].table != table:
        _LAST[:] = [Looks(table)]
    return _LAST[0]


look_of, form_of = PLAIN.look_of, PLAIN.form_of


def folded(look: str | None) -> str | None:
    """The form of a text that is already as seen."""
    if look is None or look.isascii():
        return look if look is None else look.lower()
    return " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", look).casefold()).split())


def per_distinct(values: pd.Series, f) -> list:
    """``f`` of each value, called once per distinct value of the batch."""
    codes, distinct = pd.factorize(values, use_na_sentinel=True)
    out = [f(x) for x in distinct]
    out.append(f(None))
    return [out[c] for c in codes]


def looks(spark: SparkSession):
    """The column function that gives ``look`` and ``form`` of a text."""
    table = lookalikes(spark)

    @F.pandas_udf(T.StructType([T.StructField("look", T.StringType()), T.StructField("form", T.StringType())]))
    def run(values: pd.Series) -> pd.DataFrame:
        seen = reading(table).look_of
        both = per_distinct(values, lambda x: (y := seen(x), folded(y)))
        return pd.DataFrame(both, columns=["look", "form"])

    return run


def consistent(spark: SparkSession):
    """The column function that gives the consistent form of a text."""
    table = lookalikes(spark)

    @F.pandas_udf(T.StringType())
    def run(values: pd.Series) -> pd.Series:
        return pd.Series(per_distinct(values, reading(table).form_of), dtype=object)

    return run


def normalise_columns(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with each named text column in its consistent form."""
    form = consistent(df.sparkSession)
    return df.withColumns({c: form(F.col(c)) for c in columns})


def key128(c: Column) -> Column:
    """16 bytes that stand for a text in shuffles."""
    return F.unhex(F.md5(c))


def _spelt(df: DataFrame, key: str, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """One row per value with something visible (digests of look and spelling), and the
    spellings of the looks that have several, with the rows of each."""
    long = df.select(
        F.col(key).alias("key"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x"),
    ).select("key", "x.*")
    long = long.filter(F.col("value").isNotNull() & F.col("key").isNotNull())
    plain = F.trim(F.regexp_replace("value", r"[ \t\r\n\x0B\f]+", " "))
    rows = (
        long.select("key", "field_name", plain.alias("plain"), looks(df.sparkSession)("value").alias("s"))
        .filter(F.length("s.look") > 0)
        # The form adds nothing to the look here: equal looks have equal forms.
        .select("key", "field_name", key128(F.col("s.look")).alias("look"), key128(F.col("plain")).alias("plain"))
    )
    scratch = Scratch(df.sparkSession, "looks")
    rows = scratch.put(rows)
    spelt = rows.groupBy("field_name", "look", "plain").agg(F.count("*").alias("size"), F.min("key").alias("first"))
    several = Window.partitionBy("field_name", "look")
    spelt = spelt.withColumn("n", F.count("*").over(several)).filter("n > 1").drop("n")
    return rows, scratch.put(spelt)


def seen_alike(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """Pairs of rows whose field looks the same but differs in characters.

    Gives ``field_name, <key>_a, <key>_b`` with ``<key>_a < <key>_b``. Pairs are formed
    between the different spellings of one look, never within a spelling, so verbatim
    copies of a text (even a third of all rows) meet only texts that differ from them.
    Rows whose values are equal up to runs of blanks, tabs and line breaks are no pair,
    nor are nulls and texts with nothing visible. A repeated row is one row. ``alike`` says
    the same without listing pairs.
    """
    rows, spelt = _spelt(df, key, fields)
    total = rows.count()
    kept = join_sized(rows, spelt.select("field_name", "look", "plain", "size"), ["field_name", "look", "plain"], "size", total)
    kept = Scratch(df.sparkSession, "alike").put(kept)
    one, two = (spelt.select("field_name", "look", F.col("plain").alias(f"plain_{x}"), F.col("size").alias(f"size_{x}")) for x in "ab")
    differ = one.join(two, ["field_name", "look"]).filter("plain_a < plain_b")
    at = lambda x: kept.select("field_name", "look", F.col("plain").alias(f"plain_{x}"), F.col("key").alias(f"key_{x}"))
    pairs = differ.join(at("a"), ["field_name", "look", "plain_a"]).select("field_name", "look", "plain_b", "key_a").join(at("b"), ["field_name", "look", "plain_b"])
    low, high = F.least("key_a", "key_b"), F.greatest("key_a", "key_b")
    return pairs.filter("key_a <> key_b").select("field_name", low.alias(f"{key}_a"), high.alias(f"{key}_b")).distinct()


def alike(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """``field_name, <key>, class_<key>, links`` of every row that looks like one of other characters.

    The class is named by the smallest key that has its look; ``links`` counts the rows of
    the class that are spelt differently. Linear in the rows, whatever the classes' sizes.
    """
    rows, spelt = _spelt(df.dropDuplicates([key]), key, fields)
    look = Window.partitionBy("field_name", "look")
    classes = spelt.select("field_name", "look", "plain", "size", F.min("first").over(look).alias(f"class_{key}"), (F.sum("size").over(look) - F.col("size")).alias("links"))
    out = join_sized(rows, classes, ["field_name", "look", "plain"], "size", rows.count())
    return out.select("field_name", F.col("key").alias(key), f"class_{key}", "links")
