"""Problem 7: broken prompt and response pairs.

Method: the openings and all further clauses of every response are masked and clustered by
MinHash bands with verified Jaccard similarity. A cluster reveals refusals by its own
evidence: it recurs across unrelated prompts, and the responses that hold it hold nothing
else that answers (no amount, no words of the prompt). Declining words are one more sign:
with them two prompts are enough, without them three are needed that share no topic, and
next to no response may put the clause beside an answer. Copy, language and termination
checks label the remaining defects. An unended last sentence is cut only on a positive sign: a dangling
connective, an open bracket, or, learned from all distinct answers, sentences that go on
after the same characters while fewer than two end with the same words.

One defect per row, the first that holds of: ``empty``, ``copy``, ``language``,
``refusal``, ``truncated``.

Edge cases: a null, blank, markup-only or stand-in answer is empty; a null or empty
question cannot be copied and has no language, the other checks still hold; texts of any
length are read whole; repeated rows give one row; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.looks import Table, look_of
from qaloom.llm.survivor import STAND_INS
from qaloom.runtime import Scratch, join_sized

_C = regex.compile
_TAG = _C(r"<[^<>]*>|&[A-Za-z#0-9]+;")
_DROP = Table(lambda ch: "" if unicodedata.category(ch)[0] in "PSZC" else ch)
_END = "。.!?！？…؟।"
_CLAUSE = _C(r"[,，。.!?！？;；:：\n]+")
_SENTENCE_END = _C(r"[。!?！？]+|[.](?=\s|$)|\n+")
_TOKEN = _C(r"[\p{Han}\p{Hiragana}\p{Katakana}]|\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}]+")
_CODE = _C(r"[A-Za-z]{1,4}[\s_-]?\d[\d\s-]*|\d+")
#: Words around a repeated question that say nothing of their own.
_WRAP = _C(r"(?:您的?|你的?)?(?:问题|提问|问的?|question|q|您问的是|关于|请问|是|为|you asked|your question is|re)*", regex.I)
#: First-person clauses that decline to answer.
DECLINE = _C(
    r"(?:我|恕).{0,8}(?:无法|不能|不便|没有办法|没办法|没法|没有权限|无权|帮不了|帮不上|还?没有?学会|难以|不予|不可以|爱莫能助)"
    r"|(?:无法|不能|不便|没有办法|难以|暂不|不方便).{0,6}(?:回答|作答|答复|回复|提供(?:这|此|该|相关|帮助)|讨论|协助|帮助您|帮您|处理(?:这|此|您))"
    r"|(?:超出|不在|超过).{0,14}(?:能力|范围|权限)|帮不了您|无可奉告|恕难|能力范围"
    r"|(?:can(?:'|no|)t|cannot|can not|could not|unable to|not able to|won't|will not|not allowed to|may not|must not|not permitted to).{0,40}(?:help|answer|assist|discuss|give|provide|respond|comment|share)"
    r"|have to decline|must decline|i decline|outside (?:of )?(?:what|my)|beyond (?:my|what)|not something i can|against my",
    regex.I,
)
# Frequent short words of languages written with Latin letters.
STOPWORDS = {
    "en": "the a an of to and in is are was for on with you your it this that by from how why what where when can do does i my be will please within",
    "de": "der die das den dem ein eine und ist sind nicht mit für auf von zu im wie wir sie ihr nach bei auch am wird innerhalb kann sich das man",
    "fr": "le la les un une des du de et est sont dans pour avec sur par vous votre nous au aux ce cette que qui se en depuis pas",
    "es": "el la los las un una de del y es son en para con por su sus que se al lo como puede desde no más si recibirá",
    "it": "il lo la gli un una di del della e è sono per con su si che non come può dal nel",
    "pt": "o a os as um uma de do da e é são para com por seu sua que se não como pode no na",
    "nl": "de het een van en is zijn niet met voor op naar bij ook aan wordt kan binnen u uw dit dat",
}
_STOP = {lang: set(words.split()) for lang, words in STOPWORDS.items()}
#: Last words of a sentence that show whether it ended; bands and rows of the signatures; verified similarity.
ENDING, BANDS, ROWS, SIMILAR = 4, 16, 2, 0.6
#: A declining clause must recur under this many different prompts, one without declining words under more.
PROMPTS = 2
#: Clauses of a bucket that are linked in one go; of a larger one, a block at a time.
BUCKET, BLOCK = 2_000, 1_000


def bare(text: str) -> str:
    """Letters and digits only, case-folded."""
    return unicodedata.normalize("NFKC", text).casefold().translate(_DROP)


def is_empty(seen: str | None) -> bool:
    if seen is None:
        return True
    left = bare(_TAG.sub("", seen))
    return not left or left in _EMPTY


_EMPTY = {bare(x) for x in STAND_INS}


def copies_question(q: str, a: str) -> bool:
    """Whether nothing is left of the answer once the question is taken out of it."""
    q, a = bare(q), bare(a)
    if len(q) < 2 or len(a) < 2:
        return False
    if q in a:
        return _WRAP.fullmatch(a.replace(q, "")) is not None
    if len(a) >= max(6, 0.8 * len(q)) and a in q:
        return True
    if len(a) < 0.75 * len(q) or len(a) < 8 or len(a) > 2.2 * len(q):
        return False
    grams = {q[i : i + 3] for i in range(len(q) - 2)}
    own = [a[i : i + 3] for i in range(len(a) - 2)]
    return sum(g in grams for g in own) >= 0.92 * len(own)


def language(text: str) -> str | None:
    """A coarse language of a text without codes; None where too little of it says."""
    text = _CODE.sub(" ", text)
    n = {"ja": 0, "ko": 0, "zh": 0, "ru": 0, "latin": 0, "ar": 0, "th": 0}
    for name, p in _SCRIPTS:
        n[name] = sum(map(len, p.findall(text)))
    weight = {"zh": 2.5 * n["zh"], "ja": 2.5 * (n["ja"] + n["zh"]) if n["ja"] >= 2 and n["ja"] >= 0.15 * n["zh"] else 0, "ko": 2.5 * n["ko"], "ru": n["ru"], "latin": n["latin"], "ar": n["ar"], "th": n["th"]}
    best = max(weight, key=lambda k: (weight[k], k == "ja"))
    if weight[best] < 5 or weight[best] < 0.5 * sum(v for k, v in weight.items() if k != "zh" or best != "ja"):
        return None
    if best != "latin":
        return best
    words = [w.lower() for w in _LATIN_WORD.findall(text)]
    hits = {lang: sum(w in stop for w in words) for lang, stop in _STOP.items()}
    lang = max(hits, key=lambda k: hits[k])
    rest = sorted(hits.values())[-2]
    return f"latin-{lang}" if hits[lang] >= 2 and hits[lang] > rest else "latin"


_SCRIPTS = [("ja", _C(r"[\p{Hiragana}\p{Katakana}]")), ("ko", _C(r"\p{Hangul}")), ("zh", _C(r"\p{Han}")), ("ru", _C(r"\p{Cyrillic}")), ("latin", _C(r"(?<![\p{L}\p{M}])\p{Ll}[\p{Latin}\p{M}']*")), ("ar", _C(r"\p{Arabic}")), ("th", _C(r"\p{Thai}"))]


_NAME = _C(r"(?<![\p{Latin}\p{M}\p{N}])[\p{Latin}\p{N}]*\p{Latin}[\p{Latin}\p{N}]*")


_LATIN_WORD, _LATIN_CHAR, _HAN_CHAR, _HAN_RUN, _KEY = _C(r"[\p{Latin}']+"), _C(r"\p{Latin}"), _C(r"\p{Han}"), _C(r"\p{Han}{2,}"), re.compile(r'"\w+"\s*:')
_HAN, _NOT_CHINESE = re.compile("[一-鿿]+"), _C(r"[\p{Hiragana}\p{Katakana}\p{Hangul}\p{Cyrillic}]")


def _mostly_han(text: str) -> bool:
    return len(_HAN.sub("", text)) < 0.6 * len(text) and not _NOT_CHINESE.search(text)


def other_language(q: str, a: str) -> bool:
    """Whether the answer is in another language than the question; shared names do not count."""
    if _mostly_han(q) and _mostly_han(a):
        return False
    known = {w.lower() for w in _NAME.findall(q)}
    rest = _NAME.sub(lambda m: " " if m[0].lower() in known else m[0], a)
    ask = _KEY.sub(" ", q)
    for run in sorted(set(_HAN_RUN.findall(rest)), key=len, reverse=True):
        if run in q and len(run) <= 8 and len(_LATIN_CHAR.findall(rest)) > len(_HAN_CHAR.findall(rest)):
            rest = rest.replace(run, " ")
    x, y = language(ask), language(rest)
    if x is None or y is None or x == y:
        return False
    if x.startswith("latin") and y.startswith("latin"):
        return "latin" not in (x, y)
    return True


def last_tokens(sentence: str) -> list[str]:
    """The last words; the piece that is read grows until its first word is whole."""
    width = 40
    while True:
        found = _TOKEN.findall(sentence[-width:])
        if len(found) > ENDING or width >= len(sentence):
            return found
        width *= 4


def words_at_end(sentence: str) -> str | None:
    """The last words, numbers masked; None for a sentence of fewer than two."""
    found = last_tokens(sentence)
    if len(found) < 2:
        return None
    return " ".join("#" if w[0].isdigit() else w.lower() for w in found[-ENDING:])


_DOTS = _C(r"(?:[.．]{2,}|…+|。{2,}|·{3,})$")


def ends(seen: str) -> tuple[list[str], str | None, bool]:
    """Endings of the sentences that end, the ending of an unended last one, and whether that is cut beyond doubt."""
    text = seen.rstrip(" \t\n*~-_|\"'”’」』)）]】》>")
    if _DOTS.search(text):
        text = _DOTS.sub("…", text)
    pieces = _SENTENCE_END.split(text)
    closed = [e for p in pieces[:-1] if p.strip() and (e := words_at_end(p))]
    last = pieces[-1].strip()
    if not last:
        return closed, None, False
    if last[-1] in "…�,，、:：;；(（“‘「『《【[{/\\&+=" or seen.rstrip().endswith(("�", "“", "(", "（", "-")):
        return closed, "", True
    if _DANGLING.search(last) or max(map(seen.rfind, "（([【{《“")) > max(0, len(seen) - len(last) - 8, *map(seen.rfind, "）)]】}》”")):
        return closed, "", True
    return closed, words_at_end(last) or last, False


#: Words that open what does not follow.
_DANGLING = _C(r"(?:由于|因为|并且|而且|但是|以及|或者|如果|例如|比如|和|与|及|或|把|被|将)$|\b(?:and|or|but|because|the|an?|of|for example|such as|if|while|since|(?:have|need) to)$", regex.I)


#: Stands between sentences; a letter, so that ``bare`` keeps it, of no living script.
_GAP = "\ua66e"
WIDE, NARROW = 10, 5


def joined(seen: str) -> str:
    """The sentences without blanks and punctuation, codes and numbers masked, parted by ``_GAP``."""
    text = seen.rstrip(" \t\n*~-_|\"'”’」』)）]】》>")
    return _ZEROS.sub("0", bare(_CODE.sub("0", _SENTENCE_END.sub(_GAP, text))))


_ZEROS, _DIGITS = re.compile("0+"), re.compile(r"\d+")
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WIDE)], dtype=np.uint64)


def open_ends(rows: list[str | None]) -> tuple[list[int | None], list[np.ndarray | None]]:
    """Of each row's ``joined`` sentences: the last characters of an unended last one, and the
    same of every place where a sentence goes on, as hashes of 5 characters (10 of ASCII).

    All rows of a batch are hashed in one go; what precedes a sentence counts as gap.
    """
    pad = _GAP * WIDE
    texts = ["" if r is None else r.replace(_GAP, pad) for r in rows]
    codes = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(codes), np.uint64)
        for k in range(WIDE):
            part = codes * _POWERS[k]
            if k >= NARROW:
                part = np.where(np.roll(codes, -k) < 128, part, np.uint64(0))
            h[k:] += part[: len(codes) - k]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    h = h.view(np.int64)
    gap = codes == ord(_GAP)
    inner = ~gap & ~np.roll(gap, 1) & ~np.roll(gap, -1)
    tails, insides, at = [], [], WIDE
    for row, text in zip(rows, texts, strict=True):
        end = at + len(text)
        tails.append(int(h[end - 1]) if text and not gap[end - 1] else None)
        insides.append(None if row is None else np.unique(h[at:end][inner[at:end]]))
        at = end + WIDE
    return tails, insides


_SORRY = _C(r"^\s*(?:(?:unfortunately|sorry|but|however|i'?m (?:very )?sorry|my apologies|很抱歉|非常抱歉|抱歉|对不起|不好意思)\s*)+", regex.I)


#: Clauses around a refusal that answer nothing: apologies, thanks, whom to ask instead, who speaks.
_FILLER = _C(
    r"抱歉|对不起|不好意思|遗憾|谅解|理解|感谢|谢谢|建议|请(?:您)?(?:咨询|联系|拨打|致电|换|改|稍后)|客服|热线|电话|专业人士|作为.{0,8}(?:助手|模型|客服)|没有相关信息|您好|祝您"
    r"|sorry|apolog|unfortunately|thank|understand|please (?:contact|call|ask|try|consult)|hotline|support team|customer service|as an? (?:ai|assistant)",
    regex.I,
)
#: An amount with a unit: what an answer states, unlike phone numbers, order numbers and dates.
_AMOUNT = _C(r"(?<![\d-])\d{1,4}(?:\.\d+)?\s*(?:元|块|折|%|个?小时|分钟|秒|天|个?工作日|个月|次|件|度|厘米|米|(?:hours?|days?|minutes?|seconds?|weeks?|months?|yuan|percent|times)\b)", regex.I)


def long_run(clause: str, ask: str, han: int, latin: int) -> bool:
    """Whether a run of characters of the clause, so long for its script, is in the question."""
    run = latin if clause.isascii() else han  # letters say less than characters do
    return any(clause[i : i + run] in ask for i in range(len(clause) - run + 1))


_MEMO: dict[str, tuple[str, int, bool, bool, bool]] = {}


def read_clause(c: str) -> tuple[str, int, bool, bool, bool]:
    """(letters with numbers masked, their hash, declines, filler, amount) of a clause."""
    if (known := _MEMO.get(c)) is None:
        if len(_MEMO) > 100_000:
            _MEMO.clear()
        b = _DIGITS.sub("0", bare(_SORRY.sub("", c)))
        known = b, xxhash.xxh64_intdigest(b) - (1 << 63), DECLINE.search(unicodedata.normalize("NFKC", c)) is not None, _FILLER.search(c) is not None, _AMOUNT.search(c) is not None
        _MEMO[c] = known
    return known


def clauses(q: str, a: str) -> tuple[list[tuple[str, int, bool]], list[int]]:
    """(the clauses of an answer that answers nothing, with hash and whether each declines;
    the hashes of the clauses of one that answers), without apologies, thanks and referrals.

    A clause answers if it names an amount or takes up words of the question, and does not decline.
    """
    ask = bare(q)
    out, answers, names = [], False, False
    for c in _CLAUSE.split(a):
        b, h, declines, filler, amount = read_clause(c)
        if not b:
            continue
        if declines or not filler:
            out.append((b, h, declines))
        if declines and len(b) >= 4 and not long_run(b, ask, 6, 16):
            continue
        answers = answers or not filler and (amount or long_run(b, ask, 3, 12))
        names = names or not filler and "0" in b
    if answers:
        return [], [h for _, h, _ in out]
    # Beside a number or code of any kind only declining words tell; order numbers do occur in refusals.
    kept = [x for x in out if len(x[0]) >= 4 and (x[2] or not names)]
    return kept, [h for _, h, _ in out] if names and not kept else []


#: Words of questions about anything.
_ASKING = set("怎么 如何 什么 多少 多久 哪里 哪些 可以 能不 不能 请问 是否 需要 问题 一下 想问 为什 为何 办理 how what where when why can does the".split())


def topic(q: str) -> list[int]:
    """The character pairs (words of Latin script) a question is about, as hashes."""
    words = set()
    for w in _TOKEN_RUN.findall(unicodedata.normalize("NFKC", q).casefold()):
        words.update([w] if w.isascii() else [w[i : i + 2] for i in range(len(w) - 1)])
    return [xxhash.xxh64_intdigest(w) - (1 << 63) for w in words - _ASKING if len(w) > 1]


_TOKEN_RUN = _C(r"\p{Han}+|\p{L}+")


_NONE = ([], [])


def examine(question: str | None, answer: str | None):
    """(defect found from the row alone, endings, last ending, clauses of an answer that
    answers nothing, clause hashes of one that answers, topic of the question of the former,
    joined sentences)."""
    if answer is not None and ("<" in answer or "&" in answer):
        answer = html.unescape(_TAG.sub(" ", answer))
    a = look_of(answer)
    if is_empty(a):
        return "empty", [], None, *_NONE, [], None
    q = look_of(question) or ""
    if copies_question(q, a):
        return "copy", [], None, *_NONE, [], None
    nothing, used = clauses(q, a)
    about = topic(q) if nothing else []
    if q and other_language(q, a):
        # A refusal is a refusal in any language; clauses decide first.
        return "language", [], None, nothing, used, about, None
    closed, last, cut = ends(a)
    return ("truncated" if cut else None), closed, last, nothing, used, about, joined(a)


_COLUMNS = ["own", "closed", "last", "clauses", "used", "topic", "tail", "inside"]
_TEXTS, _HASHES = T.ArrayType(T.StringType()), T.ArrayType(T.LongType())
_CLAUSES = T.ArrayType(T.StructType([T.StructField("clause", T.StringType()), T.StructField("hash", T.LongType()), T.StructField("declines", T.BooleanType())]))
_SHAPE = T.StructType([T.StructField(n, t) for n, t in zip(_COLUMNS, (T.StringType(), _TEXTS, T.StringType(), _CLAUSES, _HASHES, _HASHES, T.LongType(), _HASHES), strict=True)])


@F.pandas_udf(_SHAPE)
def examined(q: pd.Series, a: pd.Series) -> pd.DataFrame:
    rows = [examine(x, y) for x, y in zip(q, a, strict=True)]
    tails, insides = open_ends([r[6] for r in rows])
    named = lambda cs: [dict(zip(("clause", "hash", "declines"), c, strict=True)) for c in cs]
    out = pd.DataFrame([(*r[:3], named(r[3]), r[4], r[5], t, [] if i is None else i) for r, t, i in zip(rows, tails, insides, strict=True)], columns=_COLUMNS, dtype=object)
    return out.astype({"tail": "Int64"})  # floats would round the hashes


_SEEDS = np.array([xxhash.xxh64_intdigest(f"hash {i}") | 1 for i in range(BANDS * ROWS)], dtype=np.uint64)


def bands(text: str) -> list[int]:
    """The LSH bucket keys of a clause's character pairs."""
    grams = {text[i : i + 2] for i in range(max(1, len(text) - 1))}
    h = np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64, len(grams))
    with np.errstate(over="ignore"):
        low = ((h[:, None] ^ (h[:, None] >> np.uint64(31))) * _SEEDS[None, :]).min(0)
    return [xxhash.xxh64_intdigest(low[b * ROWS : (b + 1) * ROWS].tobytes(), b) - (1 << 63) for b in range(BANDS)]


@F.pandas_udf(T.ArrayType(T.LongType()))
def band_keys(c: pd.Series) -> pd.Series:
    return c.map(bands)


def pairs(text: str) -> set[str]:
    return {text[i : i + 2] for i in range(max(1, len(text) - 1))}


def near(x: set[str], y: set[str]) -> bool:
    return len(x & y) >= SIMILAR * len(x | y)


def similar(a: str, b: str) -> bool:
    return near(pairs(a), pairs(b))


def _led(members: list[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """The clauses of a bucket in ascending order, each with every earlier head it is similar
    to; one similar to none becomes a head. And the heads."""
    heads: dict[str, set[str]] = {}
    out = []
    for c in sorted(members):
        x = pairs(c)
        own = [h for h, y in heads.items() if near(x, y)]
        if not own:
            heads[c] = x
        out += [(c, h) for h in own if h != c]
    return out, list(heads)


def _led_block(batches):
    """The links of each block of clauses and its heads (with themselves); ``last`` is its last clause."""
    for pdf in batches:
        rows = []
        for bucket, parts, members in zip(pdf["bucket"], pdf["parts"], pdf["members"], strict=True):
            (links, heads), last = _led(list(members)), max(members)
            rows += [(bucket, parts, c, h, last) for c, h in links + [(h, h) for h in heads]]
        yield pd.DataFrame(rows, columns=["bucket", "parts", "clause", "head", "last"])


def _led_later(rest: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
    """Clauses outside of a block with those of its heads that they come after and are similar
    to; ``more`` for the ones behind the whole block, which later blocks still concern."""
    rows = []
    if len(heads):
        known, last = [(h, pairs(h)) for h in heads["head"]], heads["last"].iloc[0]
        for bucket, clause, led, parts in zip(rest["bucket"], rest["clause"], rest["led"], rest["parts"], strict=True):
            if led or clause > last:
                x = pairs(clause)
                own = [h for h, y in known if h < clause and near(x, y)]
                rows.append((bucket, clause, bool(led or own), parts, clause > last, own))
    return pd.DataFrame(rows, columns=["bucket", "clause", "led", "parts", "more", "heads"])


def head_links(keyed: DataFrame, scratch: Scratch, most: int = BUCKET) -> DataFrame:
    """``clause, head`` of the verified links within buckets (``clause, bucket``).

    The links are those of ``_led``, whatever a bucket's size. A bucket of up to ``most``
    clauses is linked in one go. Larger ones go block by block: the first clauses that
    follow no head yet are linked with each other, then all later clauses, whether they follow
    a head or not, are compared with the new heads, in parts of about ``most``; so no task
    holds a large bucket.
    """
    sizes = scratch.put(keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    few = keyed.join(sizes.filter(F.col("n") <= most).select("bucket"), "bucket").groupBy("bucket").agg(F.collect_list("clause").alias("members")).select("members")

    def link(batches):
        for pdf in batches:
            yield pd.DataFrame([x for m in pdf["members"] for x in _led(list(m))[0]], columns=["clause", "head"])

    out = few.mapInPandas(link, "clause string, head string")
    large = sizes.filter(F.col("n") > most)
    if large.isEmpty():
        return out
    left = scratch.put(keyed.join(large, "bucket").select("bucket", "clause", F.lit(False).alias("led"), F.ceil(F.col("n") / most).cast("int").alias("parts")))
    order = Window.partitionBy("bucket").orderBy("clause")
    part = F.pmod(F.xxhash64("clause"), F.col("parts")).alias("part")
    while True:
        block = left.filter("not led").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= min(most, BLOCK))
        block = block.groupBy("bucket", "parts").agg(F.collect_list("clause").alias("members"))
        block = scratch.put(block.mapInPandas(_led_block, "bucket long, parts int, clause string, head string, last string"))
        if block.isEmpty():
            return out
        out = out.unionByName(block.filter("clause <> head").select("clause", "head"))
        heads = block.filter("clause = head").select("bucket", "head", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"))
        later = left.select("*", part).groupBy("bucket", "part").cogroup(heads.groupBy("bucket", "part"))
        later = scratch.put(later.applyInPandas(_led_later, "bucket long, clause string, led boolean, parts int, more boolean, heads array<string>"))
        out = out.unionByName(scratch.put(later.select("clause", F.explode("heads").alias("head"))))
        scratch.drop(left)
        left = later.filter("more").select("bucket", "clause", "led", "parts")
        left._scratch = later._scratch


def refusal_clauses(opened: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """``clause, size, sure`` of the clusters whose evidence shows a refusal: each clause's
    rows, and whether declining words say so.

    ``opened`` has ``clause`` and ``prompt`` (a digest of the question) of the answers that
    answer nothing, and may have ``hash``, ``declines`` and the ``topic`` of the question;
    ``used`` has ``hash, n``, how often a clause stands in an answer that does answer.
    """
    spark = opened.sparkSession
    scratch = Scratch(spark, "refusals")
    for name, default in (("hash", F.xxhash64("clause")), ("declines", F.col("clause").rlike(r"^(?:我|恕)|无法|不便|不能")), ("topic", F.array().cast("array<bigint>"))):
        opened = opened if name in opened.columns else opened.withColumn(name, default)
    own = opened.groupBy("clause").agg(F.first("hash").alias("hash"), F.max("declines").alias("declines"), F.count("*").alias("size"))
    if used is not None:
        own = own.join(used, "hash", "left")
    own = own.withColumn("beside", F.coalesce("n", F.lit(0)) if used is not None else F.lit(0))
    # What stands mostly beside answers (thanks, greetings) refuses nothing.
    own = scratch.put(own.filter("beside <= size").select("clause", "declines", "size", "beside"))
    keyed = scratch.put(own.select("clause", F.explode(band_keys("clause")).alias("bucket")))
    links = head_links(keyed, scratch).unionByName(own.select("clause", F.col("clause").alias("head"))).distinct()
    links = scratch.put(links)
    asked = scratch.put(opened.select("clause", "prompt", "topic").distinct().join(own.select("clause"), "clause", "left_semi"))
    by = scratch.put(asked.join(links, "clause").select("head", "prompt", "topic").distinct())
    size = by.groupBy("head").agg(F.countDistinct("prompt").alias("prompts"))
    mates = links.join(own, "clause").groupBy("head").agg(F.max("declines").alias("declines"), F.sum("size").alias("rows"), F.sum("beside").alias("beside"))
    heads = scratch.put(size.join(mates, "head"))
    saying = heads.filter(F.col("declines") & (F.col("prompts") >= PROMPTS)).select("head")
    # Without declining words: never beside answers, and no topic holds more than a third of the prompts.
    long_ = F.length("head") >= F.when(F.col("head").rlike(r"^[\x00-\x7f]*$"), 12).otherwise(6)
    open_ = heads.filter(~F.col("declines") & (F.col("prompts") > PROMPTS) & (F.col("beside") * 10 <= F.col("rows")) & long_).select("head", "prompts")
    shared = by.join(open_, "head").select("head", "prompt", "prompts", F.explode("topic").alias("gram")).distinct().groupBy("head", "gram").agg(F.count("*").alias("k"), F.first("prompts").alias("prompts"))
    narrow = shared.filter(F.col("k") * 3 > F.greatest(F.col("prompts"), F.lit(3))).select("head")
    without = open_.select("head").join(narrow.distinct(), "head", "left_anti")
    shown = saying.withColumn("sure", F.lit(True)).unionByName(without.withColumn("sure", F.lit(False)))
    found = links.join(shown, "head").groupBy("clause").agg(F.max("sure").alias("sure"))
    return scratch.put(own.join(found, "clause").select("clause", "size", "sure"))


def defects(df: DataFrame, key: str, question: str, answer: str) -> DataFrame:
    """``<key>, defect`` of every defective pair.

    The rows' texts are read once; what is shuffled are sentence endings (counted on the
    map side), clauses that decline, and one narrow row per unended answer.
    """
    seen = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(question).alias("prompt"), F.xxhash64(answer).alias("text"), examined(F.col(question).cast("string"), F.col(answer).cast("string")).alias("x"))
    seen = Scratch(df.sparkSession, "defects").put(seen.select("key", "prompt", "text", "x.*"))
    # Distinct answers count, not rows: a copied answer is one answer.
    ended = seen.select("text", F.explode("closed").alias("last")).distinct().groupBy("last").agg(F.count("*").alias("ended"))
    opened = seen.filter(F.size("clauses") > 0).select("key", "prompt", "topic", F.size("clauses").alias("total"), F.explode("clauses").alias("x")).select("key", "prompt", "topic", "total", "x.*")
    used = seen.select(F.explode("used").alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))
    refusing = refusal_clauses(opened, used)
    # One surely declining clause is enough; other templates must be all that an answer says.
    held = join_sized(opened.select("key", "total", "clause"), refusing, ["clause"], "size", seen.count())
    held = held.groupBy("key").agg(F.max("sure").alias("sure"), (F.count("*") >= F.max("total")).alias("whole"))
    declining = held.filter("sure or whole").select("key", F.lit(True).alias("declines"))
    left = seen.filter((F.size("clauses") > 0) | F.col("own").isNotNull() | F.col("last").isNotNull()).select("key", "own", "last", "tail")
    unended = left.filter(F.col("own").isNull() & F.col("last").isNotNull()).select("last", "tail").distinct()
    goes_on = seen.select(F.explode("inside").alias("tail")).distinct().withColumn("goes_on", F.lit(True))
    known = unended.join(ended, "last", "left").join(goes_on, "tail", "left")
    known = known.select("last", "tail", (~F.coalesce("goes_on", F.lit(False)) | (F.coalesce("ended", F.lit(0)) >= 2)).alias("complete"))
    # Only open sentences are looked up; the others share one key, which would crowd one task.
    asks = F.col("own").isNull() & F.col("last").isNotNull()
    looked = left.filter(asks).join(known, ["last", "tail"], "left").select("key", "own", "last", "complete")
    settled = left.filter(~asks).select("key", "own", "last", F.lit(None).cast("boolean").alias("complete"))
    all_ = looked.unionByName(settled).join(declining, "key", "left")
    defect = (
        F.when(F.col("own").isin("empty", "copy"), F.col("own"))
        .when(F.col("declines"), F.lit("refusal"))
        .when(F.col("own").isNotNull(), F.col("own"))
        .when(F.col("last").isNotNull() & ~F.coalesce("complete", F.lit(True)), F.lit("truncated"))
    )
    return all_.select(F.col("key").alias(key), defect.alias("defect")).filter("defect is not null").distinct()
