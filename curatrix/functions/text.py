"""Text functions as column expressions: they stay in the JVM and inside whole-stage code generation.

All map null to null and accept empty and very long texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatrix.plans.base import TOKEN

#: Patterns of addresses and numbers, and punctuation that is kept.
URL = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
LINK = r"https?://[^\s]+"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
MOBILE = r"1[3-9]\d{9}"
IPV4 = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
IDENTITY = r"\b\d{17}[\dXx]\b"
KEPT = "，。！？、；：（）《》"
CJK = "[一-鿿]"
STOPWORDS = tuple("的 了 在 是 我 有 和 就 不 人 都 一 个 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 这 那 什么 吗 呢 吧 啊 the a an and or but in on at to for of with by from is are was were be been this that it".split())


def let(value: Column, use) -> Column:
    """``use`` applied to ``value``, which is computed once even where it is used inside a lambda."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def replaced(c: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, by in pairs:
        c = F.regexp_replace(c, pattern, by)
    return c


def trimmed(c: Column) -> Column:
    """Without white space (not only blanks) at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def preprocess(c: Column) -> Column:
    """Form in which documents are compared: no tags, links, addresses or punctuation, single blanks, lower case.

    Addresses are sought from word starts only: the same matches, but linear in long runs without blanks.
    """
    return F.lower(trimmed(replaced(c, ("<[^>]+>", ""), (URL, ""), (r"(?<!\S)\S+@\S+", ""), (r"[^一-龥a-zA-Z0-9\s]", " "), (r"\s+", " "))))


def clean(c: Column, html: bool = True, urls: bool = True, whitespace: bool = True, special: bool = True) -> Column:
    """Cleaning by flags; white space between two CJK characters goes (non-overlapping matches, so one gap may stay)."""
    if html:
        c = F.regexp_replace(c, "<.*?>", "")
    if urls:
        c = F.regexp_replace(c, URL, "")
    if whitespace:
        c = replaced(c, (r"\s+", " "), (r"([一-龥])\s+([一-龥])", "$1$2"))
    if special:
        c = F.regexp_replace(c, rf"[^一-龥a-zA-Z0-9{KEPT}\s]", "")
    return trimmed(c)


def keep_punctuation(c: Column) -> Column:
    return trimmed(replaced(c, (r"\s+", " "), (r"[^\p{L}\p{N}_\s。，、；：？！“”‘’（）《》【】…—·]", "")))


def normalize_spaces(c: Column) -> Column:
    """Wide and no-break spaces become blanks, runs of blanks one, runs of blank lines one."""
    return trimmed(replaced(c, ("[  -   　]", " "), ("[ \t]+", " "), (r"\n\s*\n+", "\n\n")))


def remove_special(c: Column, keep: str = "") -> Column:
    return F.regexp_replace(c, rf"[^a-zA-Z0-9一-鿿\s{keep}]", "")


#: Numerals in the order in which they are replaced, one by one (not positional arithmetic).
NUMERALS = (("零", "0"), ("一", "1"), ("二", "2"), ("三", "3"), ("四", "4"), ("五", "5"), ("六", "6"), ("七", "7"), ("八", "8"), ("九", "9"), ("十", "10"), ("百", "100"), ("千", "1000"), ("万", "10000"))


def normalize_numerals(c: Column) -> Column:
    for a, b in NUMERALS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def mask(c: Column) -> Column:
    """Addresses, mobile numbers (without word edges, so part of a longer number may go), IPv4 and identity numbers, in this order."""
    return replaced(c, (EMAIL, "[EMAIL]"), (MOBILE, "[PHONE]"), (IPV4, "[IP]"), (IDENTITY, "[ID]"))


def found(c: Column, pattern: str) -> Column:
    """All matches, in order."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def links(c: Column) -> Column:
    return F.array_sort(F.array_distinct(found(c, LINK)))


def fenced(c: Column) -> Column:
    """Bodies of fenced code blocks."""
    return F.regexp_extract_all(c, F.lit(r"(?s)```\w*\n(.*?)```"), F.lit(1))


def truncate(c: Column, size: int, suffix: str = "...", at_blank: bool = False) -> Column:
    """At most ``size`` characters with the suffix; at_blank goes back to the last blank if that keeps more than 0.8 of the size."""
    if not at_blank:
        return F.when(F.length(c) <= size, c).otherwise(F.concat(F.substring(c, 1, size), F.lit(suffix)))
    head = F.substring(c, 1, size - len(suffix))
    blank = F.length(head) - F.locate(" ", F.reverse(head))  # characters before the last blank
    cut = F.when((F.locate(" ", head) > 0) & (blank > 0.8 * size), F.substring(head, F.lit(1), blank)).otherwise(head)
    return F.when(F.length(c) <= size, c).otherwise(F.concat(cut, F.lit(suffix)))


def render(template: Column, variables: Column) -> Column:
    """${name} replaced from a map; unknown names stay."""
    return F.aggregate(F.map_entries(variables), template, lambda t, e: F.replace(t, F.concat(F.lit("${"), e["key"], F.lit("}")), e["value"]))


def file_size(c: Column) -> Column:
    units = ("B", "KB", "MB", "GB", "TB")
    out = F.format_string("%.2f PB", c / 1024.0**5)
    for i in reversed(range(len(units))):
        out = F.when(c < 1024.0 ** (i + 1), F.format_string(f"%.2f {units[i]}", c / 1024.0**i)).otherwise(out)
    return out


def normalize_model(c: Column, prefix: str) -> Column:
    """Single blanks; the brand prefix is joined to the model by one hyphen; a text that starts with it is upper case."""
    t = F.regexp_replace(trimmed(F.regexp_replace(c, r"\s+", " ")), rf"(?i){prefix}\s*-?\s*", f"{prefix}-")
    return F.when(t.rlike(rf"^(?i){prefix}-"), F.upper(t)).otherwise(t)


#: Measured quantities, by kind.
QUANTITIES = {
    "unit": r"(\d+(?:\.\d+)?)\s*(kWh|Hz|mm|ms|mA|dB|µm|°C|cd/m²|W|V|毫米|毫秒|微米|分贝|摄氏度|赫兹|千瓦时|瓦|伏|尼特)",
    "percentage": r"(\d+(?:\.\d+)?)\s*(%|％|percent|个百分点)",
    "resolution": r"(\d+)\s*[xX×]\s*(\d+)",
    "ratio": r"(\d+)\s*[:：]\s*(\d+)",
}


def _quantity(kind: str, p: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), p["value"].alias("value"), p["unit"].alias("unit"))


def quantities(c: Column) -> Column:
    """array<struct<kind, value, unit>> of all measured quantities, kind by kind."""
    parts = []
    for kind, pattern in QUANTITIES.items():
        pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)).alias("value"), F.regexp_extract_all(c, F.lit(pattern), F.lit(2)).alias("unit"))
        parts.append(F.transform(pairs, partial(_quantity, kind)))
    return F.concat(*parts)


def key_terms(c: Column, dictionary: Sequence[str]) -> Column:
    """Capital abbreviations, hyphenated words and dictionary terms contained in the text, distinct and sorted."""
    listed = F.filter(F.array(*[F.lit(x) for x in dictionary]), lambda t: F.contains(c, t))
    return F.array_sort(F.array_distinct(F.concat(found(c, r"[A-Z]+(?:\s+[A-Z]+)*"), found(c, "[a-zA-Z]+-[a-zA-Z]+"), listed)))


def contained(c: Column, terms: Sequence[str]) -> Column:
    """Those of the given terms that occur in the text."""
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t))


def any_of(c: Column, terms: Sequence[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(c, F.lit(t))
    return out


def tokens(c: Column) -> Column:
    """Default tokenizer (see the plug-ins in curatrix.functions.models): words and numbers in lower case, CJK by character."""
    return found(F.lower(c), TOKEN)


def sentences(c: Column, ends: str = "[。！？；\n]+", least: int = 1) -> Column:
    return F.filter(F.transform(F.split(c, ends), trimmed), lambda s: F.length(s) >= least)


def with_stops(c: Column) -> Column:
    """Sentences with their stop."""
    return found(c, "[^。！？]+[。！？]?")


def ngrams(tokens_: Column, n: int, sep: str = "") -> Column:
    """Joined runs of n tokens; none if there are fewer."""

    def runs(t: Column) -> Column:
        last = F.size(t) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(t, i, n), sep))).otherwise(F.array().cast("array<string>"))

    return let(tokens_, runs)


def language(c: Column) -> Column:
    """zh if there are more CJK than Latin characters, else en."""
    return F.when(F.regexp_count(c, F.lit(CJK)) > F.regexp_count(c, F.lit("[a-zA-Z]")), "zh").otherwise("en")


def share(c: Column, pattern: str) -> Column:
    return F.when(F.length(c) > 0, F.regexp_count(c, F.lit(pattern)) / F.length(c)).otherwise(0.0)


def fixed_chunks(c: Column, size: int, overlap: int = 0) -> Column:
    """Chunks of ``size`` characters at a fixed stride."""
    if overlap >= size:
        raise ValueError("overlap must be smaller than the chunk")
    return F.when(F.length(c) > 0, F.transform(F.sequence(F.lit(0), F.length(c) - 1, F.lit(size - overlap)), lambda i: F.substring(c, i + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def paragraph_chunks(c: Column, size: int) -> Column:
    """Paragraphs packed greedily, in order, into chunks of under ``size`` characters; a longer paragraph is a chunk of its own. One linear fold."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        fits = (acc["open"] == "") | (F.length(acc["open"]) + F.length(p) + 2 <= size)
        joined = F.when(acc["open"] == "", p).otherwise(F.concat(acc["open"], F.lit("\n\n"), p))
        return F.struct(F.when(fits, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))).alias("done"), F.when(fits, joined).otherwise(p).alias("open"))

    end = lambda a: F.when(a["open"] != "", F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"])
    return F.aggregate(F.filter(F.split(c, r"\n\s*\n"), lambda p: trimmed(p) != ""), start, step, end)


def merged_fragments(c: Column, least: int = 20) -> Column:
    """Sentences of Latin text; a fragment shorter than ``least`` joins the one before it."""
    parts = F.filter(F.split(c, r"(?<=[.!?])\s+"), lambda s: F.length(s) > 0)

    def step(acc: Column, s: Column) -> Column:
        join = (F.size(acc) > 0) & (F.length(s) < least)
        return F.when(join, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat_ws(" ", F.element_at(acc, -1), s)))).otherwise(F.concat(acc, F.array(s)))

    return F.when(F.size(parts) > 0, F.aggregate(F.slice(parts, 2, 1_000_000_000), F.slice(parts, 1, 1), step)).otherwise(parts)


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays, as sets; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def content_words(c: Column, stop: Sequence[str] = STOPWORDS) -> Column:
    """Distinct tokens of more than one character that are no stop words."""
    return F.filter(F.array_except(tokens(c), F.array(*[F.lit(s) for s in stop])), lambda t: F.length(t) > 1)


def _without(a: Column, b: Column) -> Column:
    return F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))


def merge_maps(maps: Sequence[Column]) -> Column:
    """Maps merged, the last value of a key winning, whatever the session's policy for doubled keys."""
    out = maps[0]
    for m in maps[1:]:
        out = F.map_concat(_without(out, m), m)
    return out


def flatten(schema, prefix: str = "", sep: str = "_") -> Mapping[str, str]:
    """Paths of all leaves of a nested schema, by flat name: to be selected."""
    out: dict[str, str] = {}
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        if hasattr(f.dataType, "fields"):
            out |= flatten(f.dataType, path, sep)
        else:
            out[path.replace(".", sep)] = path
    return out
