"""Rule checks as column expressions. Null texts give null results unless a rule says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

#: Unwanted words, question words, and what answers of some kinds of question say.
SENSITIVE = ("违法", "暴力", "色情", "赌博", "诈骗", "反动", "邪教", "恐怖", "毒品", "枪支")
QUESTION_WORDS = ("什么", "为什么", "怎么", "如何", "哪", "谁", "何时", "多少")
QUESTION_TYPES = (
    ("what", ("什么", "何", "what")),
    ("why", ("为什么", "为何", "why")),
    ("how", ("怎么", "如何", "how")),
    ("when", ("什么时候", "何时", "when")),
    ("where", ("哪里", "何处", "where")),
    ("who", ("谁", "who")),
    ("which", ("哪个", "哪些", "which")),
    ("yesno", ("吗", "是否", "是不是", "有没有")),
)
REASONS, WAYS = ("因为", "由于", "原因"), ("步骤", "方法", "首先", "然后")
#: Length limits of questions and answers.
QUESTION_LENGTH, ANSWER_LENGTH = (10, 200), (20, 2000)
REPEATED_CHAR = r"(.)\1{4,}"
REPEATED_WORD = r"(?i)\b(\w+)\s+\1\b"


def length_ok(c: Column, limits: tuple[int, int]) -> Column:
    return F.length(c).between(*limits)


def repeats(c: Column) -> Column:
    """Five equal characters in a row, a doubled word, or a doubled sentence."""
    s = T.sentences(c, "[。！？.!?]")
    return c.rlike(REPEATED_CHAR) | c.rlike(REPEATED_WORD) | (F.size(s) > F.size(F.array_distinct(s)))


def language_ok(c: Column, primary: str) -> Column:
    return (T.share(c, T.CJK) if primary == "zh" else T.share(c, "[a-zA-Z]")) > 0.5


def mixed(c: Column) -> Column:
    return (T.share(c, T.CJK) > 0.1) & (T.share(c, "[a-zA-Z]") > 0.1)


def ends_properly(c: Column) -> Column:
    """The last visible character is a stop; text of white space only ends properly, empty text does not."""
    last = F.substring(F.regexp_replace(c, r"\s+$", ""), -1, 1)
    return F.when(F.length(c) == 0, False).otherwise((last == "") | last.isin(*"。！？.!?"))


def diversity(c: Column) -> Column:
    """Negated Simpson index of the characters: minus the sum of their squared shares."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")

    def simpson(x: Column) -> Column:
        counts = F.transform(F.array_distinct(x), lambda u: F.size(F.filter(x, lambda y: y == u)))
        return -F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, n: a + n.cast("bigint") * n) / (F.size(x).cast("bigint") * F.size(x))

    return F.when(F.length(c) > 0, T.let(chars, simpson)).otherwise(0.0)


def question_type(c: Column) -> Column:
    """The first kind whose words occur; later kinds are hidden by earlier ones that share characters."""
    out = F.lit("unknown")
    for kind, words in reversed(QUESTION_TYPES):
        out = F.when(T.any_of(F.lower(c), words), kind).otherwise(out)
    return out


def addressed(question: Column, answer: Column) -> Column:
    kind = question_type(question)
    return F.when((kind == "why") & ~T.any_of(answer, REASONS), 0.7).when((kind == "how") & ~T.any_of(answer, WAYS), 0.7).when((kind == "yesno") & (F.length(answer) > 100), 0.8).otherwise(1.0)


def relation_warnings(question: Column, answer: Column) -> Column:
    """Short answer, little overlap of words, or a question answered in under twenty characters."""
    q, a = F.array_distinct(T.tokens(question)), T.tokens(answer)
    stop = F.array(*[F.lit(s) for s in T.STOPWORDS])
    overlap = F.when(F.size(q) > 0, F.size(F.array_except(F.array_intersect(q, a), stop)) / F.size(q)).otherwise(0.0)
    return F.array_compact(F.array(F.when(F.length(answer) < 0.5 * F.length(question), "short"), F.when(overlap < 0.1, "overlap"), F.when(T.any_of(question, QUESTION_WORDS) & (F.length(answer) < 20), "simple")))


def issues(question: Column, answer: Column) -> Column:
    """What makes a pair fail."""
    return F.array_compact(F.array(F.when(~length_ok(question, QUESTION_LENGTH), "question_length"), F.when(~length_ok(answer, ANSWER_LENGTH), "answer_length"), F.when(question.rlike(rf"\b{T.MOBILE}\b") | answer.rlike(rf"\b{T.MOBILE}\b"), "phone"), F.when(question.rlike(T.IDENTITY) | answer.rlike(T.IDENTITY), "identity"), F.when(T.any_of(F.lower(F.concat(question, answer)), SENSITIVE), "words")))


def rule_score(question: Column, answer: Column, primary: str = "zh") -> Column:
    """0.3 for a failed pair; else 1 less 0.2 an issue, 0.05 a warning, and deductions for punctuation, ending and language, within 0..1."""
    score = 1.0 - 0.05 * F.size(relation_warnings(question, answer))
    score = score - F.when(question.rlike("[。！？，、；：.!?,;:]"), 0.0).otherwise(0.05) - F.when(ends_properly(answer), 0.0).otherwise(0.05)
    score = score - F.when(language_ok(question, primary), 0.0).otherwise(0.1) - F.when(language_ok(answer, primary), 0.0).otherwise(0.1)
    return F.when(F.size(issues(question, answer)) > 0, 0.3).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def validation_errors(question: Column, answer: Column) -> Column:
    """missing, short, long, identical and letterless fields; nulls are missing."""
    q, a = T.trimmed(F.coalesce(question, F.lit(""))), T.trimmed(F.coalesce(answer, F.lit("")))
    letter = r"[a-zA-Z一-鿿]"
    return F.array_compact(F.array(F.when(question.isNull(), "question_missing"), F.when(answer.isNull(), "answer_missing"), F.when(F.length(q) < 5, "question_short"), F.when(F.length(a) < 10, "answer_short"), F.when(F.length(q) > 500, "question_long"), F.when(F.length(a) > 5000, "answer_long"), F.when(q == a, "identical"), F.when(~q.rlike(letter), "question_letterless"), F.when(~a.rlike(letter), "answer_letterless")))


def identifier(c: Column, size: int = 30) -> Column:
    """Node identifier of a name: lower case, underscores, at most ``size`` characters, never starting with a digit, never empty."""
    t = F.substring(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "_"), 1, size)
    return F.when(F.regexp_replace(t, "_", "") == "", "entity").when(t.rlike("^[0-9]"), F.concat(F.lit("e_"), t)).otherwise(t)
