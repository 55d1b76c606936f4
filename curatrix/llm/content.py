"""What an answer says: nothing, its question again, or something."""

from __future__ import annotations

import re
import unicodedata

#: What stands for "nothing" in exports.
NOTHING = set("null none nil na n/a nan undefined empty blank tbd todo 无 空 暂无 没有 keine leer aucun aucune vide ninguno ninguna vacío".split())
#: Labels that may stand before a copied question.
_PREFIX = re.compile(r"^\s*(?:q|question|frage|pregunta|问题|问|prompt|user|a|answer|antwort|réponse|respuesta|答案|答)\s*[:：]\s*", re.I)


#: So many letters or digits are more than any word that stands for nothing has.
_ENOUGH = re.compile(r"(?:[\W_]*[^\W_]){14}")
HEAD = 64
#: First characters that no normal form makes another letter or digit of.
_PLAIN = re.compile("[A-Za-z0-9㐀-鿿]")


def is_empty(answer: str | None) -> bool:
    """Null, or nothing that says anything: no letter or digit, or a word that stands for nothing."""
    if answer is None:
        return True
    if _ENOUGH.match(answer):
        return False
    core = re.sub(r"^[\W_]+|[\W_]+$", "", unicodedata.normalize("NFKC", answer)).casefold()
    return core == "" or core in NOTHING


def bare(text: str) -> str:
    """Letters and digits of a text in one form of width and case."""
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFKC", text).casefold())


def same(a: str, b: str) -> bool:
    """Whether two texts have the same letters and digits (``bare``); texts that begin differently are not read on."""
    if _PLAIN.match(a) and _PLAIN.match(b) and a[0].lower() != b[0].lower():
        return False
    x, y = bare(a[:HEAD])[:-4], bare(b[:HEAD])[:-4]  # the last letters of a cut may combine with what follows
    n = min(len(x), len(y))
    return x[:n] == y[:n] and bare(a) == bare(b)


def copies(question: str | None, answer: str) -> bool:
    """The answer is the question and nothing else, apart from case, width, spacing, punctuation and a label before it."""
    if not question or not (same(question, answer) or ((m := _PREFIX.match(answer)) and same(question, answer[m.end() :]))):
        return False
    return bare(question) != ""
