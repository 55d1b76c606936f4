"""Plug-ins where outside models may be set: tokenizer, encoder and judge, with deterministic defaults that need no model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from . import rules, text

#: Tokens of the tokenizer "pairs": words, and CJK text in pairs of characters, as most of its words are.
PAIRS = "[a-z0-9]+|[一-鿿]{2}|[一-鿿]"
#: Endings of verbs, for the default tagger.
VERB_ENDS = "(造|作|理|测|查|修|护|产|ates|ated|ures|ured|aces|aced|eeds|ept)$"
TOKENIZERS: dict[str, Callable[[Column], Column]] = {"default": text.tokens, "pairs": lambda c: text.found(F.lower(c), PAIRS)}


def by_ending(tokens: Column) -> Column:
    """array<struct<token, tag>>: v for words with a verb's ending, n for other words of two or more letters, x for the rest."""
    kind = lambda t: F.when(t.rlike(VERB_ENDS), "v").when((F.length(t) > 1) & ~t.rlike("^[0-9]+$"), "n").otherwise("x")
    return F.transform(tokens, lambda t: F.struct(t.alias("token"), kind(t).alias("tag")))


TAGGERS: dict[str, Callable[[Column], Column]] = {"default": by_ending}
ENCODERS: dict[str, Callable[[Column], Column]] = {}
JUDGES: dict[str, Callable[[Column, Column], Column]] = {"rules": rules.rule_score}


def register(kind: dict, name: str, make: Callable) -> None:
    """Sets a plug-in: a function from columns to a column (a built-in expression or a pandas UDF)."""
    kind[name] = make


def hashed_encoder(size: int = 64) -> Callable[[Column], Column]:
    """Bag of hashed words with unit length (all zeros for a text without words), in Arrow batches."""

    @F.pandas_udf(ArrayType(FloatType()))
    def encode(words: pd.Series) -> pd.Series:
        import zlib

        out = []
        for ws in words:
            v = np.zeros(size, dtype=np.float32)
            for w in ws if ws is not None else ():
                h = zlib.crc32(w.encode())
                v[h % size] += 1 if h & 0x10000 else -1
            n = float(np.sqrt((v * v).sum()))
            out.append(v / n if n else v)
        return pd.Series(out)

    return lambda c: encode(text.tokens(c))


ENCODERS["default"] = hashed_encoder()
