"""Public tokenizers: the vocabulary file's path is a parameter, nothing is copied."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark.sql.functions import pandas_udf

#: The multilingual byte-level vocabulary: of the public ones it needs the fewest tokens for texts in the five languages, and the least time.
DEFAULT_VOCABULARY = os.environ.get("CURATRIX_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the usual splitting pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def load(path: str = DEFAULT_VOCABULARY):
    """A function from a list of texts to their token counts."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(coder.encode_ordinary(t)) for t in texts]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in t.encode_batch(list(texts), add_special_tokens=False)]
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in s.encode(list(texts), num_threads=1)]


def counter(path: str = DEFAULT_VOCABULARY):
    """A pandas UDF from text to its number of tokens (null: 0)."""
    @pandas_udf("int")
    def n_tokens(texts: pd.Series) -> pd.Series:
        return pd.Series(load(path)(texts.fillna("").tolist()), dtype="int32")

    return n_tokens
