"""Cut near-copies whose evidence is not the longest text of their bucket."""

import random

from pyspark.sql import functions as F

from curatrix.llm import truncation

from .conftest import QA, STEPS


def found(spark, tables, texts):
    d = tables(qa_pairs=([(k, "Why?", v, ("s", None), "en", None, None) for k, v in texts.items()], QA), reasoning_steps=([], STEPS))
    df = truncation.records(spark, d)
    seen = truncation.stored(truncation.examined(df, truncation.Closings.fit(["All is well."])))
    early = truncation.near_copies(seen, df)
    mask = F.col("fp").bitwiseAND(F.lit((1 << 52) - 1))
    both = early.select(mask.alias("fp"))
    return {r[0] for r in seen.withColumn("fp", mask).join(both, "fp", "left_semi").select("record_id").collect()}


def words(r, n):
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def test_longest_text_of_the_bucket_is_no_evidence(spark, tables):
    """s is cut from m; l is similar to s, longer than m, and ends with the closing words of s."""
    r = random.Random(0)
    body, closing, more = words(r, 600), words(r, 7), words(r, 4)
    s = body + closing
    m = s + more
    l = body[:300] + words(r, 8) + body[300:] + closing
    assert len(l) > len(m) > len(s)
    assert truncation.aligned(" ".join(s), " ".join(l)) == (True, False) and truncation.aligned(" ".join(s), " ".join(m)) == (True, True)
    assert "s" in found(spark, tables, {"s": " ".join(s), "m": " ".join(m), "l": " ".join(l)})


def test_long_texts_keep_their_order(spark, tables):
    """Beyond 2047 words the longer text of a pair is still the longer one."""
    r, texts = random.Random(2), {}
    for i in range(8):
        w = words(r, 2300)
        texts[f"whole{i}"], texts[f"cut{i}"] = " ".join(w), " ".join(w[: 2150 + i])
    assert found(spark, tables, texts) == {f"cut{i}" for i in range(8)}


def test_hashes_are_whole_beside_texts_that_have_none(spark, tables):
    """Texts too short for shingles, in the same batch, leave the sketches and closing words of the others as they are."""
    r = random.Random(0)
    body, closing, more = words(r, 600), words(r, 7), words(r, 4)
    texts = {"s": body + closing, "m": body + closing + more, "l": body[:300] + words(r, 8) + body[300:] + closing}
    texts = {k: " ".join(v) for k, v in texts.items()} | {f"short{i}": f"All is {w}" for i, w in enumerate(words(r, 200))}
    assert "s" in found(spark, tables, texts)
    d = tables(qa_pairs=([(k, "Why?", v, ("s", None), "en", None, None) for k, v in texts.items()], QA), reasoning_steps=([], STEPS))
    got = {x.record_id: x for x in truncation.examined(truncation.records(spark, d), truncation.Closings.fit(["All is well."])).collect()}
    mult = truncation.np.random.default_rng(7).integers(1, 1 << 32, truncation.SKETCH, dtype=truncation.np.uint32) | truncation.np.uint32(1)
    for k in "sml":
        _, _, sketch, *_, tail, _ = truncation.sign([texts[k]], mult)
        assert (got[k].sketch, got[k].tail) == (sketch[0], tail[0])
    assert all(got[k].sketch is None and got[k].n == 0 for k in got if k.startswith("short"))
