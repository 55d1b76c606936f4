"""Whole texts are read: evidence far from the end, deep cuts, and texts that are no cases."""

import random

from curatrix.llm import truncation

from .conftest import QA, STEPS
from .test_near_copies import words

MODEL = truncation.Closings.fit(["The pump was replaced. The fan kept its speed.", "- check the fan\n- log the value"] * 20)


def cut(t):
    e = truncation.doubt(t, MODEL)
    return e is not None and (e[0] or e[1] < 0.5)


def test_evidence_far_from_the_end():
    assert cut("-" * 45 + "\nThe pump was replaced (see the")
    assert cut("The pump was replaced (see the list of parts " + "and the list of parts " * 20 + "here.")
    assert not cut("The pump was replaced (see the list) " + "and the list of parts " * 20 + "here.")
    assert truncation.last_sentence("Well.\n3. set it to 3.47 V " + "and more " * 60).startswith("- set it to 3.47 V")
    assert truncation.last_sentence("One. Two is 3.5 and on") == " Two is 3.5 and on"


def test_nothing_and_copied_questions_are_no_cases(spark, tables):
    rows = [("a", "Why was it replaced", "N/A"), ("b", "Why was it replaced", "why was it replaced"), ("c", "Why?", "The pump was repl"), ("d", "Why?", "null"), ("e", None, None)]
    d = tables(qa_pairs=([(i, q, a, ("s", None), "en", None, None) for i, q, a in rows], QA), reasoning_steps=([], STEPS))
    df = truncation.records(spark, d)
    assert {r.record_id for r in truncation.cut_records(df, MODEL).collect()} == {"c"}


def test_deep_cuts(spark, tables):
    """A copy that lost two thirds of its twin is no near-copy, but contained in it and continued there; a beginning shared by chance is no evidence."""
    r, texts = random.Random(5), {}
    for i in range(6):
        w = words(r, 300)
        texts[f"whole{i}"] = " ".join(w) + "."
        texts[f"cut{i}"] = " ".join(w[: 90 + i])
        texts[f"other{i}"] = " ".join(w[:40] + words(r, 60)) + "."
    d = tables(qa_pairs=([(k, "Why?", v, ("s", None), "en", None, None) for k, v in texts.items()], QA), reasoning_steps=([], STEPS))
    df = truncation.records(spark, d)
    model = truncation.Closings.fit([" ".join(t.split()[:-1]) + "." for t in texts.values() if t[-1] != "."] + ["- " + t + "\n" for t in texts.values()])
    seen = truncation.stored(truncation.examined(df, model))
    # closing words alone do not show the cut here
    early = truncation.near_copies(seen.withColumn("marked", truncation.F.lit(False)).withColumn("p_end", truncation.F.lit(0.9)), df)
    assert {x[0] for x in seen.join(early, "fp", "left_semi").select("record_id").collect()} == {f"cut{i}" for i in range(6)}


def test_aligned():
    r = random.Random(1)
    w = words(r, 100)
    assert truncation.aligned(" ".join(w[:90]), " ".join(w)) == (True, True)
    assert truncation.aligned(" ".join(w[:30]), " ".join(w)) == (False, False)
    assert truncation.aligned(" ".join(w[:30]), " ".join(w), True) == (False, True)
    assert truncation.aligned(" ".join(w[:30]), " ".join(w[:30]) + ". " + " ".join(w[30:]), True) == (False, False)  # a sentence ends there
    assert truncation.aligned("", "a b") == (False, False) == truncation.aligned(" ".join(w), " ".join(w))
