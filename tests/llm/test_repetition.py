"""Sentences said again, and levels of groups that differ."""

import numpy as np

from curatrix.llm import repetition

from .conftest import QA

OBF = "obf_id string, qa_id string, obfuscated_answer string, language string, text string"


def brute(text):
    """Share of the letters of whole sentences said before (sentences here are shorter than a run)."""
    seen, inside, n = set(), 0, 0
    for part in text.replace("。", ".").split("."):
        t = "".join(c for c in part.lower() if c.isalnum())
        inside += len(t) if t in seen and len(t) >= 2 else 0
        n += len(t)
        seen.add(t)
    return inside / max(n, 1)


def test_short_sentences_said_again():
    texts = ["Restart the pump. Restart the pump.", "是的。是的。是的。", "Stop it. Check the fan. Stop it! Wait. STOP IT.", "One two. Three four.", "1.5 mm. 1.5 mm.", ""]
    want = [0.5, 2 / 3, brute("Stop it. Check the fan. Stop it. Wait. Stop it."), 0.0, 0.5, 0.0]
    assert np.allclose(repetition.shares(texts), want)
    assert repetition.shares(["Do this: 1) close the lid 2) close the lid"])[0] > 0.3
    long = "Restart the pump number %d now. " * 300 % tuple(range(300))
    assert repetition.shares([long])[0] < 1 and len(repetition.shares([])) == 0


def test_levels_decide(spark, tables):
    """The same share stands out in a group where nothing repeats, and not in one where everything does."""
    half = "Restart the pump now. Restart the pump now. Nothing else was said in this report."
    rows = [(f"a{i}", None, f"Value {i} was read once.", ("calm", None), "English", None, None) for i in range(30)] + [("a", None, half, ("calm", None), "en-US", None, None)]
    rows += [(f"b{i}", None, half if i % 2 else "Go on. Go on. Go on. Go on.", ("loud", None), "en", None, None) for i in range(30)]
    d = tables(qa_pairs=(rows + rows, QA), obfuscated_qa=([("o", "a", half, "x", None), ("p", "none", None, None, None)], OBF))
    levels = {(r.table_name, r.language, r.source): r for r in repetition.levels(spark, d).collect()}
    assert levels["qa_pairs", "en", "calm"].threshold == 0 and levels["qa_pairs", "en", "calm"].n_texts == 31
    assert levels["qa_pairs", "en", "loud"].threshold > 1 and ("obfuscated_qa", "en", "calm") in levels
    assert {r.record_id for r in repetition.outstanding(spark, d).collect()} == {"a", "o"}
    for r in levels.values():  # quantiles of small groups are exact
        own = sorted(x.repeated_share for x in repetition.once(repetition.measured(spark, d), "table_name", "record_id").where(f"source = '{r.source}' and table_name = '{r.table_name}'").collect())
        q = [own[max(int(np.ceil(p * len(own))) - 1, 0)] for p in (0.25, 0.75)]
        assert abs(r.threshold - (q[1] + 3 * (q[1] - q[0]))) < 1e-6
