"""Text problems on small fixtures: truncation, residue, pairs, language, repetition."""

import numpy as np
import pytest

from curatrix.llm import chargrams, language, pairs, repetition, residue, truncation

from .conftest import QA, STEPS

DONE = ["The limit for panel bow is %d mm, while the heat pump tolerates %d mm.", "与样品A%d相比，这台设备在除霜控制阶段少用了%d千瓦时。", "Engineers measured %d ms for cycle time after %d hours of wet etching."]


def prose(n):
    return [DONE[i % 3] % (i + 3, i * 7 + 11) for i in range(n)]


def test_rolling_equals_brute_force():
    text = "abcabcabc 中文中文"
    cp, _ = chargrams.codepoints([text])
    for k in (1, 2, 3, 5, 7):
        h = chargrams.rolling(cp, k)
        for i in range(len(h)):
            for j in range(len(h)):
                assert (h[i] == h[j]) == (text[i : i + k] == text[j : j + k])


def test_doubt():
    model = truncation.Closings.fit(prose(300))
    cut = lambda t: (lambda e: e is not None and (e[0] or e[1] < 0.5))(truncation.doubt(t, model))
    assert cut("The limit for panel bow is 5 mm, while the heat pu")
    assert cut("The limit for panel bow is 5 mm, while the heat pump tolerates 3.")
    assert cut("与样品A5相比，这台设备在除霜控制阶段少用了36")
    assert cut("Engineers measured 7 ms…") and cut("“Engineers measured 7 ms for cycle time after 3 hours of wet etching.")
    assert cut("Done.\n```\nset A 5") and cut("Done.\n| A5 | 6")
    assert not cut("The limit for panel bow is 5 mm, while the heat pump tolerates 9 mm")
    for t in ("", "   ", "41.6 mm", "J73-5333", "All is well.", "All is well. ✓", "All. [3]", "a\n```\nx\n```"):
        assert not cut(t)


def test_truncation_of_tables(spark, tables):
    whole = " ".join(prose(9)[::3] + ["A second team replaced the motor of the washer, and every value it wrote down was lower than before."])
    rows = [(f"q{i}", "Why?", t, ("s", None), "en", None, "clash") for i, t in enumerate(prose(120))]
    rows += [("copy", "Why?", whole, ("s", None), "en", None, None), ("early", "Why?", whole[: whole.rindex(" and every")] + ".", ("s", None), "en", None, None)]
    rows += [("cut", "Why?", "The limit for panel bow is 5 mm, while the he", ("s", None), "en", None, None)] * 2 + [("null", None, None, None, None, None, None)]
    d = tables(qa_pairs=(rows, QA), reasoning_steps=([("t", 1, "Engineers measured 5 ms for cycle ti", None, "x"), ("t", 2, None, "a", "x")], STEPS))
    found = {tuple(r) for r in truncation.found(spark, d).collect()}
    assert found == {("qa_pairs", "cut", 0), ("qa_pairs", "early", 0), ("reasoning_steps", "t", 1)}
    rates = {r.table_name: r for r in truncation.source_rates(spark, d).where("source = 's' or table_name = 'reasoning_steps'").collect()}
    assert rates["qa_pairs"].n_cut == 2 and rates["qa_pairs"].n_records == 123


def test_empty_tables(spark, tables):
    d = tables(qa_pairs=([], QA), reasoning_steps=([], STEPS), dataset_entries=([], "entry_id string, obfuscated_question string"), obfuscated_qa=([], "obf_id string, obfuscated_answer string"))
    for f in (truncation.found, residue.found, pairs.found, language.found, repetition.found):
        assert f(spark, d).count() == 0


def test_residue_on_held_out_notices():
    questions = [f"How does the {p} influence {m} above {i} mm?" for i, (p, m) in enumerate([("pump", "noise"), ("door", "bow"), ("filter", "yield")] * 40)] + [f"如果{p}维持在{i}摄氏度，噪声会发生什么变化？" for i, p in enumerate(["热泵", "风道", "电源"] * 40)]
    model = residue.Residue.fit(questions)
    bad = ["Please turn on JavaScript in your browser to view this page", "错误404：页面不存在。", "Insert the question text here", "How does the {{part}} influence noise above 3 mm?", "如果${实体}维持在3摄氏度，噪声会发生什么变化？", "test test test 7"]
    good = [*questions[:4], "", "How does the door influence yield above 404 mm?"]
    cover, slots = model.measure(bad + good)
    assert ((cover >= residue.COVER) | slots).tolist() == [True] * len(bad) + [False] * len(good)


@pytest.mark.parametrize("answer", [None, "", " \n", "N/A", "null", "—", "。", "<empty>", "无", "​"])
def test_empty_answers(answer):
    assert pairs.is_empty(answer)


def test_copies():
    assert pairs.copies("Which steps lower the noise to 3 dB?", "Q: WHICH steps lower the noise to 3 dB")
    assert not pairs.copies("Which steps lower the noise?", "Which steps lower the noise? Wet etching lowers it.")
    assert not pairs.copies(None, "x") and not pairs.copies("?", "?")


def test_pair_defects(spark, tables):
    good = [(f"g{i}", "How does the heat pump influence panel bow?", t, ("s", None), "en", None, None) for i, t in enumerate(prose(90)[::3])] + [(f"z{i}", "除霜控制如何影响这台设备？", t, ("s", None), "zh", None, None) for i, t in enumerate(prose(90)[1::3])]
    bad = [("b1", "How?", None, None, None, None, None), ("b2", "How does the heat pump work?", "Heat pump how does", None, "en", None, None), ("b3", "How does the heat pump work?", "I'm sorry, but I am not able to answer this question.", None, "en", None, None), ("b4", "How does the heat pump influence panel bow?", prose(2)[1], None, "en", None, None)]
    bad[1] = ("b2", "How does the heat pump work?", "how does the heat pump work", None, "en", None, None)
    got = dict(map(tuple, pairs.found(spark, tables(qa_pairs=(good + bad + bad, QA))).collect()))
    assert got == {"b1": "empty_answer", "b2": "copies_question", "b3": "refusal", "b4": "other_language"}


def test_labels():
    assert [language.label_of(x) for x in ("zh-CN", "zh_Hans", "Deutsch", "FR", "spa", "English", None, "", "und", "??")] == ["zh", "zh", "de", "fr", "es", "en", None, None, None, None]


def test_languages_of_held_out_text():
    rows = [(s, g) for g, t in language.SENTENCES.items() for s in t.replace("?", "?|").replace(".", ".|").split("|") if s.strip()]
    model = language.Machines.train(rows)
    assert [x[1] for x in model.languages("Der Motor wurde im Werk geprüft. The motor was checked before the test. 操作员检查了电源。")] == ["de", "en", "zh"]
    assert [x[1] for x in model.languages("“Vakuumklebung”一词指的就是这里的工序。")] == ["zh"]
    assert model.languages("J73-5333") == [] and model.languages("41.6 mm") == [] and model.languages("") == []
    assert [x[1] for x in model.languages("Les opérateurs notent la valeur de la pompe.")] == ["fr"]


def test_found_languages(spark, tables):
    s = language.SENTENCES
    rows = [("a", s["de"], s["en"], None, "en", None, None), ("b", s["zh"], s["zh"] + " " + s["fr"], None, "中文", None, None), ("c", None, "7 mm", None, None, None, None), ("d", s["es"], None, None, "und", None, None)]
    rows += [(f"{g}{i}", t, None, None, g, None, None) for i in range(4) for g, t in s.items()]  # most labels are right
    assert {tuple(r) for r in language.found(spark, tables(qa_pairs=(rows + rows, QA))).collect()} == {("a", "question", "de"), ("b", "answer", "zh"), ("b", "answer", "fr"), ("d", "question", "es")}


def brute_share(text, k):
    t = "".join(c for c in text.lower() if c.isalnum())
    seen, inside = set(), np.zeros(len(t), dtype=bool)
    for i in range(len(t) - k + 1):
        if t[i : i + k] in seen:
            inside[i : i + k] = True
        seen.add(t[i : i + k])
    return inside.mean() if len(t) else 0.0


def test_repeated_share_equals_brute_force():
    s = "The motor of the washing machine was checked before it was used again. "
    texts = ["", "!!", s, s + s, s + "Nothing else was said about this part. " + s.upper() * 3, "电源模块在试验开始之前已经检查过了。" * 4, "ab" * 300, s * 2000]
    want = [brute_share(t, 12 if any("一" <= c <= "鿿" for c in t) else 24) for t in texts]
    assert np.allclose(repetition.shares(texts), want)


def test_repetition_of_tables(spark, tables):
    s = "The motor of the washing machine was checked before it was used again. "
    rows = [(f"q{i}", None, f"{s}Value {i} was read.", ("s", None), "en", None, None) for i in range(20)] + [("loop", None, s * 3, None, None, None, None)] * 2 + [("n", None, None, None, None, None, None)]
    d = tables(qa_pairs=(rows, QA), obfuscated_qa=([("o", "1. 电源模块已经检查过了没有问题。\n2. 电源模块已经检查过了没有问题。\n3. 电源模块已经检查过了没有问题。"), ("p", None)], "obf_id string, obfuscated_answer string"))
    assert {tuple(r) for r in repetition.found(spark, d).collect()} == {("qa_pairs", "loop"), ("obfuscated_qa", "o")}
