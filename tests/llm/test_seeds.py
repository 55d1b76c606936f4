"""No seed sentence stands in the test tables, and unseen wordings are found: residue, filler and refusals."""

import os
import re
import unicodedata
from types import SimpleNamespace

import pandas as pd
import pytest

from curatrix.llm import pairs, phrases, residue

DIR = "/root/testdata/sf0.01"


def fold(t):
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFKC", t).casefold())


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")
def test_no_seed_stands_in_the_tables():
    qa, entries = (pd.read_parquet(f"{DIR}/{n}.parquet") for n in ("qa_pairs", "dataset_entries"))
    texts = "\n".join(fold(t) for c in (qa.question, qa.answer, entries.obfuscated_question) for t in set(c.dropna()))
    for kind in (phrases.NOTICES, phrases.FILLER, phrases.REFUSALS):
        for line in kind:
            for s in re.split(r"(?<=[.?!;。？；！])\s*", line):
                assert len(fold(s)) < 6 or fold(s) not in texts, s


QUESTIONS = [f"How does the {p} influence {m} above {i} mm?" for i, (p, m) in enumerate([("pump", "noise"), ("door", "bow"), ("filter", "yield")] * 30)] + [f"如果{p}维持在{i}摄氏度，噪声会发生什么变化？" for i, p in enumerate(["热泵", "风道", "电源"] * 30)]


def test_unseen_filler_and_notices():
    model = residue.Residue.fit(QUESTIONS)
    bad = ["Put the question text in here", "placeholder placeholder placeholder", "qwer asdf qwer asdf", "问题内容待填写", "Page unavailable. Please try once more in some minutes.", "Scripting is off in your browser, please switch it on.", "此页面需要浏览器脚本支持"]
    cover, slots = model.measure(bad)
    assert ((cover >= residue.COVER) | slots).mean() >= 0.85
    cover, slots = model.measure(["Why does the browser of the pump show error 404 after the update?", *QUESTIONS[:30]])
    assert not ((cover >= residue.COVER) | slots).any()


def test_unseen_refusals_and_answers_that_are_none():
    prose = [f"The pump was replaced after {i} hours, because the noise rose above the limit." for i in range(60)] + [f"泵在{i}小时后更换，因为噪声超过上限。" for i in range(60)]
    judge = pairs.Judge.fit([SimpleNamespace(question=None, answer=t, language="en" if t[0] == "T" else "zh") for t in prose])
    bad = ["I'm afraid I cannot answer that.", "Sorry, I can't give any information on this topic.", "I am sorry, I cannot say how it behaves after 24 hours.", "很抱歉，我不能回答这个问题。", "Lo siento, no puedo ayudar con eso.", "Je ne peux malheureusement pas répondre.", "Das kann ich leider nicht beantworten."]
    assert judge.refusals(bad).mean() >= 0.85
    assert not judge.refusals(prose[:20] + prose[70:90] + ["The valve cannot be opened above 30 °C."]).any()
