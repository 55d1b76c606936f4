"""Models count all texts, each record once: nothing is drawn from a sample."""

import pickle
from types import SimpleNamespace

import numpy as np

from curatrix.llm import pairs, residue, truncation

from .conftest import QA, STEPS


def word(i):
    return "".join(chr(97 + i // 26**k % 26) for k in range(4)) + "o" + "l" * (i // 40 % 20)


def pair(i, question, answer, language="en"):
    return (i, question, answer, ("s", None), language, None, None)


def test_closing_words_of_every_text_are_known(spark, tables):
    """A word that has closed one sentence anywhere in the table may close another, however many texts there are."""
    rows = [pair(f"w{i}", f"Why {word(i)} then?", f"Set to {word(i)}.") for i in range(7000)]
    rows += [pair(f"o{i}", f"Why {word(i)} so?", f"Set to {word(i)}") for i in range(0, 7000, 40)]
    d = tables(qa_pairs=(rows, QA), reasoning_steps=([], STEPS))
    assert truncation.found(spark, d).count() == 0


def test_run_counts_equal_a_fit_of_all_texts(spark, tables):
    texts = ["The pump was replaced. The fan kept its speed", "- check the fan\n- log the value of T65-13\n", "泵在24小时后更换。风机A7停了", None, "x" * 3] * 3 + ["- check the fan"]
    rows = [pair(f"p{i}", t, t) for i, t in enumerate(texts)]
    d = tables(qa_pairs=(rows + rows[:6], QA), reasoning_steps=([(f"t{i}", 1, t, "s", None) for i, t in enumerate(texts)], STEPS))
    want = truncation.Closings.fit([t for t in texts for _ in range(3) if t])
    keys = want.keys.view(np.int64).tolist()
    asked = truncation.stored(spark.createDataFrame([(k,) for k in [*keys, 12345]], "key bigint"))
    got = {r.key: (r.ends, r.goes) for r in truncation.run_counts(truncation.closing_texts(spark, d), asked).collect()}
    assert got == {k: (e, g) for k, e, g in zip(keys, want.ends.tolist(), want.goes.tolist())}


def test_looked_up_likelihoods_equal_the_model(spark, tables):
    texts = ["The pump was replaced. The fan kept its speed", "- check the fan\n- log the va", "The code is T65-13. Its code is 7x-A9", "泵在24小时后更换。风机停", "The fan was rep", "- check the fan"] * 4
    d = tables(qa_pairs=([pair(f"p{i}", None, t) for i, t in enumerate(texts)], QA), reasoning_steps=([], STEPS))
    df = truncation.records(spark, d)
    seen = truncation.stored(truncation.examined(df, None))
    got = {r.record_id: r.p_end for r in truncation.judged(seen, truncation.closing_texts(spark, d)).where("marked is not null").collect()}
    model = truncation.Closings.fit(texts)
    assert got == {f"p{i}": e[1] for i, t in enumerate(texts) if (e := truncation.doubt(t, model))} and len(got) > 8


def test_prose_is_learnt_from_every_question(spark, tables, monkeypatch):
    """A wording that only one question in thousands has is prose all the same."""
    seen = []
    monkeypatch.setattr(residue, "scored", lambda df, model: seen.append(model) or df.selectExpr("*", "0d as residue_share", "false as has_slot"))
    rows = [pair(f"q{i}", f"Why does {word(i)} move {word(7 * i + 3)}?", None) for i in range(2600)]
    entries = [("e1", "What is a zyxqvw?"), ("e1", "What is a zyxqvw?"), ("e2", " "), ("e3", None)]
    d = tables(qa_pairs=(rows + rows[:40], QA), dataset_entries=(entries, "entry_id string, obfuscated_question string"))
    residue.found(spark, d).collect()
    want = residue.Residue.fit([r[1] for r in rows] + [entries[0][1]])
    assert all((a == b).all() for a, b in zip(seen[0].model.tables, want.model.tables))


def test_every_pair_and_segment_trains_the_judge(spark, tables, monkeypatch):
    """The model of the query is that of all labelled segments and answers of the table."""
    fits = []
    rounds = pairs.Judge.rounds.__func__
    monkeypatch.setattr(pairs.Judge, "rounds", classmethod(lambda cls, count: fits.append(rounds(cls, count)) or fits[-1]))
    rows = [pair(f"q{i}", f"Why does the {word(i)} move?", f"The {word(i)} moves. It is cold. It is old. Then {word(3 * i)} stops.") for i in range(3200)]
    rows += [pair("z", "Warum steht die Pumpe?", "Die Pumpe steht still, weil sie heiss ist.", "de"), pair("n", None, None, None), pair("r", "Why?", "I cannot answer that, sorry.")]
    d = tables(qa_pairs=(rows + rows[:40], QA), reasoning_steps=([], STEPS))
    pairs.found(spark, d)
    want = pairs.Judge.fit([SimpleNamespace(question=r[1], answer=r[2], language=r[4]) for r in rows])
    assert len(fits) == 2
    assert all((a == b).all() for a, b in zip(fits[0].both.tables, want.both.tables))


def test_each_distinct_piece_is_read_once(monkeypatch):
    """Tokens and their hashes are those of whole texts, but what is said again is not read again."""
    odd = ["  a  b\tc  T65-13 T65-1a 3.4.5, 7x-A9 don't o'neil-b  co2 x² ²", "泵在24小时后 更换。pump风机A7停了 l'豈b豈 q　w\xa0é", "", " ", "- check the fan\n- log\n* item 3\n2. word -", "a.b c?d\x00e \x00 f"]
    want = [truncation.hash_of(truncation._token(raw)) if raw not in [*truncation.ENDS, "\n"] else truncation._BREAK for t in odd for raw in [*truncation._TOKEN.findall(truncation._ITEMS.sub(r"\1- ", t)), None] if raw is not None]
    h, shape = truncation.hashed(odd)
    assert h[h != truncation._PAST].tolist() == want and (h == truncation._PAST).sum() == len(odd)
    assert sorted({truncation.hash_of("shape " + truncation._shape(c)) for c in ("T65-13", "A7")} - set(shape.tolist())) == []
    read = []

    class Pattern:
        findall = staticmethod(lambda t, own=truncation._TOKEN: read.append(t) or own.findall(t))

    monkeypatch.setattr(truncation, "_TOKEN", Pattern)
    truncation.hashed(["The fan kept its speed, and the fan kept its speed."] * 100)
    assert sum(map(len, read)) <= 51


def test_pieces_of_earlier_batches_are_not_read_again(monkeypatch):
    texts = ["The fan kept its speed of T65-13 at 3.4 V.", "泵在24小时后更换。\x00 a\x00"]
    want = [x.tolist() for x in truncation.hashed(texts)]
    read = []

    class Pattern:
        findall = staticmethod(lambda t, own=truncation._TOKEN: read.append(t) or own.findall(t))

    monkeypatch.setattr(truncation, "_TOKEN", Pattern)
    assert [x.tolist() for x in truncation.hashed(texts[::-1])] != want and [x.tolist() for x in truncation.hashed(texts)] == want and read == []


def test_a_judge_is_sent_without_weights_of_unseen_ngrams():
    """What each round sends to the executors stays small, and reads as before."""
    judge = pairs.Judge.fit([SimpleNamespace(question="Why does the fan move?", answer="It moves since it is cold.", language="en")] * 3)
    sent = pickle.dumps(judge, 5)
    got = pickle.loads(sent)
    assert len(sent) < 1_000_000
    for a, b in ((judge.langs, got.langs), (judge.refusal, got.refusal), (judge.both, got.both)):
        assert a.classes == b.classes and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_segments_minima_are_those_of_reduceat():
    rng = np.random.default_rng(3)
    for sizes in ([1], [1, 40, 3, 100, 32, 33, 1], [7] * 50, [500, 2]):
        x = rng.integers(0, 1 << 32, sum(sizes), dtype=np.uint32)
        starts = np.cumsum(sizes) - sizes
        own = truncation._Minima(starts, len(x))
        assert own.least(x[own.places]).tolist() == np.minimum.reduceat(x, starts).tolist()


def test_pairs_are_prepared_once(spark, tables, monkeypatch):
    """Texts are split into segments in one pass; the rounds read what it stored, and no text again."""
    rows = [pair(f"q{i}", "Why does the fan move?", f"The T65-{i} moves. It is cold.") for i in range(40)] + [pair("n", None, "", "zz")]
    langs, parts, said, coded = pairs.prepared(*[[r[k] for r in rows] for k in (1, 2, 4)])
    assert langs[0] == "en" and parts[0].split("\n") == pairs.segments(rows[0][1]) + pairs.segments(rows[0][2]) and said[0] == rows[0][2] and coded[0] == "The § moves. It is cold."
    assert (langs[-1], parts[-1], said[-1], coded[-1]) == (None, None, None, None)
    monkeypatch.setattr(pairs, "segments", None)
    judge = pairs.Judge(*(lambda n: (n[:-1], n[-1]))(pairs.tally(None, True, langs, parts, said, coded)))
    again = pairs.tally(judge, True, langs, parts, said, coded)
    assert again.shape == (6, 3, 1 << 17) and again[1].sum() > 0
