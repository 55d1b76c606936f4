"""Near-copies in Chinese and with accented letters, against brute force."""

import random
import re

from curatrix.operators import dedup

ZH = "电源模块在试验开始之前已经检查过热泵风道除霜控制阶段少用噪声温度记录数值面板弯曲清洗机马达更换工程师测量周期蚀刻湿法设备样品"
FR = "été façon über größe niño mañana señal prüfung élève çà où même"


def texts():
    r = random.Random(11)
    out = {}
    for g in range(4):
        base = [r.choice(ZH) for _ in range(120)]
        for i in range(8):  # three clauses or fewer, a character changed in each
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 3])):
                w[r.randrange(120)] = r.choice(ZH)
            out[10 * g + i] = "".join(w[:40]) + "，" + "".join(w[40:80]) + "。" + "".join(w[80:])
    for i in range(6):
        w = random.Random(5).choices(FR.split(), k=60)
        w[i * 9] = "änderung" if i else w[0]
        out[100 + i] = " ".join(w)
    return out | {200: "für", 201: "fär", 202: ""}


def brute(found):
    sets = {}
    for i, t in found.items():
        w = re.findall(r"[一-鿿]|[^\W\d_一-鿿]+", t.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    return {(b, a) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}


def test_chinese_and_accented_near_copies_equal_brute_force(spark):
    found = texts()
    docs = spark.createDataFrame([(k, v, None) for k, v in found.items()], "doc_id int, text string, title string")
    want = brute(found)
    links = {(x.doc_id, x.other) for x in dedup.similar_links(docs).collect()}
    assert links <= want and len(links) >= 0.9 * len(want) and sum(a < 100 for a, _ in want) > 20
    classes = {x.doc_id: x.class_id for x in dedup.near_classes(docs).collect()}
    assert set(classes) == set(found) and classes[200] != classes[201]
    assert all(classes[a] == classes[b] for a, b in links)


def test_three_stage_confirms_chinese_near_copies(spark):
    r = random.Random(3)
    base = [r.choice(ZH) for _ in range(90)]
    other = list(base)
    other[15], other[45], other[75] = "甲", "乙", "丙"  # one in each clause: no clause is shared
    text = lambda w: "".join(w[:30]) + "，" + "".join(w[30:60]) + "，" + "".join(w[60:]) + "。"
    rows = [(1, text(base), None), (2, text(other), None), (3, text([r.choice(ZH) for _ in range(90)]), None)]
    got = dedup.three_stage(spark.createDataFrame(rows, "doc_id int, text string, title string")).collect()
    assert [(x.duplicate_id, x.representative_id, x.method) for x in got] == [(2, 1, "tfidf")]
