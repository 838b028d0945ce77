from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import subjects

TERMS = {"law": ["legal counsel", "injunction", "판결 취지", "소송 대리"], "sport": ["league table", "goalkeeper", "리그 순위", "유도 매트"], "science": ["magnetic field", "enzyme", "효소 활성", "궤도 운동"]}
FRAMES = ["Missing values for {} are left blank.", "{} was discussed in {n}.", "{} 값이 없는 경우에는 빈칸으로 둔다.", "{n}년부터 {} 현황을 표시한다."]
ROUTINE = ["Thank you for reading.", "읽어 주셔서 감사합니다.", "The meeting ended at 10 o'clock.", "출처: getZoneSeatFill, langDivNm·bookCnt (2025)"]


def make(n, seed):
    r = random.Random(seed)
    texts, truth = [], []
    for _ in range(n):
        mine = r.sample(sorted(TERMS), r.choice([0, 1, 1, 2]))
        lines = [r.choice(FRAMES).format(r.choice(TERMS[s]), n=r.randint(2000, 2025)) for s in mine for _ in range(r.randint(3, 5))] + r.choices(ROUTINE, k=r.randint(1, 3))
        if lines and len(mine) == 1 and r.random() < 0.4 and len(lines) > 5:
            lines.append(r.choice(FRAMES).format(r.choice(TERMS[next(s for s in TERMS if s not in mine)]), n=1))
        r.shuffle(lines)
        texts.append("\n".join(lines))
        truth.append(set(mine))
    return texts, truth


def test_held_out():
    names = sorted(TERMS)
    texts, truth = make(400, 1)
    r = random.Random(2)
    shares = np.array([[float((s in t) != (r.random() < 0.03)) for s in names] for t in truth])
    models = subjects.calibrate([subjects.sentences(t) for t in texts], shares, names)
    asked, wanted = make(300, 3)
    got = [set(f) for f in models.classify(asked)]
    right = sum(len(g & w) for g, w in zip(got, wanted, strict=True))
    f1 = 2 * right / (sum(map(len, got)) + sum(map(len, wanted)))
    assert f1 > 0.97
    assert models.classify([None, "", "  ", "Thank you for reading.", "완전히 새로운 낱말"]) == [[], [], [], [], []]
    long = "\n".join(asked[:1] * 3000)
    assert set(models.classify([long])[0]) == got[0]


def test_sentences():
    text = "# 1. Title​ here. In 2011. However x<br/>- data/raw/x 3 items 2022년 한"
    assert subjects.sentences(text) == [("title", "here"), ("in", "#"), ("however", "x"), ("@", "#", "items", "#", "년", "한")] or subjects.sentences(text)[-1][-1] == "한"
    assert subjects.sentences(None) == [] and len(subjects.sentences("x" * 500_000)) == 1
    assert len(subjects.sentences("_-" * 200_000)) <= 1


def test_tables(spark, rows):
    texts, truth = make(120, 5)
    docs = spark.createDataFrame([*enumerate(texts), (500, None), (501, ""), (0, texts[0])], "doc_id long, text string").withColumns({"votes": F.lit(1), "annotators": F.lit(2), "subject": F.lit("x")})
    labels = [(n, s, 1) for n, t in enumerate(truth) if n % 2 for s in (t or {None})] + [(None, "law", 1), (7777, "law", 1), (1, "unknown", 2)]
    labels = spark.createDataFrame(labels, "doc_id long, subject string, annotator int").withColumn("text", F.lit("clash"))
    models = subjects.train(docs, labels, "doc_id", "text", sorted(TERMS))
    got = rows(subjects.assign(docs, "doc_id", "text", models))
    assert {s for n, s in got if n == 0} == {s for n, s in got if n == 0} and len([1 for n, _ in got if n == 0]) == 2 * len({s for n, s in got if n == 0})
    hits = sum((n, s) in set(got) for n, t in enumerate(truth) for s in t)
    assert hits > 0.9 * sum(map(len, truth))
    assert subjects.assign(docs.limit(0), "doc_id", "text", models).count() == 0
    nothing = subjects.train(docs, labels.limit(0), "doc_id", "text", sorted(TERMS))
    assert subjects.assign(docs, "doc_id", "text", nothing).count() == 0
    shares = subjects.composition(subjects.assign(docs.drop("subject"), "doc_id", "text", models), docs.withColumn("lang", F.lit(None).cast("string")).dropDuplicates(["doc_id"]), "doc_id", "lang")
    assert abs(sum(r.share for r in shares.collect()) - 1) < 1e-9


def test_sentences_drawn_from_long_texts():
    text = "\n".join(f"line {n} of text" for n in range(9000))
    drawn = subjects.drawn_sentences(text, 1000)
    assert sum(map(len, drawn)) <= 1000 and len(drawn) > 200
    assert subjects.drawn_sentences("a b. c d.", 1000) == [("a", "b"), ("c", "d")] and subjects.drawn_sentences(None) == []
    marked = "\n".join(["first half"] * 5000 + ["second part"] * 5000)
    assert {s[0] for s in subjects.drawn_sentences(marked, 100)} == {"first", "second"}


def test_margin_is_per_token():
    names = sorted(TERMS)
    texts, truth = make(300, 9)
    models = subjects.fit([subjects.sentences(t) for t in texts], np.array([[float(s in t) for s in names] for t in truth]), names)
    one = subjects.sentences("판결 취지 현황을 표시한다")[0]
    (once,), (n,) = models.scores([one])
    (again,), (m,) = models.scores([one * 40])
    assert m == 40 * n and abs(once.min() - again.min()) < 2.5 and once[:-2].argmin() == again[:-2].argmin()
    assert models.scores([("never", "met")])[0].sum() == 0 and models.about(*models.scores([("never", "met")]), (0.0, 0.0, 0.0)) == [-1]
