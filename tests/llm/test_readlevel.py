import random

import numpy as np

from workloom.llm import readlevel

EASY = "кот дом мама ест суп дети идут лес".split()
HARD = "контрциклическая институционализация фидуциарной ответственности проблематизирует гетероскедастичность компенсационных перераспределительных".split()


def text(level, rnd):
    words = [rnd.choice(HARD if rnd.random() < (level - 1) / 3 else EASY) for _ in range(60)]
    step = 4 + 6 * level
    return ". ".join(" ".join(words[i : i + step]) for i in range(0, 60, step)) + "."


def tables(spark, n=240):
    rnd = random.Random(6)
    docs = [(i, text(1 + i % 4, rnd), "x") for i in range(n)]
    labels = [(i, r, min(4, max(1, 1 + i % 4 + (rnd.random() < 0.08)))) for i in range(n) if i % 8 < 4 for r in "ab"] + [(0, "d", None), (None, "d", 3), (10**9, "d", 3)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, level string"), spark.createDataFrame(labels, "doc_id bigint, rater string, level int")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    got = {r.id: r for r in readlevel.reading_levels(docs, labels).collect()}
    fresh = [i for i in got if i % 8 >= 4]
    assert len(got) == 240 and np.mean([got[i].level == 1 + i % 4 for i in fresh]) > 0.85
    scores = {k: np.mean([got[i].score for i in got if i % 4 == k]) for k in range(4)}
    assert scores[0] < scores[1] < scores[2] < scores[3]


def test_odd_documents(spark):
    docs, labels = tables(spark)
    odd = spark.createDataFrame([(-1, None, ""), (-2, "", ""), (-3, "... !?", ""), (-4, "слово " * 60_000, ""), (None, "кот", ""), (5, "кот", "")], docs.schema)
    got = readlevel.reading_levels(docs.union(odd), labels).collect()
    assert len(got) == 246
    assert {r.id for r in got if r.level is None} == {-1, -2, -3}
    assert sum(r.id is None for r in got) == 1


def test_few_or_no_grades(spark):
    docs, labels = tables(spark, 40)
    assert {r.level for r in readlevel.reading_levels(docs, labels.limit(0)).collect()} == {None}
    assert {r.level for r in readlevel.reading_levels(docs, labels.where("level = 2")).collect()} == {2}
    assert readlevel.reading_levels(docs.limit(0), labels).collect() == []


def test_gradient():
    rnd = np.random.default_rng(0)
    z, rank, w = rnd.normal(size=(30, 3)), rnd.integers(0, 4, 30), rnd.random(30) + 0.5
    p = np.concatenate((rnd.normal(size=3), [-1.0, 0.1, -0.2]))

    def loss(q):
        cut = readlevel.Ordinal._cuts(q[3:])
        e = np.concatenate(([-np.inf], cut, [np.inf]))
        s = z @ q[:3]
        c = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        return (-(w * np.log(c(e[rank + 1] - s) - c(e[rank] - s))).sum() + 0.5 * 2.0 * (q[:3] ** 2).sum()) / w.sum()

    g = readlevel.Ordinal()._gradient(p, z, rank, w, 3, 3, 2.0)
    for i in range(len(p)):
        d = np.zeros_like(p)
        d[i] = 1e-6
        assert abs((loss(p + d) - loss(p - d)) / 2e-6 - g[i]) < 1e-5
