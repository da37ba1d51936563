import random
import re

import numpy as np
import pytest

from workloom.llm import leakage

ITEM = "which of the nine copper guilds of the old harbour paid the wage in the year of the great flood and who kept the book"


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, item bigint")
    return d, spark.createDataFrame([(i, t, "en") for i, t in items], "item_id bigint, text string, doc string")


def run(spark, docs, items, **kw):
    d, i = frames(spark, docs, items)
    return {(r.doc, r.item): (r.run, r.span, r.same) for r in leakage.leaks(d, "doc_id", "text", i, "item_id", "text", **kw).collect()}


def brute(docs, items, n=12):
    def runs(t):
        w = re.findall(r"\w+", (t or "").lower())
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}

    return {(d, i) for d, x in docs for i, y in items if d is not None and runs(x) & runs(y)}


@pytest.mark.parametrize("limit", [10**6, 0])
def test_whole_partial_and_changed(spark, limit):
    w = ITEM.split()
    changed = list(w)
    changed[8], changed[16] = "XX", "YY"
    docs = [
        (1, "intro text. " + ITEM.upper().replace(" ", ", ") + "! more"), (2, "x " + " ".join(w[3:15]) + " y"), (3, "x " + " ".join(w[3:14]) + " y"), (4, " ".join(changed)), (5, None), (6, ""), (7, " ".join(w[:6]) + " and then " + " ".join(w[6:12])),
        (None, ITEM), (1, "intro text. " + ITEM.upper().replace(" ", ", ") + "! more"), (8, "pad " * 100_000 + ITEM),
    ]
    items = [(1, ITEM), (2, ITEM), (3, "too short"), (4, None), (None, ITEM)]
    got = run(spark, docs, items, broadcast_words=limit)
    assert {k for k, v in got.items() if v[0] >= 12} == brute(docs, [i for i in items if i[0] is not None])
    assert got[1, 1] == (len(w),) * 3 and got[2, 1] == (12, 12, 12)
    assert got[4, 1][1] == len(w) and got[4, 1][2] == len(w) - 2 and (5, 1) not in got


def test_random_texts_against_brute_force(spark):
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(10, 30)))) for i in range(12)]
    docs = []
    for d in range(60):
        x = [rnd.choice(vocabulary) for _ in range(30)]
        w = rnd.choice(items)[1].split()
        a = rnd.randrange(max(1, len(w) - 8))
        x[10:10] = w[a : a + rnd.randrange(8, 16)]
        docs.append((d, " ".join(x)))
    assert {k for k, v in run(spark, docs, items).items() if v[0] >= 12} == brute(docs, items)


def test_empty(spark):
    assert run(spark, [], [(1, ITEM)]) == {} and run(spark, [(1, ITEM)], []) == {}


def test_every_mask_hits_an_equal_window_and_some_mask_a_changed_one():
    h = np.arange(1, 13, dtype=np.uint64)
    one = [s.tolist() for _, _, s in leakage.seeds(h)]
    assert all(len(s) == 1 for s in one)
    for p in range(1, 11):
        g = h.copy()
        g[p] = 99
        assert any(s.tolist() == o for (_, _, s), o in zip(leakage.seeds(g), one)) or p in (0, 11) or all(m[p] == "1" for m in leakage.MASKS)


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("at", [3, 6, 7])
def test_a_second_part_on_the_same_diagonal_counts(spark, at, limit):
    item = [f"i{k}" for k in range(60)]
    doc = [f"x{k}" for k in range(60)]
    doc[:12], doc[40:52] = item[:12], item[40:52]
    doc[at] = "other"
    got = run(spark, [(1, " ".join(doc))], [(1, " ".join(item))], broadcast_words=limit)
    assert got[1, 1][0] == 12


def test_both_plans_give_the_same_on_the_tables(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "eval_items"))
    both = [sorted(tuple(r) for r in leakage.leaks(docs, "doc_id", "text", items, "item_id", "text", broadcast_words=n).collect()) for n in (10**9, 0)]
    assert both[0] == both[1] and both[0]


def test_a_hit_inside_a_seen_overlap_is_passed_over():
    w = np.arange(1, 2001, dtype=np.uint64)
    d = leakage.Diagonal(w, w, 5, 5)
    assert d.overlap(5) == (2000, 2000, 2000)
    assert all(d.overlap(k) is None for k in range(0, 1989, 7)) and len(d.seen) == 1
