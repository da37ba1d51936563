import random
import re

import pytest

from workloom.llm import neardup


def brute(docs, size, t):
    sets = {}
    for i, x in docs:
        if i is None or x is None:
            continue
        w = re.findall(r"\w+", x.lower())
        s = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
        if s:
            sets[i] = s
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


def texts(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    out = []
    for i in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(3, 60))]
        for k in range(4):
            x = list(base)
            for _ in range(rnd.randrange(0, 4)):
                if x:
                    x[rnd.randrange(len(x))] = rnd.choice(vocabulary)
            out.append((f"d{i:02d}-{k}", " ".join(x)))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(i, x, "n", 1) for i, x in docs], "key string, body string, id string, runs int")


@pytest.mark.parametrize("size,t", [(4, 0.7), (5, 0.8), (2, 0.5)])
def test_finds_exactly_the_pairs_of_brute_force(spark, size, t):
    docs = texts(size) + [("copy1", "Одно, и то же слово снова"), ("copy2", "одно и то же слово снова!"), ("short", "два слова"), ("none", None), (None, "одно и то же слово снова"), ("empty", "")]
    docs += docs[:5]
    got = neardup.expand(*neardup.similar_pairs(frame(spark, docs), "key", "body", size=size, t=t)).collect()
    assert {(r.id_a, r.id_b) for r in got} == brute(docs, size, t) and len(got) == len(set(got))


def test_large_groups_of_copies_are_linked_to_their_first(spark):
    docs = [(f"c{i:02d}", "a b c d e f g h") for i in range(9)] + [("near", "a b c d e f g h i")]
    pairs, members = neardup.similar_pairs(frame(spark, docs), "key", "body", size=2, t=0.7)
    got = {(r.id_a, r.id_b) for r in neardup.expand(pairs, members, listed=4).collect()}
    assert got == {("c00", f"c{i:02d}") for i in range(1, 9)} | {("c00", "near")}


def test_classes(spark):
    docs = [("b", "a b c d e f g h i j k l"), ("a", "a b c d e f g h i j k m"), ("c", "a b c d e f g h i j k l"), ("x", "q r s t u v"), ("n", None)]
    got = {r.id: (r.class_id, r.links) for r in neardup.classes(frame(spark, docs), "key", "body", size=2, t=0.7).collect()}
    assert got == {"a": ("a", 1), "b": ("a", 1), "c": ("a", 1), "x": ("x", 0)}


def test_empty_and_very_long(spark):
    assert neardup.expand(*neardup.similar_pairs(frame(spark, []), "key", "body")).collect() == []
    long = " ".join(f"w{i}" for i in range(30_000))
    got = neardup.expand(*neardup.similar_pairs(frame(spark, [("a", long), ("b", long + " end")]), "key", "body")).collect()
    assert [tuple(r) for r in got] == [("a", "b")]


def test_salting_changes_nothing(spark, monkeypatch):
    docs = texts(9)
    monkeypatch.setattr(neardup, "POSTINGS", 2)
    got = neardup.expand(*neardup.similar_pairs(frame(spark, docs), "key", "body", size=2, t=0.5)).collect()
    assert {(r.id_a, r.id_b) for r in got} == brute(docs, 2, 0.5)


def test_large_groups_list_every_pair(spark):
    forms = ("A b c d e f g h", "a, b c d e f g h!", "a b c d e f g h")
    docs = [(f"c{i:03d}", forms[i % 3]) for i in range(205)] + [(f"d{i:03d}", "a b c d e f g h i") for i in range(203)] + [("near", "z a b c d e f g h")]
    got = neardup.expand(*neardup.similar_pairs(frame(spark, docs), "key", "body", size=2, t=0.7)).collect()
    assert {(r.id_a, r.id_b) for r in got} == brute(docs, 2, 0.7) and len(got) == len(set(got))


def test_blocks_change_nothing(spark, monkeypatch):
    docs = texts(9) + [(f"c{i:02d}", "a b c d e f g h") for i in range(30)] + [("near", "a b c d e f g h i")]
    monkeypatch.setattr(neardup, "BLOCK", 4)
    got = neardup.expand(*neardup.similar_pairs(frame(spark, docs), "key", "body", size=2, t=0.5)).collect()
    assert {(r.id_a, r.id_b) for r in got} == brute(docs, 2, 0.5) and len(got) == len(set(got))


def test_the_chain_rejects_what_its_first_segment_lets_through_and_loses_nothing(spark):
    rnd = random.Random(8)
    parts = [" ".join(f"s{k}w{i}" for i in range(9)) for k in range(30)]
    docs = [(f"d{i:03d}", " ".join(rnd.sample(parts, 11))) for i in range(250)]
    docs += [(f"e{i:03d}", x.replace("w3", "other", 1)) for i, (_, x) in enumerate(docs[:25])]
    sets, _ = neardup.contents(frame(spark, docs), "key", "body", 4)
    index = neardup.segment_index(sets, neardup.frequencies(sets, "runs"), 0.7)
    got = [{tuple(r) for r in neardup.candidates(index, 0.7, chain).collect()} for chain in range(1, neardup.CHAIN + 1)]
    assert got[0] > got[1] > got[3] and len(got[3]) < len(got[0]) / 3
    runs = {r.no: set(r.runs) for r in sets.collect()}
    name = {r.no: r.id for r in sets.collect()}
    alike = {(a, b) for a in runs for b in runs if a < b and len(runs[a] & runs[b]) >= 0.7 * len(runs[a] | runs[b])}
    assert alike and alike <= got[3] and {tuple(sorted((name[a], name[b]))) for a, b in alike} == brute(docs, 4, 0.7)


def test_both_sides_of_the_candidate_join_read_one_shuffle(spark):
    docs = frame(spark, texts(3))
    sets, _ = neardup.contents(docs, "key", "body", 2)
    index = neardup.segment_index(sets, neardup.frequencies(sets, "runs"), 0.7)
    got = neardup.candidates(index, 0.7)
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_an_id_with_several_texts_links_them(spark):
    docs = [("a", "a b c d e f g h"), ("a", "q r s t u v w x"), ("b", "a b c d e f g i"), ("c", "q r s t u v w y")]
    got = {r.id: (r.class_id, r.links) for r in neardup.classes(frame(spark, docs), "key", "body", size=2, t=0.7).collect()}
    assert got == {"a": ("a", 1), "b": ("a", 1), "c": ("a", 1)}
