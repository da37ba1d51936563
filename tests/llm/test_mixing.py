import os

import pytest

from workloom.llm import mixing

pytestmark = pytest.mark.skipif(not os.path.exists(mixing.TOKENIZER), reason="no tokenizer files")


def run(spark, docs, targets, **kw):
    d = spark.createDataFrame([(i, s, t, 1) for i, s, t in docs], "doc_id bigint, source string, text string, tokens int")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    return mixing.mix(d, t, **kw)


def test_tokens_equal_the_tokenizer_on_whole_texts():
    encoder, _ = mixing._encoder(mixing.TOKENIZER)
    for text in ["Hello world", "  two  spaces\n\n\nlines \t end  ", "Привет, мир! 123 №5 it's don't", "👩‍💻 ok…", "a b  c", " ", "x" * 5000]:
        assert mixing.token_count(text) == len(encoder.encode_ordinary(text))


def test_shares_caps_and_shortfalls(spark):
    docs = [(i, "big", "word " * 50) for i in range(100)] + [(1000 + i, "small", "слово " * 20) for i in range(20)] + [(2000 + i, "tiny", "one two three") for i in range(5)] + [(5009, "big", None), (5008, "big", ""), (5007, "other", "x y")]
    targets = [("big", 0.5, 1), ("small", 0.3, 3), ("tiny", 0.15, 2), ("absent", 0.05, 4), (None, 0.3, 2), ("none", None, None)]
    records, copies, shares = run(spark, docs, targets)
    r = {x.id: x for x in records.collect()}
    assert max(x.repeats for x in r.values() if x.source == "small") <= 3 and {x.repeats for x in r.values() if x.source == "tiny"} == {2}
    assert not {5007, 5008, 5009} & set(r)
    s = {x.source: x for x in shares.collect()}
    total = sum(x.reached for x in s.values())
    assert abs(sum(x.reached_share for x in s.values()) - 1) < 1e-9
    for x in s.values():
        assert x.reached == sum(y.tokens * y.repeats for y in r.values() if y.source == x.source) and abs(x.reached_share - x.reached / total) < 1e-9
        assert x.most_repeats <= x.cap and x.shortfall == max(0, x.demand - x.supply * x.cap)
    assert s["absent"].reached == 0 and s["absent"].shortfall == s["absent"].demand > 0 and s["none"].demand == 0
    assert abs(s["big"].reached - s["big"].demand) <= 51
    c = copies.collect()
    assert len(c) == sum(x.repeats for x in r.values()) and [x.position for x in c] == sorted(x.position for x in c)
    assert all(0 <= x.position <= 1 for x in c)


def test_sources_that_may_be_repeated_come_later(spark):
    docs = [(i, "a", "word " * 10) for i in range(300)] + [(1000 + i, "b", "word " * 10) for i in range(300)]
    _, copies, _ = run(spark, docs, [("a", 0.5, 1), ("b", 0.5, 5)])
    at = {s: [x.position for x in copies.collect() if x.source == s] for s in "ab"}
    assert sum(at["a"]) / len(at["a"]) < 0.45 < 0.55 < sum(at["b"]) / len(at["b"])


def test_inverse_of_the_schedule(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(u / 10, t / 10) for u in range(11) for t in range(-5, 6)], "u double, t double")
    for r in df.select("u", "t", mixing.position(F.col("u"), F.col("t")).alias("x")).collect():
        assert abs((1 - r.t) * r.x + r.t * r.x**2 - r.u) < 1e-9


def test_empty(spark):
    for docs, targets in (([], [("a", 1.0, 2)]), ([(1, "a", "x")], [])):
        records, copies, shares = run(spark, docs, targets)
        assert records.collect() == [] and copies.collect() == [] and len(shares.collect()) == len(targets)


def test_a_given_total_and_repeated_ids(spark):
    records, _, shares = run(spark, [(1, "a", "w " * 40), (1, "a", "w " * 40), (None, "a", "w " * 40)], [("a", 1.0, 10)], total=1000)
    s = shares.first()
    assert abs(s.reached - 1000) <= 41 and sum(r.repeats for r in records.collect()) * 41 >= 900


def test_a_given_schedule_decides_when_a_source_comes(spark):
    docs = [(i, "a", "word " * 10) for i in range(2000)] + [(5000 + i, "b", "word " * 10) for i in range(2000)] + [(9000 + i, "c", "word " * 10) for i in range(2000)]
    schedule = spark.createDataFrame([("a", 0.0, 1.0), ("a", 0.5, 0.0), ("b", 0.5, 0.0), ("b", 0.75, 2.0), ("b", 1.0, 0.0), ("zero", 0.2, 0.0), (None, 0.1, 1.0), ("a", 7.0, 9.0)], "source string, at double, weight double")
    _, copies, shares = run(spark, docs, [("a", 0.4, 1), ("b", 0.4, 1), ("c", 0.2, 1), ("zero", 0.0, 1)], total=12_000, schedule=schedule)
    at = {s: sorted(x.position for x in copies.collect() if x.source == s) for s in "abc"}
    want = {"a": lambda x: min(1.0, 4 * x - 4 * x * x) if x < 0.5 else 1.0, "b": lambda x: 0.0 if x < 0.5 else 8 * (x - 0.5) ** 2 if x < 0.75 else 1 - 8 * (1 - x) ** 2, "c": lambda x: x}
    for s, f in want.items():
        for x in (0.1, 0.3, 0.5, 0.6, 0.7, 0.9, 1.0):
            assert abs(sum(p <= x for p in at[s]) / len(at[s]) - f(x)) < 0.01, (s, x)
    assert {r.source: r.reached for r in shares.collect()}["a"] > 4700


def test_a_source_too_small_for_its_cap_gives_what_the_cap_allows(spark):
    docs = [(i, "big", "word " * 100) for i in range(200)] + [(1000 + i, "scarce", "word " * 100) for i in range(10)]
    _, _, shares = run(spark, docs, [("big", 0.5, 1), ("scarce", 0.5, 3)], total=20_000)
    s = {x.source: x for x in shares.collect()}
    assert s["scarce"].reached == 3 * s["scarce"].supply and s["scarce"].most_repeats == 3 and s["scarce"].demand - s["scarce"].reached == s["scarce"].shortfall > 0
    assert abs(s["big"].reached - 10_000) <= 101 and s["big"].shortfall == 0
    assert abs(s["scarce"].reached_share - s["scarce"].reached / (s["scarce"].reached + s["big"].reached)) < 1e-9 and s["scarce"].reached_share < 0.25


def test_shares_on_the_tables(spark, data):
    docs, targets = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "mix_targets"))
    records, _, shares = mixing.mix(docs, targets)
    most = {r.source: r.m for r in records.groupBy("source").agg({"tokens": "max"}).withColumnRenamed("max(tokens)", "m").collect()}
    for s in shares.collect():
        assert s.most_repeats <= s.cap and abs(s.reached + s.shortfall - s.demand) <= most.get(s.source, 0)
