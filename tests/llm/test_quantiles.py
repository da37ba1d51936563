import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from workloom.llm import quantiles

P = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def brute(values):
    x = sorted(values)
    return [x[max(1, math.ceil(round(p * len(x), 6))) - 1] for p in P.values()]


def test_exact_with_a_hot_group_over_many_partitions(spark):
    rnd = random.Random(1)
    rows = [("hot", rnd.randrange(50)) for _ in range(4000)] + [(f"g{i}", rnd.randrange(1000)) for i in range(40) for _ in range(rnd.randrange(1, 9))] + [(None, 5), ("hot", None)]
    df = spark.createDataFrame([(*r, i, 0) for i, r in enumerate(rows)], "g string, x bigint, row bigint, n int").repartition(7)
    want = {}
    for g, x in rows:
        if x is not None:
            want.setdefault(g, []).append(x)
    for freq in (quantiles.frequencies(df, ["g"], "x"), quantiles.row_frequencies(df.union(df), ["g"], "x", "row")):
        got = {r.g: [r[c] for c in P] + [r.n] for r in quantiles.percentiles(freq, ["g"], P).collect()}
        assert got == {g: brute(v) + [len(v)] for g, v in want.items()}


def test_parts_combine_to_the_whole(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.choice("ab"), rnd.randrange(30), d) for d in range(3) for _ in range(200)], "g string, x bigint, d int")
    parts = [quantiles.frequencies(df.where(f"d = {d}"), ["g"], "x") for d in range(3)]
    a = quantiles.percentiles(quantiles.combine(parts, ["g"]), ["g"], P).collect()
    b = quantiles.percentiles(quantiles.frequencies(df, ["g"], "x"), ["g"], P).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_stated_error(spark):
    rnd = random.Random(3)
    values = [rnd.lognormvariate(10, 2) * rnd.choice([1, 1, -1]) for _ in range(500)] + [0.0] * 5
    df = spark.createDataFrame([("a", v) for v in values], "g string, x double")
    got = quantiles.percentiles(quantiles.frequencies(df, ["g"], "x", relative_error=0.02), ["g"], P).first()
    for c, want in zip(P, brute(values)):
        assert abs(got[c] - want) <= 0.0201 * abs(want) + 1e-9


def test_empty(spark):
    df = spark.createDataFrame([], "g string, x bigint")
    assert quantiles.percentiles(quantiles.frequencies(df, ["g"], "x"), ["g"], P).collect() == []


@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30), st.floats(0.001, 1.0))
@settings(max_examples=100, deadline=None)
def test_rank_definition(values, p):
    x = sorted(values)
    r = max(1, math.ceil(round(p * len(x), 6)))
    assert sum(v <= x[r - 1] for v in x) >= r and sum(v < x[r - 1] for v in x) < r


def test_counts_of_single_sources_are_taken_together(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", None]), rnd.randrange(20), i, rnd.choice("xyz")) for i in range(600)]
    df = spark.createDataFrame(rows + rows[:50], "g string, x bigint, row bigint, source string")
    freq = quantiles.row_frequencies(df, ["g"], "x", "row", by=["source"])
    one = freq.where("_b0 = 'x'").agg({"n": "sum"}).first()[0]
    assert one == sum(r[3] == "x" for r in rows)
    got = {r.g: [r[c] for c in P] + [r.n] for r in quantiles.percentiles(freq, ["g"], P).collect()}
    assert got == {g: brute([r[1] for r in rows if r[0] == g]) + [sum(r[0] == g for r in rows)] for g in ("a", None)}
