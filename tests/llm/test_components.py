import random

import numpy as np
import pytest

from workloom.llm import components


def brute(pairs):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is None or b is None or a == b:
            continue
        for x in (a, b):
            parent.setdefault(x, x)
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def run(spark, pairs, **kw):
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in pairs], "id_a string, id_b string, id string, group_id string")
    rows = components.connected(df, "id_a", "id_b", **kw).collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: r.group_id for r in rows}


@pytest.mark.parametrize("cell", [5, 60, 100_000])
def test_random_chains_stars_and_rings(spark, cell):
    rnd = random.Random(cell)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(40)]
    loose = [(f"r{rnd.randrange(60)}", f"r{rnd.randrange(60)}") for _ in range(45)]
    odd = [("a", None), (None, None), ("b", "b"), ("я", "a"), ("a", "я"), ("Z", "я")]
    pairs = chain + star + loose + odd
    rnd.shuffle(pairs)
    assert run(spark, pairs, cell_edges=cell) == brute(pairs)


def test_empty_and_nothing_linked(spark):
    assert run(spark, []) == {} and run(spark, [("a", "a"), (None, "b")]) == {}


def test_forest_roots():
    assert components.forest_roots(6, np.array([5, 3, 4]), np.array([3, 1, 4])).tolist() == [0, 1, 2, 1, 4, 1]


@pytest.mark.parametrize("links", [50, 200])
def test_a_sorted_chain_takes_few_rounds_and_a_logarithm_of_jumps(spark, links):
    pairs = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(links)]
    done = {}
    df = spark.createDataFrame(pairs, "id_a string, id_b string")
    got = {r.id: r.group_id for r in components.connected(df, "id_a", "id_b", cell_edges=20, done=done).collect()}
    assert got == {f"c{i:04d}": "c0000" for i in range(links + 1)}
    assert done["rounds"] <= 4 and done["jumps"] <= 3 * links.bit_length()


def test_many_groups_over_many_cells(spark):
    rnd = random.Random(3)
    pairs = [(f"v{rnd.randrange(400):03d}", f"v{rnd.randrange(400):03d}") for _ in range(330)] + [("v000", f"s{i:03d}") for i in range(150)]
    assert run(spark, pairs, cell_edges=6) == brute(pairs)
