"""Groups of records linked directly or through others, over a two-dimensional grid of edge blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.runtime import materialise, release

#: Edges that a grid cell holds on average at most.
CELL_EDGES = 200_000
#: Copies of the representatives' labels when they are joined back, so a giant group is spread.
SALTS = 8


def forest_roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least vertex number of each vertex's component: union by hooking the larger root under
    the smaller, then full path halving, until no edge joins two roots."""
    parent = np.arange(n)
    while len(u):
        a, b = parent[u], parent[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _cell(t: pa.Table) -> pa.Table:
    ends = pa.chunked_array([*t["a"].chunks, *t["b"].chunks], type=pa.string())
    names = pc.unique(ends)
    order = pc.sort_indices(names)  # bytes of UTF-8: by code point
    rank = np.empty(len(names), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(names))
    codes = rank[pc.index_in(ends, value_set=names).to_numpy()]
    names = names.take(order)
    root = forest_roots(len(names), codes[: t.num_rows], codes[t.num_rows :])
    return pa.table({"v": names, "r": names.take(pa.array(root))})


def _follow(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """df with the values of a column replaced by their parents, and `moved`: whether there was one. The
    parents are copied SALTS times and df's rows dealt over the copies, so a vertex that most rows
    name is spread."""
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    up = parents.select(F.col("v").alias(column), F.col("p").alias("_up"), copies.alias("_salt"))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS).cast("bigint")))
    got = dealt.join(up, [column, "_salt"], "left")
    return got.select(*[F.coalesce("_up", column).alias(c) if c == column else F.col(c) for c in df.columns], F.col("_up").isNotNull().alias("moved"))


def _to_roots(parents: DataFrame, done: dict[str, int]) -> DataFrame:
    """Parents followed up to the roots, by doubling: as many joins as the logarithm of the greatest depth."""
    while True:
        got = materialise(_follow(parents, "p", parents), "parents")
        done["jumps"] += 1
        release(parents)
        parents = got.drop("moved")
        parents.stage_path = got.stage_path
        if not got.where("moved").limit(1).count():
            return parents


def connected(pairs: DataFrame, a: str, b: str, *, cell_edges: int = CELL_EDGES, done: dict[str, int] | None = None) -> DataFrame:
    """(id, group_id) for every id that occurs in a pair of two different, non-null ids; group_id is
    the smallest id (by code point) of all ids linked to it directly or through others.

    Vertices are hashed into B blocks, so the edges fall into B(B+1)/2 cells; a vertex with very
    many edges is spread over the B cells of its row and column. Each cell runs union-find over its
    own edges. The representatives that a vertex has in its row and column are then exchanged: the
    least becomes its parent, the others are linked to it by edges. Parents are followed up to the
    roots by doubling, and the edges that still join different roots make the next round, so a chain
    of n links takes about log n joins, not n rounds. When no such edge is left, the parents are
    stable. No component, and no list of vertices, is ever held in one place.

    Defined cases: null ids and pairs of an id with itself link nothing and give no row by
    themselves; repeated and reversed pairs count once; an empty table gives an empty result; other
    columns of `pairs` are not looked at. `done`, if given, receives the number of rounds and jumps.
    """
    done = {} if done is None else done
    done.update(rounds=0, jumps=0)
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = materialise(edges.select(lo.cast("string").alias("a"), hi.cast("string").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    left = edges.count()
    while left or not rounds:
        blocks = max(1, math.isqrt(2 * left // cell_edges) + (left > cell_edges))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
        x, y = block("a"), block("b")
        cell = F.least(x, y) * blocks + F.greatest(x, y)
        local = edges.select("a", "b", cell.alias("cell")).groupBy("cell").applyInArrow(_cell, "v string, r string")
        step = local.groupBy("v").agg(F.min("r").alias("p"), F.collect_set("r").alias("rs"))  # at most one r for each block
        step = materialise(step, "representatives")
        release(edges)
        done["rounds"] += 1
        if blocks == 1:  # one cell held all edges: its roots are the groups
            rounds.append(step.select("v", "p"))
            break
        parents = _to_roots(step.where("v <> p").select("v", "p"), done)
        rounds.append(step.where("v = p").select("v", "p").unionByName(parents))
        across = step.select("p", F.explode("rs").alias("r")).where("r <> p")
        across = _follow(_follow(across, "p", parents).drop("moved"), "r", parents).where("p <> r")
        edges = materialise(across.select(F.least("p", "r").alias("a"), F.greatest("p", "r").alias("b")).distinct(), "edges")
        left = edges.count()
    label = rounds[0]
    for step in rounds[1:]:
        label = _follow(label, "p", step.where("v <> p")).drop("moved")
    return label.select(F.col("v").alias("id"), F.col("p").alias("group_id"))
