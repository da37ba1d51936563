"""Records that share most of their content, found without comparing every pair.

Likeness of two records is the Jaccard similarity of their sets of word runs. A set is a 0/1 vector
over all runs, so the likeness of sets with a and b runs is at least t exactly if their Hamming
distance is at most the budget alpha * (a + b), alpha = (1 - t) / (1 + t). The runs are dealt to
segments laid in a ring, each with its share of the budget; records meet in the index of a segment and
must keep within the budgets along a chain of segments from there on (pigeonring) before their sets
are compared. Every test is a necessary one, so no pair is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.llm import components
from workloom.llm.words import hashes, mix, shingles, words
from workloom.operators.sketch import estimate, frequencies
from workloom.runtime import materialise, small

#: Segments of the ring that runs are dealt to by hash, and segments of a chain.
SEGMENTS, CHAIN = 8, 4
#: Bits to which the Hamming vector of one segment is folded; CHAIN of them fill a bigint.
BITS = 16
#: Greatest size of a chain that is kept; a longer one counts as that long, which prunes less.
MOST = (1 << 16) - 1
#: Records of one run that a join task meets at most on the dealt side.
POSTINGS = 2_000
#: Records of one content that are paired at a time; a larger content is dealt over several blocks.
BLOCK = 500
#: Copies of the representatives of contents with several records, over which these are dealt.
SALTS = 8


def _sets(texts: list[str | None], size: int) -> pa.Array:
    """The distinct runs of `size` words of each text, ascending, for a whole batch at a time."""
    tokens = [words(t) if t else [] for t in texts]
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    run = shingles(hashes([w for t in tokens for w in t]), size)
    own = np.repeat(np.arange(len(tokens)), lengths)
    inside = own[: len(run)] == own[size - 1 :] if len(run) else np.empty(0, bool)  # not across two texts
    run, own = run[inside], own[: len(run)][inside]
    order = np.lexsort((run, own))
    run, own = run[order], own[order]
    first = np.concatenate(([True], (run[1:] != run[:-1]) | (own[1:] != own[:-1]))) if len(run) else np.empty(0, bool)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(own[first], minlength=len(tokens))))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(run[first].view(np.int64)))


def run_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, runs): the distinct runs of `size` words of each text, as hashes in ascending order.
    A null or short text has none. Whole texts are read, once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _sets(batch.column(1).to_pylist(), size)], ["id", "runs"])

    return docs.select(F.col(key).cast("string"), F.col(text).cast("string")).mapInArrow(build, "id string, runs array<bigint>")


def _ring(flat: np.ndarray, own: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment of each run; per record and segment, packed by BITS: the folded Hamming vectors of the chain
    that starts there, and its sizes after 1, 2.. segments). Two folded vectors differ in at most as many
    places as the sets do."""
    h = mix(flat.view(np.uint64) ^ np.uint64(0x5BF03635))
    seg, bit = (h % np.uint64(SEGMENTS)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(BITS)).astype(np.int64)
    at = own * SEGMENTS + seg
    sizes = np.bincount(at, minlength=docs * SEGMENTS).reshape(docs, SEGMENTS)
    parity = np.bincount(at * BITS + bit, minlength=docs * SEGMENTS * BITS).reshape(docs, SEGMENTS, BITS) & 1
    words_ = (parity << np.arange(BITS)).sum(2).astype(np.uint64)
    folds, packed, so_far = np.zeros((docs, SEGMENTS), np.uint64), np.zeros((docs, SEGMENTS), np.uint64), np.zeros((docs, SEGMENTS), np.int64)
    for k in range(CHAIN):
        shift = np.uint64(BITS * k)
        folds |= np.roll(words_, -k, axis=1) << shift
        so_far = so_far + np.roll(sizes, -k, axis=1)
        packed |= np.minimum(so_far, MOST).astype(np.uint64) << shift
    return seg, folds.view(np.int64), packed.view(np.int64)


def segment_index(sets: DataFrame, sketch: np.ndarray, t: float) -> DataFrame:
    """The index by which alike records meet: (key, no, pos, fold, sizes), a few rows for each segment.

    If one segment of two records differs within its budget, at least t of its runs are common. So, in
    the order of the sketched frequency, rarest first, the first common run is among the first
    n - ceil(t n) + 1 of the segment's n runs in both: these are its keys. A run that only one record
    has is left out. `pos` is rank * 4 + role: a run that many records have is dealt over several
    keys, on one side (role 1) each record to one of them, on the other (role 0) to all of them, so no
    task meets more than POSTINGS records of a run on the dealt side; other runs have both roles (2).
    """
    shared = sets.sparkSession.sparkContext.broadcast(sketch)  # 8 MB, whatever the data
    most = 1 << 14  # records at a time, so that the sort key below fits 64 bits

    def rows(no: np.ndarray, flat: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        often = estimate(shared.value, flat)
        seg, folds, sizes = _ring(flat, own, len(no))
        low = flat.view(np.uint64) & np.uint64(0xFFFFFF)
        rarity = (np.minimum(often, (1 << 22) - 1).astype(np.uint64) << np.uint64(24)) | low
        place = (own * SEGMENTS + seg).astype(np.uint64)
        # stable, and the runs of a record ascend: the order of the runs is the same in every record
        order = np.argsort((place << np.uint64(46)) | rarity, kind="stable")
        place = place[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else np.empty(0, np.int64)
        n = np.diff(np.concatenate((starts, [len(place)])))
        rank, n = np.arange(len(place)) - np.repeat(starts, n), np.repeat(n, n)
        keep = (rank < n - np.ceil(t * n - 1e-9) + 1) & (often[order] > 1)
        order, rank, place = order[keep], rank[keep], place[keep]
        run, salts, who = flat[order].view(np.uint64), np.maximum(1, -(-often[order] // POSTINGS)), place // SEGMENTS
        number, fold, packed = no[who], folds.reshape(-1)[place], sizes.reshape(-1)[place]
        hot = np.flatnonzero(salts > 1)
        dealt = (mix(number.view(np.uint64)) % salts.astype(np.uint64)).astype(np.int64)
        copy = np.repeat(hot, salts[hot])
        salt = np.arange(len(copy)) - np.repeat(np.cumsum(salts[hot]) - salts[hot], salts[hot])
        take, salt = np.concatenate((np.arange(len(run)), copy)), np.concatenate((np.where(salts > 1, dealt, 0), salt))
        role = np.concatenate((np.where(salts > 1, 1, 2), np.zeros(len(copy), np.int64)))
        keys = np.where(salt > 0, mix(run[take] ^ mix(salt.astype(np.uint64))), run[take]).view(np.int64)
        columns = [keys, number[take], rank[take] * 4 + role, fold[take], packed[take]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "no", "pos", "fold", "sizes"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), most):
                batch = whole.slice(at, most)
                lists = batch.column(1)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                yield rows(batch.column(0).to_numpy(), lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(batch)), sizes))

    return sets.select("no", "runs").mapInArrow(build, "key bigint, no bigint, pos bigint, fold bigint, sizes bigint")


def ring(a: str, b: str, t: float, chain: int = CHAIN) -> Column:
    """Pigeonring. A segment's budget is alpha times its runs in both records; the differences of all
    segments, laid in a ring, sum to at most the sum of the budgets if the records are alike. Then
    some segment with runs starts a chain whose cumulative difference stays within the cumulative
    budget after each of its segments. The chain that starts at the segment where the two rows met is
    tested, by the folded vectors and the sizes, both of which differ at most as much as the sets do.
    """
    alpha = (1 - t) / (1 + t)
    apart = F.col(f"{a}.fold").bitwiseXOR(F.col(f"{b}.fold"))

    def size(side: str, k: int) -> Column:
        return F.shiftrightunsigned(F.col(f"{side}.sizes"), BITS * k).bitwiseAND(MOST)

    def within(k: int) -> Column:
        mask = (1 << (BITS * (k + 1))) - 1
        differ = F.bit_count(apart.bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("bigint")))
        x, y = size(a, k), size(b, k)
        return F.greatest(differ, F.abs(x - y)) <= (x + y) * alpha + 1e-9

    return reduce(Column.__and__, [within(k) for k in range(chain)])


def candidates(index: DataFrame, t: float, chain: int = CHAIN) -> DataFrame:
    """(a, b), a < b: pairs of records that meet in a segment's index and whose chain from there on stays
    within its budgets. One shuffle serves both sides of the join: its conditions name both, so
    neither side is filtered before it, and pairs are tested as they are met."""
    alpha = (1 - t) / (1 + t)
    x, y = index.alias("x"), index.alias("y")
    rank = lambda side: F.shiftright(F.col(f"{side}.pos"), 2)
    role = lambda side: F.col(f"{side}.pos").bitwiseAND(3)
    runs = lambda side: F.col(f"{side}.sizes").bitwiseAND(MOST)
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.no") < F.col("y.no")) & (role("x") * 4 + role("y")).isin(1, 10)
    # the runs before the first common one are in one of the two only
    early = (rank("x") + rank("y") <= (runs("x") + runs("y")) * alpha + 1e-9) | (F.greatest(runs("x"), runs("y")) == MOST)
    return x.join(y.hint("merge"), met & early & ring("x", "y", t, chain)).select(F.col("x.no").alias("a"), F.col("y.no").alias("b")).distinct()


def contents(docs: DataFrame, key: str, text: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(sets, members): sets(no, id, runs) with a number for each row, and members(id, no, rep, first): `rep` is
    the number and `first` the id of the first record with the same set of runs. Only contents of
    several rows are joined back, over SALTS copies, so the rows of a frequent one are spread."""
    made = run_sets(docs.where(F.col(key).isNotNull()), key, text, size).where("size(runs) > 0")
    sets = materialise(made.withColumn("no", F.monotonically_increasing_id()), "runs")
    same = ["x", "y", "n"]
    light = sets.select("id", "no", F.xxhash64("runs").alias("x"), F.xxhash64(F.lit(1), F.col("runs")).alias("y"), F.size("runs").alias("n"))
    firsts = light.groupBy(*same).agg(F.min(F.struct("id", "no")).alias("f"), F.count("*").alias("k")).where("k > 1").select(*same, F.col("f.id").alias("f_id"), F.col("f.no").alias("f_no"))
    firsts = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    dealt = light.withColumn("salt", F.pmod(F.xxhash64("no"), F.lit(SALTS).cast("bigint"))).join(firsts, [*same, "salt"], "left")
    return sets, materialise(dealt.select("id", "no", F.coalesce("f_no", "no").alias("rep"), F.coalesce("f_id", "id").alias("first")), "members")


def similar_pairs(docs: DataFrame, key: str, text: str, *, size: int = 5, t: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs(a, b, likeness) of representatives at least t alike, a < b, and
    members(id, rep, first): every record with at least one run, the number of its content and the
    least id among the records with the same set of runs.

    Defined cases: null and short texts have no runs and are alike to nothing; null ids are left
    out; a record repeated with the same text counts once, and an id with several texts is each of
    them; an empty table gives two empty results.
    """
    sets, members = contents(docs, key, text, size)
    unique = sets.join(small(members.where("no <> rep").select("no")), "no", "left_anti")
    found = materialise(candidates(segment_index(unique, frequencies(unique, "runs"), t), t), "candidates")
    ends = small(found.select(F.col("a").alias("no")).unionAll(found.select(F.col("b").alias("no"))).distinct())
    needed = sets.join(ends, "no", "left_semi").select("no", "runs")
    left, right = needed.select(F.col("no").alias("a"), F.col("runs").alias("ra")), needed.select(F.col("no").alias("b"), F.col("runs").alias("rb"))
    both = found.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    common = F.size(F.array_intersect("ra", "rb"))
    both = both.select("a", "b", common.alias("_common"), (F.size("ra") + F.size("rb")).alias("_all")).withColumn("_h", F.col("_all") - 2 * F.col("_common"))
    alike = both.where(F.col("_h") * (1 + t) <= F.col("_all") * (1 - t) + 1e-9)
    pairs = alike.select("a", "b", (F.col("_common") / (F.col("_common") + F.col("_h"))).alias("likeness"))
    return pairs, members.select("id", "rep", "first").distinct()


def expand(pairs: DataFrame, members: DataFrame, listed: int | None = None) -> DataFrame:
    """(id_a, id_b), id_a < id_b: the pairs of records behind pairs of contents and copies.

    Every pair is listed, whatever the size of a content: its records are dealt over blocks of about
    BLOCK, and block meets block, so that no task holds a content as a whole. Only a caller that gives
    `listed` gets links instead of pairs: a content with more records than that is represented by its
    first one, with which each of its copies and the records alike to it are paired.
    """
    m, star = members.select("id", "rep", "first"), None
    if listed is not None:
        many = small(m.groupBy("rep").agg(F.count("*").alias("k")).where(F.col("k") > listed).select("rep", F.lit(True).alias("many")))
        told = m.join(many, "rep", "left")
        star = told.where("many").select(F.col("first").alias("i"), F.col("id").alias("j"))
        m = told.where("many is null or id = first").select("id", "rep", "first")
    sizes = materialise(m.groupBy("rep").agg(F.count("*").alias("k")).withColumn("blocks", F.ceil(F.col("k") / BLOCK)), "sizes")
    large = small(sizes.where("blocks > 1").select("rep", "blocks"))
    m = m.join(large, "rep", "left").withColumn("block", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1).cast("bigint"))))
    of = lambda side: sizes.select(F.col("rep").alias(side), F.col("blocks").alias(f"{side}_blocks"))
    blocks = lambda side: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{side}_blocks") - 1)).alias(f"{side}_block")
    between = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").select("a", "b", "b_blocks", blocks("a")).select("a", "a_block", "b", blocks("b"))
    inside = sizes.where("k > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.col("blocks").alias("a_blocks"), F.col("blocks").alias("b_blocks"))
    inside = inside.select("a", "b", "b_blocks", blocks("a")).select("a", "a_block", "b", blocks("b")).where("a_block <= b_block")
    met = between.unionByName(inside)
    x, y = (m.select(F.col("rep").alias(s), F.col("block").alias(f"{s}_block"), F.col("id").alias(i)) for s, i in (("a", "i"), ("b", "j")))
    every = met.join(x, ["a", "a_block"]).join(y, ["b", "b_block"])
    # two records of one block of one content meet from either side
    every = every.where((F.col("a") != F.col("b")) | (F.col("a_block") != F.col("b_block")) | (F.col("i") < F.col("j"))).select("i", "j")
    if star is not None:
        every = every.unionByName(star)
    every = every.where("i <> j")
    return every.select(F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b")).distinct()


def classes(docs: DataFrame, key: str, text: str, *, size: int = 5, t: float = 0.8) -> DataFrame:
    """One row for each record with a text that has runs: id, class_id (the least id of all records
    linked to it directly or through others) and links (contents its own is alike to). No pair of
    copies is listed: the size is that of the input and of the links between different contents."""
    pairs, members = similar_pairs(docs, key, text, size=size, t=t)
    pairs = materialise(pairs, "pairs")
    first = members.where("id = first").select("rep", "first").distinct()
    linked = pairs.select("a", "b").join(first.select(F.col("rep").alias("a"), F.col("first").alias("fa")), "a").join(first.select(F.col("rep").alias("b"), F.col("first").alias("fb")), "b")
    same = members.where("id <> first").select(F.col("id").alias("fa"), F.col("first").alias("fb"))  # copies, and ids of several contents
    group = components.connected(linked.select("fa", "fb").unionByName(same), "fa", "fb")
    ends = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("links"))
    one = members.join(ends, "rep", "left").groupBy("id").agg(F.max(F.coalesce("links", F.lit(0))).alias("links"))
    return one.join(group, "id", "left").select("id", F.coalesce("group_id", "id").alias("class_id"), "links")
