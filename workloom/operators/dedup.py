"""Near-duplicate postings across sources: exact, by prefix filter, and by banded minhashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.operators import sketch
from workloom.runtime import materialise, small

#: Likeness from which two postings are the same, and the words of a run.
SAME, WORDS = 0.88, 4
#: Postings of one run that a task of the candidate join meets on the copied side.
POSTINGS = 2_000
#: Minhashes, bands, and bits by which two one-bit signatures may differ (J = 0.88 differs in 8 of 128
#: on average with a standard deviation below 3).
HASHES, BANDS, BITS_APART = 128, 32, 23


def words(text) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0))


def shingles(words: F.Column) -> F.Column:
    """The distinct runs of WORDS words as 64-bit hashes, in ascending order; a shorter text is one
    run, an empty one none. `words` must be a column, not an expression: the lambda reads it per run."""

    def run(i):
        return F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)])

    many = F.transform(F.sequence(F.lit(0), F.size(words) - WORDS), run)
    return F.array_sort(F.array_distinct(F.when(F.size(words) >= WORDS, many).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))))


def contents(docs: DataFrame, key: str, text) -> tuple[DataFrame, DataFrame]:
    """(reps(rep, runs), members(id, rep)): documents with the same runs share the least of their ids.
    Null ids and documents without words are left out."""
    told = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id"), words(text).alias("words"))
    sets = told.where("size(words) > 0").select("id", shingles(F.col("words")).alias("runs"))
    sets = materialise(sets.withColumn("c", F.struct(F.xxhash64("runs"), F.xxhash64(F.lit(1), F.col("runs")), F.size("runs"))), "shingles")
    firsts = sets.groupBy("c").agg(F.min("id").alias("rep"))
    members = materialise(sets.select("id", "c").distinct().join(firsts, "c").select("id", "rep", "c"), "members")
    reps = sets.join(members.where("id = rep").select("id", "c"), ["id", "c"], "left_semi").dropDuplicates(["id"]).select(F.col("id").alias("rep"), "runs")
    return materialise(reps, "reps"), members.select("id", "rep")


def _prefixes(reps: DataFrame, t: float) -> DataFrame:
    """(rep, n, run, often, rank): the rarest n - ceil(t n) + 1 runs of each, by the sketched frequency; two alike
    sets share one. Runs that only one content has are left out."""
    shared = reps.sparkSession.sparkContext.broadcast(sketch.frequencies(reps, "runs"))  # 8 MB, whatever the data

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.repeat(np.arange(len(batch)), sizes)
            often = sketch.estimate(shared.value, flat)
            order = np.lexsort((flat, often, own))  # the same order of the runs in every content
            rank, n = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(sizes, sizes)
            keep = (rank < n - np.ceil(n * t - 1e-9) + 1) & (often[order] > 1)
            columns = [batch.column(0).take(pa.array(own[order][keep])), pa.array(n[keep].astype(np.int32)), pa.array(flat[order][keep]), pa.array(often[order][keep]), pa.array(rank[keep].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "n", "run", "often", "rank"])

    return reps.select("rep", "runs").mapInArrow(build, "rep string, n int, run bigint, often bigint, rank int")


def alike(reps: DataFrame, t: float = SAME) -> DataFrame:
    """(a, b, jaccard), a < b: all pairs of contents at least t alike. Exact."""
    p = _prefixes(reps, t).withColumn("salts", F.ceil(F.col("often") / POSTINGS).cast("int"))
    p = materialise(p, "prefixes")
    x = p.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("x")
    y = p.withColumn("salt", F.pmod(F.hash("rep"), F.col("salts"))).alias("y")
    sizes = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * t - 1e-9
    # what is left after a common run bounds the overlap
    left = F.least(F.col("x.n") - F.col("x.rank"), F.col("y.n") - F.col("y.rank"))
    far = left >= (F.col("x.n") + F.col("y.n")) * (t / (1 + t)) - 1e-9
    met = x.join(y, (F.col("x.run") == F.col("y.run")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.rep") < F.col("y.rep")) & sizes & far)
    return verified(met.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct(), reps, t)


def verified(candidates: DataFrame, reps: DataFrame, t: float) -> DataFrame:
    """The candidates whose exact likeness is at least t."""
    c = materialise(candidates, "candidates")
    both = c.join(reps.select(F.col("rep").alias("a"), F.col("runs").alias("ra")), "a").join(reps.select(F.col("rep").alias("b"), F.col("runs").alias("rb")), "b")
    common = F.size(F.array_intersect("ra", "rb"))
    j = common / (F.size("ra") + F.size("rb") - common)
    return both.withColumn("j", j).where(F.col("j") >= t - 1e-12).select("a", "b", F.round("j", 4).alias("jaccard"))


def minhash_candidates(reps: DataFrame) -> DataFrame:
    """(a, b), a < b: contents that agree in a band of minhashes and in most bits of a one-bit signature.
    The signature is tested where the bands meet, so unlike pairs of a large bucket are never written."""
    rng = np.random.default_rng(5)
    odd = rng.integers(0, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
    add = rng.integers(0, 2**63, HASHES, dtype=np.uint64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                lists = batch.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                sig = np.empty((len(batch), HASHES), dtype=np.uint64)
                for k in range(HASHES):
                    h = (flat * odd[k] + add[k]) ^ (flat >> np.uint64(29))
                    h = h * odd[k]
                    sig[:, k] = np.minimum.reduceat(h ^ (h >> np.uint64(32)), at[:-1])
                bands = np.zeros((len(batch), BANDS), dtype=np.uint64)
                for k in range(HASHES):
                    bands[:, k % BANDS] = (bands[:, k % BANDS] ^ sig[:, k]) * np.uint64(0x9E3779B97F4A7C15)
                bits = np.packbits((sig & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64).view(np.int64)
                ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), BANDS)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(batch))), pa.array(bands.reshape(-1).view(np.int64)), *[pa.array(np.repeat(bits[:, i], BANDS)) for i in (0, 1)]],
                    ["rep", "band", "h", "b0", "b1"],
                )

    rows = materialise(reps.select("rep", "runs").mapInArrow(build, "rep string, band int, h bigint, b0 bigint, b1 bigint"), "bands")
    many = rows.groupBy("band", "h").agg(F.count("*").alias("k")).where(F.col("k") > POSTINGS)
    many = small(materialise(many.select("band", "h", F.ceil(F.col("k") / POSTINGS).alias("salts")), "buckets"))
    # a large bucket is dealt over several tasks on one side and copied to them on the other
    rows = rows.join(many, ["band", "h"], "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("bigint")))
    x = rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))).alias("x")
    y = rows.withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts"))).alias("y")
    apart = F.bit_count(F.col("x.b0").bitwiseXOR(F.col("y.b0"))) + F.bit_count(F.col("x.b1").bitwiseXOR(F.col("y.b1")))
    on = (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.rep") < F.col("y.rep")) & (apart <= BITS_APART)
    return x.join(y, on).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def cross_source_pairs(docs: DataFrame, key: str, source: str, text, t: float = SAME) -> DataFrame:
    """(id_a, id_b, jaccard), id_a < id_b: records of different sources at least t alike; copies have 1.0. Null ids,
    sources and documents without words are in no pair."""
    reps, members = contents(docs, key, text)
    pairs = alike(reps, t).unionByName(reps.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(1.0).alias("jaccard")))
    told = materialise(members.join(docs.where(F.col(source).isNotNull()).select(F.col(key).cast("string").alias("id"), F.col(source).alias("s")).distinct(), "id"), "sources")
    mixed = told.groupBy("rep").agg(F.collect_set("s").alias("ss"))  # as many as there are sources
    near = pairs.join(mixed.select(F.col("rep").alias("a"), F.col("ss").alias("sa")), "a").join(mixed.select(F.col("rep").alias("b"), F.col("ss").alias("sb")), "b")
    near = near.where((F.size("sa") > 1) | (F.size("sb") > 1) | (F.col("sa") != F.col("sb"))).select("a", "b", "jaccard")  # before records are listed
    x, y = (told.select(F.col("rep").alias(r), F.col("id").alias(i), F.col("s").alias(f"s{r}")) for r, i in (("a", "i"), ("b", "j")))
    both = near.join(x, "a").join(y, "b").where("sa <> sb and i <> j")
    return both.select(F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"), "jaccard").distinct()


def across_sources(docs: DataFrame, key: str, source: str, text, priority: dict[str, int], t: float = SAME) -> DataFrame:
    """The documents that stay when of alike ones from different sources only those of the source with
    the least priority number are kept. Decided per content and its alike contents, so copies are
    never paired. Sources without a number come last; documents without words stay."""
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in priority.items() for v in kv]), F.col(source)), F.lit(len(priority)))
    ranked = docs.select(F.col(key).cast("string").alias("id"), rank.alias("rank"))
    reps, members = contents(docs, key, text)
    pairs = alike(reps, t)
    near = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(reps.select(F.col("rep").alias("a"), F.col("rep").alias("b")))
    of = members.join(ranked, "id").groupBy("rep").agg(F.min("rank").alias("best"))
    best = near.join(of.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.min("best").alias("best"))
    losers = members.join(ranked, "id").join(best.withColumnRenamed("a", "rep"), "rep").where("rank > best").select("id")
    return docs.join(losers, docs[key].cast("string") == losers["id"], "left_anti")
