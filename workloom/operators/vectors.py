"""Exact cosine neighbours for a set of query vectors, in blocks, and the incremental encoding plan."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workloom.runtime import materialise

#: Query vectors and stored vectors of one block.
QUERY_BLOCK, BLOCK = 1024, 8192


def _blocks(df: DataFrame, size: int, prefix: str) -> DataFrame:
    """(block, dim, ids, values): vectors of one dimension gathered in blocks of about `size`, each block one row of
    ids and one of all numbers, end to end."""
    n = max(1, -(-df.count() // size))
    rows = df.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(f"{prefix}block"), F.size("v").alias(f"{prefix}dim"))
    got = rows.agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("x"))  # about `size` rows
    return got.select(f"{prefix}block", f"{prefix}dim", F.col("x.id").alias(f"{prefix}ids"), F.flatten("x.v").alias(f"{prefix}v"))


def neighbours(queries: DataFrame, stored: DataFrame, key: str, vector: str, k: int, *, include_self: bool = False) -> DataFrame:
    """(query, rank, neighbour, cosine): the k stored vectors nearest to each query; ties by id.

    Blocks of queries meet blocks of stored vectors of the same dimension, each meeting is one matrix
    product that keeps k rows per query, and the k best of these are taken. Nothing is approximated.
    Null vectors, null ids and vectors of length 0 are left out. To search an active set only, filter
    `stored` before: stale vectors then take no place among the k.
    """
    shape = lambda df: df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    q, s = materialise(_blocks(shape(queries), QUERY_BLOCK, "q"), "queries"), _blocks(shape(stored), BLOCK, "s")
    number = q.select("qblock", "qdim").distinct().withColumn("i", F.row_number().over(Window.partitionBy("qdim").orderBy("qblock")) - 1)  # one row a block
    many = number.groupBy("qdim").agg(F.count("*").alias("n"))
    copies = s.join(many, F.col("sdim") == F.col("qdim")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1))).drop("qdim", "n")
    blocks = q.join(number, ["qblock", "qdim"]).withColumn("i", F.col("i").cast("bigint")).withColumnRenamed("qdim", "sdim")
    met = copies.join(blocks, ["sdim", "i"]).select("qids", "qv", "sids", "sv")

    def unit(batch: pa.RecordBatch, at: int, ids: str, values: str) -> tuple[np.ndarray, np.ndarray]:
        names = np.asarray(batch.column(ids)[at].values)
        m = np.asarray(batch.column(values)[at].values).reshape(len(names), -1)
        size = np.linalg.norm(m, axis=1)
        return names[size > 0], m[size > 0] / size[size > 0][:, None]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                (qi, qv), (si, sv) = unit(b, i, "qids", "qv"), unit(b, i, "sids", "sv")
                if not len(qi) or not len(si):
                    continue
                sim = np.round(qv @ sv.T, 12)
                if not include_self:
                    sim[qi[:, None] == si[None, :]] = -np.inf
                top = np.argsort(-sim, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(sim, top, 1).reshape(-1)
                ok = np.isfinite(value)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qi, top.shape[1])[ok]), pa.array(si[top.reshape(-1)][ok]), pa.array(value[ok])], ["query", "neighbour", "cosine"])

    found = met.mapInArrow(best, "query bigint, neighbour bigint, cosine double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "neighbour", "cosine")


def hashed_embedding(size: int) -> Callable[[list[str]], np.ndarray]:
    """A stand-in for an encoder where no model is at hand: words are hashed to signed places, the sum has
    length 1. Texts that share words are near, nothing more."""
    import hashlib

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), size), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % size] += 1.0 if h >> 63 else -1.0
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    return embed


def encode(docs: DataFrame, key: str, text: str, size: int, embed: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """(id, vector, text_hash) of every document with a text: `embed` gets the texts of an Arrow batch at a time and
    returns one vector of `size` numbers for each. Null texts and ids are left out."""
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("string").alias("t"), F.substring(F.sha2(F.col(text), 256), 1, 16).alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = np.asarray(embed(b.column(1).to_pylist()), dtype=np.float32)
            if m.shape != (len(b), size):
                raise ValueError(f"the encoder gave {m.shape}, needed is {(len(b), size)}")
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * size), pa.array(m.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, b.column(2)], ["id", "vector", "text_hash"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, vector array<float>, text_hash string")


def rerank(hits: DataFrame, stored: DataFrame, key: str, vector: str, *, weight: float = 0.5, top: int = 20) -> DataFrame:
    """hits(key, score) with a vector ordered anew: the centroid of the `top` best hits' vectors is the query, and the
    result is weight * cosine to it + (1 - weight) * score scaled to 0..1; ties by key. A hit without a vector
    keeps its scaled score alone; without any vector the order of the scores stays."""
    dims = stored.where(F.col(vector).isNotNull()).select(F.col(key).alias("_k"), F.col(vector).cast("array<double>").alias("_v"))
    h = materialise(hits.where(F.col(key).isNotNull()).join(dims, F.col(key) == F.col("_k"), "left").select(F.col(key), F.col("score").cast("double").alias("score"), "_v"), "hits")
    best = h.where("_v is not null").orderBy(F.desc("score"), key).limit(top)
    parts = best.select(F.posexplode("_v")).groupBy("pos").agg(F.avg("col").alias("c"))
    centre = parts.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"]).alias("_c"))  # one row
    most = h.agg(F.max("score").alias("_most"))  # one row
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = h.crossJoin(F.broadcast(centre)).crossJoin(F.broadcast(most)).withColumn("_s", F.coalesce(F.try_divide("score", "_most"), F.lit(0.0)))
    cosine = F.try_divide(dot(F.col("_v"), F.col("_c")), F.sqrt(dot(F.col("_v"), F.col("_v")) * dot(F.col("_c"), F.col("_c"))))
    scored = scored.withColumn("cosine", F.when(F.size("_c") == F.size("_v"), cosine))
    final = F.when(F.col("cosine").isNotNull(), weight * F.col("cosine") + (1 - weight) * F.col("_s")).otherwise((1 - weight) * F.col("_s"))
    return scored.select(key, "score", "cosine", final.alias("final")).orderBy(F.desc("final"), F.desc("score"), key)


def encoding_plan(docs: DataFrame, stored: DataFrame, key: str, text_hash: str) -> DataFrame:
    """What to do with each id: encode (new), encode again (its text changed), keep, or drop (gone)."""
    a = docs.select(F.col(key).alias("id"), F.col(text_hash).alias("a")).distinct()
    b = stored.select(F.col(key).alias("id"), F.col(text_hash).alias("b")).distinct()
    what = F.when(F.col("has_b").isNull(), "new").when(F.col("has_a").isNull(), "drop").when(F.col("a").eqNullSafe(F.col("b")), "keep").otherwise("changed")
    return a.withColumn("has_a", F.lit(1)).join(b.withColumn("has_b", F.lit(1)), "id", "full_outer").select("id", what.alias("plan"))
