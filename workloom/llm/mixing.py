"""Records of several sources mixed to target shares of tokens, placed along a training schedule."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workloom.operators.cumulative import running_totals
from workloom.runtime import materialise, small

#: Token vocabulary: ranks of a public byte-level BPE and the pattern that cuts texts into pieces.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# The public pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose number of tokens a worker remembers; the store is emptied when full.
REMEMBERED = 500_000
#: How far the weight of a source may move between the start and the end of training.
TILT = 0.5

# No piece of the pattern goes on from a visible character to white space, so the tokens of a text
# are those of its runs of white space with the visible run after them.
_CHUNK = re.compile(r"\s*\S+|\s+")
_STATE: dict[str, tuple[object, dict[str, int]]] = {}


def _encoder(path: str):
    if path not in _STATE:
        import tiktoken

        with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _STATE[path] = (tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), {})
    return _STATE[path]


def token_count(text: str, path: str = TOKENIZER) -> int:
    """Number of tokens of the whole text."""
    encoder, known = _encoder(path)
    parts = _CHUNK.findall(text)
    try:
        return sum(map(known.__getitem__, parts))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        for p in set(parts):
            if p not in known:
                known[p] = len(encoder.encode_ordinary(p))
        return sum(map(known.__getitem__, parts))


def with_tokens(docs: DataFrame, key: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, source, tokens) of every document; 0 for a null or empty text. The corpus stays where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [token_count(t, tokenizer) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, type=pa.int64())], ["id", "source", "tokens"])

    docs.sparkSession.sparkContext.addFile(tokenizer)  # to every worker, which may lack the driver's files
    rows = docs.select(F.col(key).cast("bigint"), F.col(source).cast("string"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "id bigint, source string, tokens bigint")


#: A source's weight over the training, as pieces: from the moment `at`, when the share `done` of its tokens is
#: placed, its weight is w and changes by `slope`; the whole integral is 1.
KNOTS = "array<struct<done:double,at:double,w:double,slope:double>>"


def schedule_knots(schedule: DataFrame) -> DataFrame:
    """(source, knots) from (source, at, weight): the weight of a source at moments from 0 to 1, in a straight line
    between them, before the first and after the last as there. The weights are scaled so that their
    integral is 1: a schedule says when a source comes, its target share how much of it. Null or
    negative weights are 0, moments outside 0..1 are left out, of several weights of a moment the
    greatest counts; a source whose weights are all 0 comes evenly."""
    rows = schedule.where("source is not null and at between 0 and 1").groupBy("source", F.col("at").cast("double").alias("at")).agg(F.max(F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).cast("double").alias("w"))
    ends = rows.groupBy("source").agg(F.min_by("w", "at").alias("first"), F.max_by("w", "at").alias("last"))
    ends = ends.select("source", F.explode(F.array(F.struct(F.lit(0.0).alias("at"), F.col("first").alias("w")), F.struct(F.lit(1.0).alias("at"), F.col("last").alias("w")))).alias("e")).select("source", "e.*")
    rows = rows.unionByName(ends).groupBy("source", "at").agg(F.max("w").alias("w"))
    of = Window.partitionBy("source").orderBy("at")  # the moments of one source
    rows = rows.select("*", F.lead("at").over(of).alias("to"), F.lead("w").over(of).alias("v")).where("to is not null")
    rows = rows.withColumn("area", (F.col("w") + F.col("v")) / 2 * (F.col("to") - F.col("at")))
    rows = rows.select("*", F.sum("area").over(of).alias("upto"), F.sum("area").over(Window.partitionBy("source")).alias("whole"))
    part = F.struct(((F.col("upto") - F.col("area")) / F.col("whole")).alias("done"), "at", (F.col("w") / F.col("whole")).alias("w"), ((F.col("v") - F.col("w")) / (F.col("to") - F.col("at")) / F.col("whole")).alias("slope"))
    return rows.where("whole > 0").groupBy("source").agg(F.array_sort(F.collect_list(part)).cast(KNOTS).alias("knots"))


def plan(sized: DataFrame, targets: DataFrame, total: int | None = None, schedule: DataFrame | None = None) -> DataFrame:
    """One row for each target source: share and cap, supply (tokens and records that it has), demand
    (share of the total), got (demand, or as much as the cap allows), shortfall and knots (when).

    total: tokens of the whole mix; by default what the target sources hold once. A source with no
    records has got 0 and its whole demand as shortfall. Shares are taken relative to their sum;
    a source named twice counts with its summed share and its smallest cap; null shares and caps
    are 0; null sources are left out.

    schedule: see schedule_knots; sources that it doesn't name come evenly. Without one, the weight of a
    source moves in a straight line from share * (1 - tilt) to share * (1 + tilt) over the training:
    sources that may be repeated more come later, and since the tilts have mean 0 by share the
    weights sum to 1 at every moment.
    """
    named = targets.where("source is not null").groupBy("source").agg(
        F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("w"), F.greatest(F.min(F.coalesce("max_repeats", F.lit(0))), F.lit(0)).alias("cap")
    )
    all_w = named.agg(F.sum("w").alias("all_w"), F.try_divide(F.sum(F.col("w") * F.col("cap")), F.sum("w")).alias("mean_cap"))
    supply = sized.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("supply"), F.count("*").alias("records"))
    rows = named.join(supply, "source", "left").fillna(0, ["supply", "records"]).crossJoin(F.broadcast(all_w))  # one row
    far = rows.agg(F.max(F.abs(F.col("cap") - F.col("mean_cap"))).alias("far"), F.sum("supply").alias("once"))  # one row
    rows = rows.crossJoin(F.broadcast(far))
    share = F.coalesce(F.try_divide("w", "all_w"), F.lit(0.0))
    demand = F.round(share * (F.lit(total) if total is not None else F.col("once"))).cast("bigint")
    got = F.least(demand, F.col("supply") * F.col("cap"))
    tilt = F.coalesce(F.try_divide(F.col("cap") - F.col("mean_cap"), "far"), F.lit(0.0)) * TILT
    if schedule is None:
        rows = rows.withColumn("knots", _one_piece(1 - tilt, 2 * tilt))
    else:
        rows = rows.join(schedule_knots(schedule), "source", "left").withColumn("knots", F.coalesce("knots", _one_piece(F.lit(1.0), F.lit(0.0))))
    return rows.select(
        "source", share.alias("target_share"), F.col("cap").cast("bigint").alias("cap"), "supply", "records", demand.alias("demand"), got.alias("got"),
        (demand - got).alias("shortfall"), "knots",
    )


def _one_piece(w: Column, slope: Column) -> Column:
    return F.array(F.struct(F.lit(0.0).alias("done"), F.lit(0.0).alias("at"), w.alias("w"), slope.alias("slope"))).cast(KNOTS)


def position_on(df: DataFrame, u: Column, knots: str, out: str) -> DataFrame:
    """df with `out`, the moment in 0..1 at which a source has supplied the share u of its tokens: the inverse of
    its integrated weight, piece by piece."""
    # the piece is picked in a step of its own: its lambda must not be repeated in one expression
    df = df.withColumn("_u", F.greatest(u, F.lit(0.0))).withColumn("_piece", F.element_at(F.filter(knots, lambda k: k["done"] <= F.col("_u")), -1))
    rest, w, slope = F.greatest(F.col("_u") - F.col("_piece.done"), F.lit(0.0)), F.col("_piece.w"), F.col("_piece.slope")
    root = F.sqrt(F.greatest(w * w + 2 * slope * rest, F.lit(0.0)))
    moment = F.col("_piece.at") + F.coalesce(F.try_divide(2 * rest, w + root), F.lit(0.0))
    return df.withColumn(out, F.least(F.lit(1.0), moment)).drop("_u", "_piece")


def position(u: Column, tilt: Column) -> Column:
    """The moment in 0..1 at which a source whose weight runs from 1 - tilt to 1 + tilt has supplied the
    share u of its tokens: the inverse of the integrated schedule (1 - tilt) x + tilt x^2."""
    a = 1 - tilt
    return F.when(F.abs(tilt) < 1e-9, u).otherwise(2 * u / (a + F.sqrt(a * a + 4 * tilt * u)))


def mix(docs: DataFrame, targets: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text", total: int | None = None, schedule: DataFrame | None = None, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, copies, shares).

    records: (id, source, tokens, repeats, first_position) of every record of a target source that is
    used, repeats being at most the source's cap. copies: (id, source, tokens, copy, position), one row
    for each copy, range-sorted by position, the moment of training from 0 to 1. shares: (source,
    target_share, reached_share, cap, most_repeats, supply, demand, reached, shortfall), all in tokens;
    the shortfall is what the cap keeps a source from giving, rounding to whole records aside.

    A source's records are laid out in a fixed shuffled order (hash of id). Its demand is read off
    that line, passing over it again and again: a record is used once in every whole pass, and once
    more if it lies before the point where the demand is met (the record over the point counts if
    more than half of it lies before). The cumulative token of a copy is turned into its position by
    inverting the source's integrated weight schedule (`schedule`, or that of `plan`).

    Defined cases: null and empty texts have no tokens and are not used; null ids are used like
    others; records of other sources are left out; repeated ids are records of their own; a source
    with no records, a share of 0 or a cap of 0 is reported and gives nothing; empty tables give
    empty results. Further columns are not looked at.
    """
    sized = materialise(with_tokens(docs, key, source, text, tokenizer), "sized")
    shares = materialise(plan(sized, targets, total, schedule), "plan")
    used = small(shares.where("got > 0"))
    line = sized.where("tokens > 0").join(used.select("source"), "source", "left_semi").select("*", F.xxhash64("id", F.lit(5)).alias("_at"))
    laid = running_totals(line, ["source"], ["_at", "id", "tokens"], "tokens", upto="to", whole="all")
    s = laid.join(used.select("source", "got", "cap", "knots"), "source")
    passes = F.expr("got div supply_").cast("bigint")
    s = s.withColumn("supply_", F.col("all")).withColumn("passes", passes)
    more = ((F.col("to") - F.col("tokens") / 2) < (F.col("got") - F.col("passes") * F.col("supply_"))) & (F.col("passes") < F.col("cap"))
    s = s.withColumn("repeats", F.col("passes") + F.when(more, 1).otherwise(0)).where("repeats > 0")
    s = materialise(s.select("id", "source", "tokens", "repeats", "to", "supply_", "got", "knots"), "mixed")

    def share(copy: Column) -> Column:
        middle = copy * F.col("supply_") + F.col("to") - F.col("tokens") / 2
        return F.least(F.lit(1.0), middle / F.col("got"))

    records = position_on(s, share(F.lit(0)), "knots", "first_position").select("id", "source", "tokens", "repeats", "first_position")
    copies = s.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))
    copies = position_on(copies, share(F.col("copy")), "knots", "position").select("id", "source", "tokens", (F.col("copy") + 1).alias("copy"), "position")
    copies = copies.repartitionByRange("position", "id").sortWithinPartitions("position", "id")
    sums = s.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("reached"), F.max("repeats").alias("most_repeats"))
    both = shares.join(sums, "source", "left").fillna(0, ["reached", "most_repeats"])
    whole = both.agg(F.sum("reached").alias("whole"))  # one row
    report = both.crossJoin(F.broadcast(whole)).select(
        "source", "target_share", F.coalesce(F.try_divide("reached", "whole"), F.lit(0.0)).alias("reached_share"),
        "cap", "most_repeats", "supply", "demand", "reached", "shortfall",
    )
    return records, copies, report
