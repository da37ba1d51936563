"""Held-out evaluation texts inside a training corpus, whole, in part or with words replaced."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.llm.words import hashes, mix, words
from workloom.runtime import materialise

# The spaced seeds. A window of 12 words is hashed at the marked positions only, so a
# replaced word under a gap doesn't hide it; any 12 equal words in a row hit all of them.
MASKS = ("111011001111", "110101101011", "101110110101")
SPAN = 12
#: Words of all evaluation texts together up to which their seeds are sent to every worker; more are
#: joined in Spark instead.
BROADCAST_WORDS = 2_000_000
#: Tasks over which the documents of one seed are dealt when seeds are joined.
SALTS = 8
#: Of the words that an overlap spans around a hit, at most one in so many may be replaced.
REPLACED_ONE_IN = 6


def _marks(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def seeds(h: np.ndarray, known: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(mask number, starts, hashes) of the windows of word hashes; with `known`, only of those
    windows whose marked words are all known."""
    n = len(h) - SPAN + 1
    for m, mask in enumerate(MASKS):
        if n <= 0:
            yield m, np.empty(0, np.int64), np.empty(0, np.uint64)
            continue
        marks = _marks(mask)
        if known is None:
            at = np.arange(n)
        else:
            ok = known[marks[0] : marks[0] + n].copy()
            for p in marks[1:]:
                ok &= known[p : p + n]
            at = np.flatnonzero(ok)
        out = np.full(len(at), m + 1, dtype=np.uint64)
        for p in marks:
            out = mix(out ^ h[at + p])
        yield m, at, out


class Diagonal:
    """A document and an item laid side by side at one shift: which of their words are equal, once for
    all hits of that shift."""

    def __init__(self, doc: np.ndarray, item: np.ndarray, d: int, i: int):
        back, ahead = min(d, i), min(len(doc) - d, len(item) - i)
        self.start = d - back
        self.same = doc[d - back : d + ahead] == item[i - back : i + ahead]
        self.wrong = np.concatenate(([0], np.cumsum(~self.same)))
        self.seen: list[tuple[int, int]] = []

    def overlap(self, d: int) -> tuple[int, int, int] | None:
        """(longest run of equal words, words spanned, of them equal) of the overlap around the hit whose
        window starts at word d of the document; None if the window lies in an overlap seen before.

        The overlap reaches as far as, counted from the window, at most one word in REPLACED_ONE_IN is
        replaced. Words equal to the item's always extend it, so a run that touches a window inside a
        seen overlap is inside too, and nothing is lost by passing over that window."""
        lo = d - self.start
        hi = min(lo + SPAN, len(self.same))
        if any(a <= lo and hi <= b for a, b in self.seen):
            return None
        wrong = self.wrong
        ends = np.arange(hi, len(self.same) + 1)
        good = ends[(wrong[ends] - wrong[lo]) * REPLACED_ONE_IN <= ends - lo]
        hi = int(good[-1]) if len(good) else hi
        starts = np.arange(0, lo + 1)
        good = starts[(wrong[hi] - wrong[starts]) * REPLACED_ONE_IN <= hi - starts]
        lo = int(good[0]) if len(good) else lo
        self.seen.append((lo, hi))
        part = self.same[lo:hi]
        hits = np.flatnonzero(part)
        if not len(hits):
            return 0, 0, 0
        part = part[hits[0] : hits[-1] + 1]
        gaps = np.flatnonzero(np.concatenate(([True], ~part, [True])))
        return int(np.diff(gaps).max() - 1), len(part), int(part.sum())


class Items:
    """The evaluation texts' word hashes and, per mask, their sorted seed hashes."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids = ids
        self.words = [hashes(words(t or "")) for t in texts]
        self.vocabulary = np.unique(np.concatenate([*self.words, np.empty(0, np.uint64)]))
        rows: list[list] = [[[], [], []] for _ in MASKS]
        for n, h in enumerate(self.words):
            for m, at, s in seeds(h):
                rows[m][0].append(s)
                rows[m][1].append(np.full(len(at), n))
                rows[m][2].append(at)
        self.index = []
        for s, n, at in rows:
            if not s:
                self.index.append((np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)))
                continue
            s, n, at = np.concatenate(s), np.concatenate(n), np.concatenate(at)
            order = np.argsort(s, kind="stable")
            self.index.append((s[order], n[order], at[order]))

    def size(self) -> int:
        return sum(map(len, self.words))


def _best(found: dict, key, got: tuple[int, int, int]) -> None:
    if key not in found or got > found[key]:
        found[key] = got


def _scan(texts: list[str | None], items: Items) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Best overlap for each (text number, item number)."""
    parts, starts, at = [], [], 0
    gap = np.zeros(SPAN, dtype=np.uint64)
    for t in texts:
        h = hashes(words(t or ""))
        starts.append(at)
        parts += [h, gap]
        at += len(h) + SPAN
    if not parts:
        return {}
    flat = np.concatenate(parts)
    where = np.minimum(np.searchsorted(items.vocabulary, flat), max(len(items.vocabulary) - 1, 0))
    known = (items.vocabulary[where] == flat) if len(items.vocabulary) else np.zeros(len(flat), bool)
    first = np.array(starts)
    found: dict = {}
    diagonals: dict[tuple[int, int, int], Diagonal] = {}
    for m, pos, s in seeds(flat, known):
        index, of, inside = items.index[m]
        lo, hi = np.searchsorted(index, s, "left"), np.searchsorted(index, s, "right")
        for k in np.flatnonzero(hi > lo):
            d = int(np.searchsorted(first, pos[k], "right") - 1)
            at = int(pos[k] - first[d])
            for j in range(lo[k], hi[k]):
                n, i = int(of[j]), int(inside[j])
                key = (d, n, at - i)
                if key not in diagonals:
                    end = first[d + 1] - SPAN if d + 1 < len(first) else len(flat) - SPAN
                    diagonals[key] = Diagonal(flat[first[d] : end], items.words[n], at, i)
                if (got := diagonals[key].overlap(at)) is not None:
                    _best(found, (d, n), got)
    return found


_ITEMS: dict[str, Items] = {}


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, *, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(doc, item, run, span, same): for every document that shares a spaced seed with an item, the
    best overlap around the hits: its longest run of equal words, the words it spans and how many
    of them are equal. `run` >= 12 means twelve consecutive words of the item.

    Words are compared in lower case with nothing but spacing and punctuation between them. The
    corpus is read once and not shuffled while the items have at most `broadcast_words` words
    (their number is checked); beyond that the seeds of both sides are joined in Spark, and only
    documents with hits are read again.

    Defined cases: null and empty texts and texts of fewer than 12 words share nothing; null ids
    are left out; repeated rows count once; items with equal texts are all reported; empty tables
    give an empty result; further columns are not looked at.
    """
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    tests = items.where(F.col(item).isNotNull()).select(F.col(item).cast("bigint").alias("item"), F.col(item_text).cast("string").alias("test")).distinct()
    weight = tests.agg(F.sum(F.size(F.split("test", r"\W+")))).first()[0] or 0
    schema = "doc bigint, item bigint, run int, span int, same int"
    if weight > broadcast_words:
        return _joined(docs, tests, schema)
    rows = sorted((r[0], r[1]) for r in tests.collect() if r[1] is not None)
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    token = f"{len(rows)}-{hash(str(rows))}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _ITEMS:
            _ITEMS.clear()
            _ITEMS[token] = Items([r[0] for r in sent.value], [r[1] for r in sent.value])
        known = _ITEMS[token]
        for b in batches:
            ids, found = b.column(0), _scan(b.column(1).to_pylist(), known)
            yield _rows([(ids[d].as_py(), known.ids[i], *got) for (d, i), got in found.items()])

    return _one(docs.mapInArrow(run, schema))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], ["doc", "item", "run", "span", "same"])


def _one(found: DataFrame) -> DataFrame:
    best = found.groupBy("doc", "item").agg(F.max(F.struct("run", "span", "same")).alias("m"))
    return best.select("doc", "item", "m.*")


def _seed_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, own, out = b.column(0).to_pylist(), [], []
            for i, t in zip(ids, b.column(1).to_pylist()):
                s = np.unique(np.concatenate([x for _, _, x in seeds(hashes(words(t or "")))]))
                own.append(np.full(len(s), i, dtype=np.int64))
                out.append(s)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), pa.array(np.concatenate(out).view(np.int64))], [key, "seed"])

    return df.select(key, text).mapInArrow(run, f"{key} bigint, seed bigint")


def _joined(docs: DataFrame, tests: DataFrame, schema: str) -> DataFrame:
    """leaks by a join of the seeds. A seed that many documents have is dealt over SALTS tasks; the rows
    of documents with hits are read again and each batch is scanned against its own items at once."""
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt")
    seeds_of_tests = materialise(_seed_rows(tests, "item", "test").distinct(), "test-seeds").select("item", "seed", copies)
    hits = _seed_rows(docs, "doc", "text").select("*", salt).join(seeds_of_tests, ["seed", "salt"]).select("doc", "item").distinct()
    both = materialise(hits, "hits").join(docs, "doc").join(tests, "item").select("doc", "text", "item", "test")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = list(zip(*[c.to_pylist() for c in b.columns]))
            texts, tested = sorted({(d, t) for d, t, _, _ in wanted if t is not None}), sorted({(i, t) for _, _, i, t in wanted if t is not None})
            got = _scan([t for _, t in texts], Items([i for i, _ in tested], [t for _, t in tested]))
            asked = {(d, i) for d, _, i, _ in wanted}
            named = [(texts[x][0], tested[y][0], best) for (x, y), best in got.items()]
            yield _rows([(d, i, *best) for d, i, best in named if (d, i) in asked])

    return _one(both.mapInArrow(run, schema))
