"""Reading level of each document by regularised ordinal regression on graded documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.llm.words import hashes, mix
from workloom.runtime import materialise, small

#: Graded documents that the regression is fitted on at most (chosen by the hash of their id), and
#: one in so many of them held out to calibrate the cut between the levels.
TRAIN_DOCS, HELD_ONE_IN = 8_000, 5
#: Strength of the penalty on the weights.
PENALTY = 3.0
#: Counters of the corpus' word frequencies: their number doesn't grow with the corpus.
SKETCH = 1 << 20

# Words that join clauses.
CONNECTIVES = frozenset(
    "and but or so because although though while whereas whereby whose which that if unless until when after before since therefore thus hence "
    "however moreover furthermore nevertheless notwithstanding consequently correspondingly accordingly inasmuch insofar provided thereby despite "
    "и а но или что чтобы если когда пока так как хотя поскольку потому поэтому который которая которое которые которого которой чего чей чья чьё "
    "тогда причём однако следовательно соответственно вследствие ввиду несмотря при условии равно тем не менее между тем".split()
)
_TOKEN = re.compile(r"\w+|[.!?…\n]|[,;:()—–]")
_END = frozenset(".!?…\n")
FEATURES = ("long", "very_long", "letters", "spread", "sentence", "depth", "diverse", "rare", "rarest", "joined", "cyrillic", "size")


class _Vocabulary:
    """What is known of each distinct token, by number, for as long as the worker lives or up to LIMIT."""

    LIMIT = 500_000

    def __init__(self):
        self.number: dict[str, int] = {}
        self.rows: list[tuple[int, int, int, int]] = []  # kind, letters, Cyrillic, connective
        self.slots = np.empty(0, np.int64)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.number) > self.LIMIT:
            self.__init__()
        try:
            return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            fresh = [t for t in dict.fromkeys(tokens) if t not in self.number]
            for t in fresh:
                kind = 0 if (t[0].isalnum() or t[0] == "_") else 1 if t in _END else 2
                self.number[t] = len(self.rows)
                self.rows.append((kind, len(t), int("а" <= t[0] <= "я" or t[0] == "ё"), int(t in CONNECTIVES)))
            slots = (mix(hashes(fresh)) % np.uint64(SKETCH)).astype(np.int64)
            self.slots = np.concatenate((self.slots, slots))
            self.table = np.array(self.rows, dtype=np.int64)
            return np.fromiter(map(self.number.__getitem__, tokens), np.int64, len(tokens))


_WORDS: dict[str, _Vocabulary] = {}


def _tokens(texts: list[str | None]) -> tuple[_Vocabulary, np.ndarray, np.ndarray]:
    v = _WORDS.setdefault("v", _Vocabulary())
    lists = [_TOKEN.findall(t.lower()) if t else [] for t in texts]
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    numbers = v.numbers([w for x in lists for w in x]) if sizes.sum() else np.empty(0, np.int64)
    return v, numbers, np.repeat(np.arange(len(texts)), sizes)


def corpus_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """How often the words of each of SKETCH slots occur in the whole corpus, all documents counted.
    Each partition sums into its own slots; only SKETCH sums come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.int64)
        for b in batches:
            v, numbers, _ = _tokens(b.column(0).to_pylist())
            if len(numbers):
                each = np.bincount(numbers, minlength=len(v.rows))
                is_word = v.table[:, 0] == 0
                total += np.bincount(v.slots[is_word], weights=each[is_word], minlength=SKETCH).astype(np.int64)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 18):
            some = at[i : i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["slot", "n"])

    sums = docs.select(F.col(text).cast("string")).mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SKETCH, dtype=np.int64)
    out[sums["slot"].to_numpy()] = sums["n"].to_numpy()
    return out


def _measure(texts: list[str | None], rarity: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; zeros for a text without words."""
    n = len(texts)
    v, numbers, doc = _tokens(texts)
    out = np.zeros((n, len(FEATURES)))
    if not len(numbers):
        return out
    kind, letters, cyr, conn = v.table[numbers].T
    word = kind == 0
    sums = lambda x, at=doc: np.bincount(at, weights=x, minlength=n)
    w = np.maximum(sums(word), 1)
    rare = rarity[v.slots[numbers]] * word
    pair = np.unique(doc[word] * np.int64(len(v.rows)) + numbers[word])
    types = np.bincount(pair // len(v.rows), minlength=n)
    # a sentence ends at a mark that follows a word or comma, so "..." and blank lines end one only
    ends = (kind == 1) & np.concatenate(([False], (kind[:-1] != 1)))
    sentences = np.maximum(sums(ends), 1)
    mean = sums(letters * word) / w
    out[:, 0] = sums(word * (letters >= 9)) / w
    out[:, 1] = sums(word * (letters >= 13)) / w
    out[:, 2] = mean
    out[:, 3] = np.sqrt(np.maximum(sums(letters**2 * word) / w - mean**2, 0))
    out[:, 4] = np.log(w / sentences + 1)
    out[:, 5] = sums(kind == 2) / sentences + sums(conn) / sentences
    out[:, 6] = types / np.sqrt(w)
    out[:, 7] = sums(rare) / w
    out[:, 8] = np.sqrt(sums(rare**2) / w)
    out[:, 9] = sums(conn) / w
    out[:, 10] = sums(cyr * word) / w
    out[:, 11] = np.log(w)
    out[sums(word) == 0] = 0
    return out


def features(docs: DataFrame, key: str, text: str, frequencies: np.ndarray) -> DataFrame:
    """(id, words, x): the features of every document. Whole texts, no shuffle."""
    total = max(1, int(frequencies.sum()))
    rarity = docs.sparkSession.sparkContext.broadcast(-np.log((frequencies + 1) / (total + 1)).astype(np.float32))  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _measure(b.column(1).to_pylist(), rarity.value)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            lists = pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x[:, 2] > 0), lists], ["id", "has_words", "x"])

    rows = docs.select(F.col(key).cast("bigint"), F.col(text).cast("string"))
    return rows.mapInArrow(run, "id bigint, has_words boolean, x array<double>")


def _spread(x: np.ndarray) -> np.ndarray:
    """Features, each also by alphabet, since words of the two languages differ in length."""
    c = (x[:, FEATURES.index("cyrillic")] > 0.5).astype(float)[:, None]
    return np.hstack((x, x * c, c))


class Ordinal:
    """P(level <= k) = 1 / (1 + exp(w x - cut_k)), fitted by maximum likelihood with a ridge penalty."""

    def fit(self, x: np.ndarray, y: np.ndarray, levels: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, steps: int = 1500) -> Ordinal:
        self.levels = levels
        x = _spread(x)
        self.mean, self.scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
        z, k = (x - self.mean) / self.scale, len(levels) - 1
        if not k:
            self.w, self.cut = np.zeros(z.shape[1]), np.empty(0)
            return self
        rank = np.searchsorted(levels, y)
        share = np.cumsum(np.bincount(rank, weights=weight, minlength=k + 1))[:-1] / weight.sum()
        share = np.clip(share, 1e-3, 1 - 1e-3)
        cut0 = np.log(share / (1 - share))
        p = np.concatenate((np.zeros(z.shape[1]), [cut0[0]], np.log(np.maximum(np.diff(cut0), 1e-3))))
        m, v = np.zeros_like(p), np.zeros_like(p)
        d = z.shape[1]
        for t in range(1, steps + 1):
            g = self._gradient(p, z, rank, weight, d, k, penalty)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * min(1.0, 3 * (1 - t / steps) + 0.02)
        self.w, self.cut = p[:d], self._cuts(p[d:])
        return self

    @staticmethod
    def _cuts(q: np.ndarray) -> np.ndarray:
        return np.concatenate((q[:1], q[0] + np.cumsum(np.exp(q[1:]))))

    def _gradient(self, p, z, rank, weight, d, k, penalty):
        cut = self._cuts(p[d:])
        s = z @ p[:d]
        edge = np.concatenate(([-np.inf], cut, [np.inf]))
        cdf = lambda e: 1 / (1 + np.exp(-np.clip(e, -40, 40)))
        up, lo = cdf(edge[rank + 1] - s), cdf(edge[rank] - s)
        dup, dlo = up * (1 - up), lo * (1 - lo)
        like = np.maximum(up - lo, 1e-9)
        each = weight / like / weight.sum()
        gs = each * (dup - dlo)
        gw = z.T @ gs + penalty * p[:d] / weight.sum()
        gcut = np.zeros(k)
        np.add.at(gcut, np.minimum(rank, k - 1), np.where(rank < k, -each * dup, 0))
        np.add.at(gcut, np.maximum(rank - 1, 0), np.where(rank > 0, each * dlo, 0))
        tail = np.cumsum(gcut[::-1])[::-1]
        gq = np.concatenate((tail[:1], tail[1:] * np.exp(p[d + 1 :])))
        return np.concatenate((gw, gq))

    def score(self, x: np.ndarray) -> np.ndarray:
        return ((_spread(x) - self.mean) / self.scale) @ self.w

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        edge = np.concatenate(([-np.inf], self.cut, [np.inf]))
        cdf = 1 / (1 + np.exp(-np.clip(edge[None, :] - self.score(x)[:, None], -40, 40)))
        return np.diff(cdf, axis=1)

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Ordinal:
        """Moves each cut, by at most a few tenths of the distance to its neighbours, to where the
        fewest graded documents lie on the wrong side of it; of equally good places the middle."""
        s, rank = self.score(x), np.searchsorted(self.levels, y)
        cuts = []
        for k, c in enumerate(self.cut):
            span = np.diff(self.cut).min() if len(self.cut) > 1 else 2.0
            near = np.linspace(c - span / 3, c + span / 3, 61)
            wrong = np.array([(weight * ((s > e) != (rank > k))).sum() for e in near])
            good = near[wrong <= wrong.min() + 1e-9]
            cuts.append(good[len(good) // 2])
        self.cut = np.maximum.accumulate(np.array(cuts)) if cuts else self.cut
        return self


def reading_levels(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(id, level, confidence, score) of every document: the level of reading_labels' scale that is
    most probable, its probability, and the continuous score for filtering.

    Features: word length, lexical diversity, rarity of the words in the whole corpus, connectives,
    clauses per sentence and sentence length, each also by alphabet. The regression is fitted on at
    most `train_docs` graded documents, each grade of a document counting by itself, so raters who
    disagree weigh less; one in HELD_ONE_IN of these documents is held out to place the cuts.

    Defined cases: a null text, an empty one or one without words has level and score null; null
    grades (abstentions) and grades of unknown documents are not used; with grades of one level
    only, that level is given to every document; with no grade every level is null; rows are kept
    one for one; an empty table gives an empty result. Further columns are not looked at.
    """
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    measured = materialise(features(docs, "_id", "_text", corpus_frequencies(docs, "_text")), "features")
    graded = labels.where("level is not null and doc_id is not null").select(F.col("doc_id").alias("id"), "rater", "level").distinct()
    chosen = small(graded.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(train_docs))
    # a row for each level that a document was given, with how often: as many as documents times levels
    given = graded.join(chosen, "id", "left_semi").groupBy("id", "level").agg(F.count("*").alias("n"))
    known = measured.where("has_words").join(given, "id").select("id", "x", "level", "n").dropDuplicates(["id", "level"]).orderBy("id", "level").toArrow()
    model = _fit(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, has, lists = b.column(0), b.column(1).to_numpy(zero_copy_only=False).astype(bool), b.column(2)
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            if model is None:
                none = pa.nulls(len(ids))
                yield pa.RecordBatch.from_arrays([ids, none.cast(pa.int32()), none.cast(pa.float64()), none.cast(pa.float64())], ["id", "level", "confidence", "score"])
                continue
            p = model.probabilities(x)
            level = model.levels[p.argmax(1)].astype(np.int32)
            cols = [pa.array(level, mask=~has), pa.array(p.max(1), mask=~has), pa.array(model.score(x), mask=~has)]
            yield pa.RecordBatch.from_arrays([ids, *cols], ["id", "level", "confidence", "score"])

    return measured.mapInArrow(run, "id bigint, level int, confidence double, score double")


def _fit(known: pa.Table) -> Ordinal | None:
    if not known.num_rows:
        return None
    x = np.array(known["x"].to_pylist())
    y, ids = known["level"].to_numpy(), known["id"].to_numpy()
    n = known["n"].to_numpy().astype(float)
    _, of = np.unique(ids, return_inverse=True)
    weight = n / np.bincount(of, weights=n)[of]
    held = (mix(ids.astype(np.uint64)) % np.uint64(HELD_ONE_IN)) == 0
    if held.all() or len(np.unique(y[~held])) < len(np.unique(y)):
        held[:] = False
    model = Ordinal().fit(x[~held], y[~held], np.unique(y[~held]), weight[~held])
    if held.any():
        model.calibrate(x[held], y[held], weight[held])
    return model
