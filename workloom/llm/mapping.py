"""Values typed freely, mapped to the closest entry of a reference list."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.runtime import materialise, small

#: A value is mapped by similarity from this score on (0..1), if the best entry beats every other by at
#: least the margin. Other readings of a value (another keyboard layout, another alphabet) must agree
#: more closely.
SIMILAR, SIMILAR_OTHER_READING, MARGIN = 0.65, 0.75, 0.04
#: Letters of a name up to which no edit is allowed: any would make it another word.
NO_EDIT = 3
#: Reference entries that a worker's automaton holds; a larger reference is matched in blocks of so many.
REFERENCE_BLOCK = 200_000
#: Values that a task of the block-wise path maps at a time.
VALUES = 20_000
#: Answers kept per worker; the store is emptied when full, which changes no result.
REMEMBERED = 200_000
#: Copies of the answers over which rows are dealt when the answers are too many for a broadcast.
SALTS = 16

# The two keyboard layouts, key by key.
KEYS_LATIN = "qwertyuiop[]asdfghjkl;'zxcvbnm,.`"
KEYS_CYRILLIC = "йцукенгшщзхъфывапролджэячсмитьбюё"
# Latin letters that look like Cyrillic ones.
LOOK_LATIN, LOOK_CYRILLIC = "ABEKMHOPCTYXaeopcyxk", "АВЕКМНОРСТУХаеорсухк"
# Latin spelling of Cyrillic letters.
SPELLED = dict(zip("абвгдезийклмнопрстуфхцчшщъыьэюя", "a b v g d e z i y k l m n o p r s t u f kh ts ch sh shch - y - e yu ya".split())) | {"ж": "zh", "ё": "e", "ъ": "", "ь": ""}
_WORD = re.compile(r"[^\W_]+")
_CYRILLIC = re.compile(r"[А-Яа-яЁё]")


def fold(text: str) -> str:
    """Lower case, one width, ё as е, words separated by single spaces."""
    text = unicodedata.normalize("NFKC", text).lower().replace("ё", "е")
    return " ".join(_WORD.findall(text))


def spell(text: str) -> str:
    """Cyrillic spelled with Latin letters, reduced so that the usual variants coincide."""
    out = "".join(SPELLED.get(c, c) for c in text)
    for many, one in (("kh", "h"), ("shch", "sch"), ("yy", "y"), ("iy", "y"), ("ij", "y"), ("ye", "e"), ("yo", "e"), ("j", "y"), ("ts", "c")):
        out = out.replace(many, one)
    return out


def _unmix(text: str) -> str:
    """Words that mix both alphabets in Cyrillic letters only."""
    table = str.maketrans(LOOK_LATIN, LOOK_CYRILLIC)
    return re.sub(r"\w+", lambda m: m[0].translate(table) if _CYRILLIC.search(m[0]) else m[0], text)


def distance(a: str, b: str, limit: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b; limit + 1 if more than limit.

    Bit-parallel over the rows of the edit table: vertical differences are kept as two bit masks of
    len(a) bits, a third remembers the last diagonal for swaps.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, diagonal, before, score = full, 0, 0, 0, len(a)
    for c in b:
        eq = at.get(c, 0)
        swap = (((~diagonal) & eq) << 1) & before
        diagonal = ((((eq & plus) + plus) ^ plus) | eq | minus | swap) & full
        up, down = minus | (full & ~(diagonal | plus)), diagonal & plus
        score += bool(up & top) - bool(down & top)
        up, down = ((up << 1) | 1) & full, (down << 1) & full
        plus, minus, before = (down | (full & ~(diagonal | up))), up & diagonal, eq
    return min(score, limit + 1)


def _grams(s: str) -> set[str]:
    s = f" {s} "
    return {s[i : i + 2] for i in range(len(s) - 1)}


#: A place in a reading that holds a name: start, end and the entries that the name means.
Mention = tuple[int, int, frozenset]


def non_overlapping(found: Sequence[Mention]) -> list[Mention]:
    """Of all names found in a text the longest, then the longest of those that don't overlap it, and so
    on; of equally long ones the earlier."""
    out: list[Mention] = []
    for m in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
        if all(m[1] <= o[0] or o[1] <= m[0] for o in out):
            out.append(m)
    return out


def meant(found: Sequence[Mention]) -> int | None:
    """The entry that the mentions name: that of the longest one. If several entries share that name, the
    next mention that means just one of them decides; without any, none is meant."""
    chosen = non_overlapping(found)
    if not chosen:
        return None
    first = chosen[0][2]
    for _, _, keys in chosen:
        if len(keys & first) == 1:
            return next(iter(keys & first))
    return None


def nearest(scores: dict[int, tuple[float, float]]) -> tuple[float, int] | None:
    """(score, entry) of the best (score, cover) if it beats the second by MARGIN, in score or, of near
    scores, in the share of the value that it covers."""
    rank = sorted(((*v, -k) for k, v in scores.items()), reverse=True)
    if not rank:
        return None
    if len(rank) > 1 and rank[0][0] - rank[1][0] < MARGIN:
        near = sorted((r for r in rank if rank[0][0] - r[0] < MARGIN), key=lambda r: (-r[1], -r[0], -r[2]))
        if near[0][1] - near[1][1] < MARGIN:
            return None
        return near[0][0], -near[0][2]
    return rank[0][0], -rank[0][2]


class _Name:
    """A folded name: its words, all of them glued, and the two-letter parts of that."""

    __slots__ = ("words", "glued", "grams", "keys")

    def __init__(self, name: str, keys: set[int]):
        self.words, self.glued, self.keys = name.split(), name.replace(" ", ""), frozenset(keys)
        self.grams = _grams(self.glued)


def _agreement(a: str, b: str, least: float) -> float:
    """1 - edits / length of the longer, 0 below `least` or if a, the name's, is too short for edits."""
    size = max(len(a), len(b))
    limit = int((1 - least) * size + 1e-9) if len(a) > NO_EDIT else 0
    d = 0 if a == b else distance(a, b, limit) if abs(len(a) - len(b)) <= limit else limit + 1
    return 1 - d / size if d <= limit else 0.0


class Matcher:
    """Maps single values. entries: (id, name, aliases)."""

    def __init__(self, entries: Sequence[tuple[int, str, Sequence[str]]]):
        import ahocorasick

        names: dict[str, set[int]] = {}
        spelled: dict[str, set[int]] = {}
        for key, name, aliases in entries:
            for text in [name, *(aliases or [])]:
                if text and (f := fold(text)):
                    names.setdefault(f, set()).add(key)
                    if len(f) > NO_EDIT:
                        spelled.setdefault(spell(f), set()).add(key)
        self.automata, self.names, self.index = [], [], []
        for patterns in (names, spelled):
            auto = ahocorasick.Automaton()
            for p, keys in patterns.items():
                auto.add_word(f" {p} ", (len(p), frozenset(keys)))
            if patterns:
                auto.make_automaton()
            self.automata.append(auto)
            forms = [_Name(p, k) for p, k in patterns.items()]
            index: dict[str, list[int]] = {}
            for i, f in enumerate(forms):
                for g in f.grams:
                    index.setdefault(g, []).append(i)
            self.names.append(forms)
            self.index.append(index)

    def mentions(self, text: str, which: int) -> list[Mention]:
        auto = self.automata[which]
        return [(end - n, end, keys) for end, (n, keys) in auto.iter(f" {text} ")] if len(auto) and text else []

    def similar(self, text: str, which: int, least: float) -> dict[int, tuple[float, float]]:
        """entry -> (score, cover): token-set similarity. Each word of a name is paired with the value's word
        that agrees best with it; the score is the mean agreement by letters, whatever the order and
        whatever else the value holds; `cover` is the share of the value's letters that were paired.
        Since blanks get lost or misplaced, neighbouring words are also taken as one, against the
        glued name. Only names that have a quarter of their two-letter parts in the value are looked
        at, found by an inverted index of these parts."""
        words = text.split()
        glued = "".join(words)
        forms, index = self.names[which], self.index[which]
        common: dict[int, int] = {}
        for g in set().union(*map(_grams, words), _grams(glued)) if words else ():
            for i in index.get(g, ()):
                common[i] = common.get(i, 0) + 1
        out: dict[int, tuple[float, float]] = {}
        for i, n in common.items():
            f = forms[i]
            if 4 * n < len(f.grams):
                continue
            got = max(self._paired(f, words, glued, least), self._glued(f, words, glued, least))
            if got[0] >= least:
                for k in f.keys:
                    out[k] = max(out.get(k, (0.0, 0.0)), got)
        return out

    @staticmethod
    def _paired(f: _Name, words: list[str], glued: str, least: float) -> tuple[float, float]:
        if len(f.words) < 2:
            return 0.0, 0.0  # the same as glued
        free, total, cover = dict.fromkeys(range(len(words))), 0.0, 0
        for w in sorted(f.words, key=len, reverse=True):
            best = max(((_agreement(w, words[j], 0.5), -j) for j in free), default=(0.0, 0))
            if best[0]:
                total += best[0] * len(w)
                cover += len(words[-best[1]])
                del free[-best[1]]
        return total / len(f.glued), cover / len(glued)

    @staticmethod
    def _glued(f: _Name, words: list[str], glued: str, least: float) -> tuple[float, float]:
        best, most = (0.0, 0.0), len(f.glued) / least
        useful = [bool(_grams(w) & f.grams) for w in words]
        for i in range(len(words)):
            if not useful[i] and len(words) > 8:
                continue
            joined = ""
            for j in range(i, len(words)):
                joined += words[j]
                if len(joined) > most:
                    break
                if len(joined) >= least * len(f.glued):
                    best = max(best, (_agreement(f.glued, joined, least), len(joined) / len(glued)))
        return best

    @staticmethod
    def readings(value: str) -> list[tuple[str, int, float]]:
        """(text, which names, least score): the value as it is, typed in the other keyboard layout, and
        spelled in Latin letters."""
        raw = _unmix(value)
        text = fold(raw)
        out = [(text, 0, SIMILAR)]
        if text and not re.search(r"[а-я]", text):
            keyed = fold(raw.lower().translate(str.maketrans(KEYS_LATIN, KEYS_CYRILLIC)))
            out += [(keyed, 0, SIMILAR_OTHER_READING), (spell(text), 1, SIMILAR_OTHER_READING)]
        return out

    def match(self, value: str) -> int | None:
        readings = self.readings(value)
        for text, which, _ in readings:
            if found := self.mentions(text, which):
                return meant(found)
        return closest([self.similar(*r) for r in readings])


def closest(scores: Sequence[dict[int, tuple[float, float]]]) -> int | None:
    """The entry of the best-scoring reading; of equal ones the first reading's."""
    best = max((n for s in scores if (n := nearest(s))), key=lambda n: n[0], default=None)
    return best and best[1]


_MATCHERS: dict[str, tuple[Matcher, dict[str, int]]] = {}


def _matcher(entries: list[tuple], token: str) -> tuple[Matcher, dict[str, int]]:
    if token not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[token] = (Matcher(entries), {})
    return _MATCHERS[token]


def map_values(df: DataFrame, value: str, reference: DataFrame, key: str, name: str, aliases: str, out: str = "ref_id", *, block: int = REFERENCE_BLOCK) -> DataFrame:
    """df with `out`: the reference entry that the value means, -1 if it means none, null if the value
    is null or blank.

    An automaton over all names and aliases finds embedded mentions between word boundaries; of those
    that don't overlap the longest wins (see `meant`). A value without one is read in another keyboard
    layout or alphabet, and what is left goes to token-set similarity. Each distinct value is mapped
    once, by workers that hold the automaton, and the answers are joined back: broadcast if they are
    few enough, which is checked, otherwise with the rows of a frequent value dealt over SALTS tasks.
    A reference of more than `block` entries is matched block by block and the findings are put
    together before anything is decided, with the same result.

    Defined cases: ties between entries map to none, except that of equally long mentions the first
    counts; rows and further columns (but one called `out`, which is replaced) are kept; an empty
    reference maps everything to -1; entries with a null key or name are left out.
    """
    entries = reference.where(F.col(key).isNotNull() & F.col(name).isNotNull()).select(F.col(key).cast("bigint").alias("k"), F.col(name).cast("string").alias("n"), F.col(aliases).alias("a"))
    column = "_value_to_map"
    df = df.drop(out).withColumn(column, F.col(value).cast("string"))
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).alias("_one")).select(column)
    held = entries.distinct().limit(block + 1).collect()
    answers = _in_blocks(values, entries, column, out, block) if len(held) > block else _in_one(values, [tuple(r) for r in held], column, out)
    answers = materialise(answers, "answers")
    few = small(answers)
    if few is not answers:
        return df.join(few, column, "left").drop(column)
    spread = answers.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS).cast("bigint")))
    return dealt.join(spread, [column, "_salt"], "left").drop(column, "_salt")


def _in_one(values: DataFrame, entries: list[tuple], column: str, out: str) -> DataFrame:
    entries.sort(key=lambda e: (e[0], e[1]))
    token = str(hash(repr(entries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, known = _matcher(entries, token)
        for b in batches:
            ids = []
            for v in b.column(0).to_pylist():
                if v not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    got = matcher.match(v) if v.strip() else None
                    known[v] = (-1 if got is None else got) if v.strip() else None
                ids.append(known[v])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, type=pa.int64())], [column, out])

    return values.mapInArrow(run, f"{column} string, {out} bigint")


def _in_blocks(values: DataFrame, entries: DataFrame, column: str, out: str, block: int) -> DataFrame:
    """map_values for a reference of any size: slices of the distinct values meet each block of the reference
    in a task; what is found (mentions, and the entries near enough to the best of the block) is
    gathered for each value and decided on."""
    blocks, slices = -(-entries.count() // block), max(1, -(-values.count() // VALUES))
    number = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n).cast("bigint"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    asked = values.select(column, number(column, slices).alias("slice")).withColumn("block", every(blocks))
    held = entries.select("k", "n", "a", number("k", blocks).alias("block")).withColumn("slice", every(slices))
    schema = "value string, reading int, first int, last int, score double, cover double, key bigint"

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        matcher = Matcher(sorted(zip(*[right[c].to_pylist() for c in ("k", "n", "a")]), key=lambda e: (e[0], e[1])))
        rows = []
        for v in left[column].to_pylist():
            for i, (text, which, least) in enumerate(Matcher.readings(v)):
                rows += [(v, i, a, b, None, None, k) for a, b, keys in matcher.mentions(text, which) for k in keys]
                near = matcher.similar(text, which, least)
                top = max((s for s, _ in near.values()), default=0.0)
                rows += [(v, i, None, None, *s, k) for k, s in near.items() if s[0] > top - 2 * MARGIN]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        cols = list(zip(*rows)) or [[]] * 7
        return pa.table([pa.array(c, type=t) for c, t in zip(cols, kinds)], names=[c.split()[0] for c in schema.split(", ")])

    found = asked.groupBy("block", "slice").cogroup(held.groupBy("block", "slice")).applyInArrow(find, schema)

    def decide(t: pa.Table) -> pa.Table:
        places: dict[int, dict[tuple[int, int], set[int]]] = {}
        near: dict[int, dict[int, tuple[float, float]]] = {}
        for _, reading, first, last, score, cover, key in zip(*[c.to_pylist() for c in t.columns]):
            if first is not None:
                places.setdefault(reading, {}).setdefault((first, last), set()).add(key)
            else:
                near.setdefault(reading, {})[key] = (score, cover)
        if places:
            got = meant([(*at, frozenset(k)) for at, k in places[min(places)].items()])
        else:
            got = closest([near[r] for r in sorted(near)])
        return pa.table({column: t["value"].slice(0, 1), out: pa.array([-1 if got is None else got], type=pa.int64())})

    decided = found.groupBy("value").applyInArrow(decide, f"{column} string, {out} bigint")
    blank = F.trim(F.regexp_replace(column, "(?U)\\s+", " ")) == ""
    return values.join(decided, column, "left").select(column, F.when(~blank, F.coalesce(out, F.lit(-1).cast("bigint"))).alias(out))


def typed_values(df: DataFrame, record: str, value: str, names: DataFrame, name: str) -> DataFrame:
    """(record_id, value) of the rows whose value is neither null, nor blank, nor equal byte for byte
    to a name of the reference: what has to be mapped at all. Repeated rows count once."""
    rows = df.select(F.col(record).cast("string").alias("record_id"), F.col(value).alias("value"))
    rows = rows.where("value is not null and trim(regexp_replace(value, '(?U)\\\\s+', ' ')) <> ''")
    exact = [r[0] for r in names.where(F.col(name).isNotNull()).select(name).distinct().limit(2001).collect()]
    if len(exact) <= 2000:
        return rows.where(~F.col("value").isin(exact)) if exact else rows
    return rows.join(names.select(F.col(name).alias("value")).distinct(), "value", "left_anti").select("record_id", "value")
