"""One consistent form for texts that look the same but are made of different characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.runtime import materialise

#: Records of one text that a task of the pair listing meets at most; a more frequent text is dealt over
#: several tasks.
BLOCK = 2_000

# Letters of other alphabets and the Latin letter they look like.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ё": "Ë", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ї": "Ï", "Ј": "J", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "ё": "ë", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ї": "ï",
    "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "µ": "μ",
    "Ӏ": "I", "ӏ": "l", "Ѵ": "V", "ѵ": "v", "Ⅰ": "I", "Ⅴ": "V", "Ⅹ": "X", "Ⅼ": "L", "Ⅽ": "C", "Ⅾ": "D", "Ⅿ": "M",
    "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
    "‐": "-", "‑": "-", "ʼ": "’", "∕": "/", "⁄": "/",
}
# Characters that look like several letters in a row.
JOINED = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "Ⅵ": "VI", "Ⅶ": "VII", "Ⅷ": "VIII", "Ⅸ": "IX", "Ⅺ": "XI", "Ⅻ": "XII"}
# Pictures, the only characters that a joiner or a variation selector visibly changes.
PICTURES = r"[\x{203C}-\x{2049}\x{2122}-\x{21AA}\x{2300}-\x{27BF}\x{2934}-\x{2B55}\x{3030}-\x{303D}\x{3297}-\x{3299}\x{1F000}-\x{1FAFF}\x{FE0F}\x{1F3FB}-\x{1F3FF}]"


# Characters below U+1F000 that are drawn as pictures without a variation selector.
PICTURES_BY_DEFAULT = (
    r"\x{231A}\x{231B}\x{23E9}-\x{23EC}\x{23F0}\x{23F3}\x{25FD}\x{25FE}\x{2614}\x{2615}\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}\x{26AA}\x{26AB}\x{26BD}\x{26BE}"
    r"\x{26C4}\x{26C5}\x{26CE}\x{26D4}\x{26EA}\x{26F2}\x{26F3}\x{26F5}\x{26FA}\x{26FD}\x{2705}\x{270A}\x{270B}\x{2728}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}"
    r"\x{2795}-\x{2797}\x{27B0}\x{27BF}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}"
)
# Characters from U+1F000 on that are drawn as text without a variation selector.
TEXT_BY_DEFAULT = (
    r"\x{1F170}-\x{1F189}\x{1F202}\x{1F237}\x{1F321}-\x{1F32C}\x{1F336}\x{1F37D}\x{1F396}-\x{1F39F}\x{1F3CB}-\x{1F3CE}\x{1F3D4}-\x{1F3DF}\x{1F3F3}-\x{1F3F7}\x{1F43F}\x{1F441}"
    r"\x{1F4FD}\x{1F549}\x{1F54A}\x{1F56F}-\x{1F579}\x{1F587}-\x{1F590}\x{1F5A5}-\x{1F5FA}\x{1F6CB}\x{1F6CD}-\x{1F6CF}\x{1F6E0}-\x{1F6E9}\x{1F6F0}-\x{1F6F3}"
)


def width_forms() -> dict[str, str]:
    """Characters that differ from another one only in width or in where a line may break."""
    out = {}
    for cp in range(0x80, 0x30000):
        c = chr(cp)
        kind = unicodedata.decomposition(c).partition(" ")[0]
        plain = unicodedata.normalize("NFKC", c)
        if unicodedata.category(c) == "Zs":
            out[c] = " "
        elif kind in ("<wide>", "<narrow>", "<noBreak>") and len(plain) == 1:
            out[c] = plain
    return out


def invisible() -> str:
    """A character class of what leaves no mark: format characters, fillers, variation selectors."""
    keep = {0x200D, 0xFE0E, 0xFE0F, *range(0x600, 0x606), 0x6DD, 0x70F, 0x8E2, 0x110BD}
    cps = [c for c in range(0x80, 0xE1000) if c not in keep and unicodedata.category(chr(c)) == "Cf"]
    cps += [0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE0E), *range(0xE0100, 0xE01F0)]
    return "[" + "".join(f"\\x{{{c:X}}}" for c in sorted(set(cps))) + "]"


def form_sql(column: str) -> str:
    """The DuckDB expression of the consistent form.

    Invisible characters go first, so that none hides what a joiner or a selector belongs to. A joiner
    stays between two pictures only, a variation selector only after a character that is not drawn as a
    picture without it. Width forms and spaces become ordinary ones, combining marks are composed,
    look-alike letters become the Latin one. Case, ё against е, digits, punctuation and line breaks stay.
    """
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    wide = width_forms()
    pic = PICTURES
    text_like = f"[{TEXT_BY_DEFAULT}]|[\\x{{203C}}-\\x{{303D}}\\x{{3297}}-\\x{{3299}}]"
    seen = f"regexp_replace({column}, {quote(invisible())}, '', 'g')"
    plain = f"regexp_replace({seen}, '([{PICTURES_BY_DEFAULT}])\\x{{FE0F}}', '\\1', 'g')"
    marked = f"regexp_replace({plain}, '({text_like})\\x{{FE0F}}', '\\1' || chr(57345), 'g')"
    joined = f"regexp_replace({marked}, '({pic}|' || chr(57345) || ')\\x{{200D}}', '\\1' || chr(57344), 'g')"
    between = f"regexp_replace({joined}, chr(57344) || '({pic[:-1].replace('[', '[^', 1)}]|$)', '\\1', 'g')"
    bare = f"regexp_replace({between}, {quote('[' + chr(0x200D) + chr(0xFE0E) + chr(0xFE0F) + ']')}, '', 'g')"
    back = f"replace(replace({bare}, chr(57344), chr(8205)), chr(57345), chr(65039))"
    narrow = f"translate({back}, {quote(''.join(wide))}, {quote(''.join(wide.values()))})"
    for one, many in JOINED.items():
        narrow = f"replace({narrow}, '{one}', '{many}')"
    composed = f"nfc_normalize({narrow})"
    return f"translate({composed}, {quote(''.join(LOOKALIKES))}, {quote(''.join(LOOKALIKES.values()))})"


_DUCK: dict[str, object] = {}


def _connection():
    """One DuckDB per Python worker, single-threaded and small."""
    if "con" not in _DUCK:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        _DUCK["con"], _DUCK["sql"] = con, form_sql("text")
    return _DUCK["con"], _DUCK["sql"]


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    con, sql = _connection()
    for batch in batches:
        con.register("rows_", pa.Table.from_batches([batch]))
        got = con.sql(f"select field, id, text, {sql} as form from rows_").to_arrow_table()
        con.unregister("rows_")
        yield from got.to_batches()


def forms(texts: DataFrame) -> DataFrame:
    """texts(field, id, text) with `form`, the consistent form. Rows are kept one for one; a null text
    has a null form, an empty text an empty one. Runs in DuckDB inside each Arrow partition."""
    return texts.select("field", "id", "text").mapInArrow(_forms, "field string, id string, text string, form string")


def _told(texts: DataFrame) -> DataFrame:
    """(field, id, f, t), once each: two 64-bit hashes of the form and of the text of every record. Written
    to the shared folder, so that each form is made once however often it is looked at."""
    wanted = texts.where("text is not null and id is not null")
    both = lambda c: F.struct(F.xxhash64(c).alias("x"), F.xxhash64(F.lit(1), c).alias("y"))
    return materialise(forms(wanted).select("field", "id", both(F.col("form")).alias("f"), both(F.col("text")).alias("t")), "forms").distinct()


def lookalike_pairs(texts: DataFrame) -> DataFrame:
    """(field, id_a, id_b), id_a < id_b: different records of a field whose texts differ in their
    characters but have one form. Texts equal byte for byte are no pair; null texts and null ids
    are left out; repeated rows count once; an empty table gives an empty result.

    Texts are compared by two 64-bit hashes of the form and of the text. Pairs are listed between the
    *distinct texts* of a form first and expanded to records only there, so a text that a third of
    all rows have costs nothing unless it has look-alikes, and then what the result itself holds;
    the records of a text with more than BLOCK of them are dealt over several tasks.
    """
    rows = _told(texts)
    counts = materialise(rows.groupBy("field", "f", "t").agg(F.count("*").alias("n")), "texts")
    mixed = counts.groupBy("field", "f").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    kinds = counts.join(mixed, ["field", "f"], "left_semi").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    a, b = kinds.alias("a"), kinds.alias("b")
    texts2 = a.join(b, (F.col("a.field") == F.col("b.field")) & (F.col("a.f") == F.col("b.f")) & (F.col("a.t") < F.col("b.t")))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    texts2 = texts2.select("a.field", F.col("a.t").alias("ta"), F.col("b.t").alias("tb"), every("a.blocks").alias("sa"), F.col("b.blocks").alias("blocks"))
    texts2 = texts2.select("field", "ta", "sa", "tb", every("blocks").alias("sb"))
    member = rows.join(kinds.select("field", "f", "t", "blocks"), ["field", "f", "t"]).select("field", "t", "id", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("s"))
    left = texts2.join(member.select("field", F.col("t").alias("ta"), F.col("s").alias("sa"), F.col("id").alias("ia")), ["field", "ta", "sa"]).select("field", "tb", "sb", "ia")
    pairs = left.join(member.select("field", F.col("t").alias("tb"), F.col("s").alias("sb"), "id"), ["field", "tb", "sb"])
    return pairs.where("ia <> id").select("field", F.least("ia", "id").alias("id_a"), F.greatest("ia", "id").alias("id_b")).distinct()


def lookalike_classes(texts: DataFrame) -> DataFrame:
    """(field, id, class_id, texts), one row for each record and form: class_id is the least id of the records
    of the field that look the same, `texts` how many different texts they have. The form without
    pairs: its size is that of the input. Cases as in lookalike_pairs."""
    rows = _told(texts)
    per = rows.groupBy("field", "f", "t").agg(F.min("id").alias("first")).groupBy("field", "f").agg(F.min("first").alias("class_id"), F.count("*").alias("texts"))
    return rows.select("field", "id", "f").distinct().join(per, ["field", "f"]).select("field", "id", "class_id", "texts")
