from workloom.llm import lookalikes


def forms(spark, *texts):
    df = spark.createDataFrame([("t", str(i), t, "x") for i, t in enumerate(texts)], "field string, id string, text string, form string")
    return {int(r.id): r.form for r in lookalikes.forms(df).collect()}


def test_one_form(spark):
    same = ["Разработчик 1С №2", "Раз­работчик 1C №２", "Pазрабοтчик 1С​ №2", "Разработчи‌к 1С №2"]
    got = forms(spark, *same)
    assert len(set(got.values())) == 1
    got = forms(spark, "йё", "йё", "и​̆ё", "йëx", "йёx")
    assert got[0] == got[1] == got[2] and got[3] == got[4]


def test_what_a_reader_sees_stays(spark):
    texts = ["ёлка", "елка", "Елка", "№1", "№2", "a-b", "a—b", "a b", "a\nb", "👩‍💻", "👩💻", "x²", "x2", "A", "a"]
    got = forms(spark, *texts)
    assert len(set(got.values())) == len(texts)


def test_joiner_goes_outside_pictures(spark):
    got = forms(spark, "го‍род", "город", "✉️", "1️", "1")
    assert got[0] == got[1] and got[3] == got[4] and got[2] == "✉️"


def test_null_empty_and_long(spark):
    got = forms(spark, None, "", "ж" * 300_000)
    assert got[0] is None and got[1] == "" and len(got[2]) == 300_000


def test_pairs(spark):
    rows = [("t", "b", "Рекрутер"), ("t", "a", "Pекрутер"), ("t", "c", "Рекрутер"), ("t", "c", "Рекрутер"), ("u", "z", "Pекрутер"), ("t", "d", None), ("t", None, "Рeкрутер"), ("t", "e", ""), ("t", "f", "​"), ("t", "g", "Рекрутёр")]
    df = spark.createDataFrame(rows, "field string, id string, text string")
    got = sorted(tuple(r) for r in lookalikes.lookalike_pairs(df).collect())
    assert got == [("t", "a", "b"), ("t", "a", "c"), ("t", "e", "f")]
    assert lookalikes.lookalike_pairs(df.limit(0)).collect() == []


def test_a_record_with_two_texts_is_no_pair_with_itself(spark):
    df = spark.createDataFrame([("t", "a", "Кот"), ("t", "a", "Koт")], "field string, id string, text string")
    assert lookalikes.lookalike_pairs(df).collect() == []


def test_many_equal_rows_and_one_variant(spark):
    df = spark.createDataFrame([("t", f"{i:05d}", "Кот") for i in range(3000)] + [("t", "x", "Koт")], "field string, id string, text string")
    assert lookalikes.lookalike_pairs(df).count() == 3000


def test_what_is_invisible_hides_no_joiner(spark):
    woman, computer, zwj, sel = "\U0001f469", "\U0001f4bb", "\u200d", "\ufe0f"
    got = forms(spark, woman + zwj + computer, woman + "\u200b" + zwj + computer, woman + zwj + "\u00ad" + computer, "\u2709" + sel, "\u2709\u2060" + sel, woman + computer, "\u2709")
    assert got[0] == got[1] == got[2] and got[3] == got[4] and len({got[0], got[3], got[5], got[6]}) == 4


def test_joiner_without_a_second_picture_and_selector_that_changes_nothing(spark):
    fire, check, zwj, sel = "\U0001f525", "\u2705", "\u200d", "\ufe0f"
    got = forms(spark, fire + zwj + " go", fire + " go", fire + sel + " go", check + sel, check)
    assert got[0] == got[1] == got[2] and got[3] == got[4]


def test_compatibility_forms(spark):
    got = forms(spark, "o\ufb03ce", "office", "\u00b5", "\u03bc", "\u2163", "IV", "\u2169", "X", "\u04c0", "I", "\u03bdia", "via")
    assert all(got[k] == got[k + 1] for k in range(0, 12, 2))


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(lookalikes, "BLOCK", 4)
    df = spark.createDataFrame([("t", f"{i:02d}", "Кот") for i in range(30)] + [("t", f"x{i}", "Koт") for i in range(9)], "field string, id string, text string")
    rows = lookalikes.lookalike_pairs(df).collect()
    assert len(rows) == len({tuple(r) for r in rows}) == 270


def test_classes(spark):
    rows = [("t", "b", "Кот"), ("t", "a", "Koт"), ("t", "c", "Кот"), ("t", "c", "Кот"), ("u", "a", "Кот"), ("t", "d", None), ("t", "e", "кот")]
    df = spark.createDataFrame(rows, "field string, id string, text string")
    got = sorted(tuple(r) for r in lookalikes.lookalike_classes(df).collect())
    assert got == [("t", "a", "a", 2), ("t", "b", "a", 2), ("t", "c", "a", 2), ("t", "e", "e", 1), ("u", "a", "a", 1)]
