import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from workloom.llm import mapping

ROLES = [(1, "backend_developer", ["Backend developer", "Бэкенд-разработчик", "server-side developer"]), (2, "nurse_coordinator", ["Nurse coordinator", "Старшая медсестра"]), (3, "erp_consultant", ["ERP consultant", "Консультант 1С"]), (4, "database_keeper", ["Database keeper", "DBA"])]
CITIES = [(1, "Вережград", ["ВГ", "врж"]), (2, "Озерищи-на-Суле", ["ОнС"]), (3, "Тёплый Затон", []), (4, "Сухая Балка", []), (5, "Плесковье-Южное", [])]


@pytest.mark.parametrize(
    "value,ref",
    [
        ("Senior Бэкенд-разработчик", 1), ("developer, server-side", 1), ("backend_developsr", 1), ("Bacckend developer (remote)", 1), ("Старшаямедсестра", 2), ("медсестра, Старшая", 2), ("Консультант 1о", 3), ("er pconsultant", 3),
        ("DBA — срочно", 4), ("ninja", None), ("специалист", None), ("???", None), ("developer", None), ("", None), ("DBAs", None),
    ],
)
def test_roles(value, ref):
    assert mapping.Matcher(ROLES).match(value) == ref


@pytest.mark.parametrize(
    "value,ref",
    [
        ("г. Вережград", 1), ("Вережград (Приозёрный край)", 1), ("вг", 1), ("Верегжрад", 1), ("Bepeжгpaд", 1), ("Verezhgrad city", 1), ("dtht;uhfl", 1), ("jpthbob-yf-cekt", 2), ("ТёплыйЗатон", 3), ("Teplyy Zaton", 3), ("Suhaya Balka", 4),
        ("gktcrjdmt-.;yjt", 5), ("Тёплый Затон или Вережград", 3), ("Лунавиль", None), ("удалённо", None), ("Kesselbrück", None), ("-", None), ("x" * 50_000, None),
    ],
)
def test_cities(value, ref):
    assert mapping.Matcher(CITIES).match(value) == ref


def _edits(a, b):
    """Optimal string alignment, cell by cell."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
@settings(max_examples=400, deadline=None)
def test_distance(a, b):
    assert mapping.distance(a, b, 99) == _edits(a, b)


def test_operator_keeps_rows_and_handles_odd_cases(spark):
    ref = spark.createDataFrame([(*c, "clash") for c in CITIES] + [(None, "x", [], ""), (9, None, None, ""), (7, "Гром", None, "")], "city_id bigint, city string, aliases array<string>, ref_id string")
    df = spark.createDataFrame([(1, "г. Вережград", "a"), (1, "г. Вережград", "a"), (2, None, "b"), (3, "  ", "c"), (4, "Гром!", "d"), (5, "нет", "e")], "id bigint, v string, ref_id string")
    got = sorted((r.id, r.ref_id) for r in mapping.map_values(df, "v", ref, "city_id", "city", "aliases").collect())
    assert [g for g in got if g[1] is not None] == [(1, 1), (1, 1), (4, 7), (5, -1)] and len(got) == 6
    assert mapping.map_values(df.limit(0), "v", ref, "city_id", "city", "aliases").collect() == []
    assert {r.ref_id for r in mapping.map_values(df.where("id = 1"), "v", ref.limit(0), "city_id", "city", "aliases").collect()} == {-1}
    typed = mapping.typed_values(spark.createDataFrame([(1, "Вережград"), (2, "вережград"), (3, "   "), (4, None)], "id bigint, v string"), "id", "v", ref, "city")
    assert [r.record_id for r in typed.collect()] == ["2"]


def test_longest_non_overlapping_mention_wins():
    greek = [(1, "Alpha Beta", []), (2, "Alpha Beta", []), (3, "Beta", []), (4, "Gamma Delta Epsilon", ["gde"]), (5, "Delta Epsilon Zeta", [])]
    m = mapping.Matcher(greek)
    assert m.match("Alpha Beta") is None and m.match("beta") == 3
    assert m.match("gamma delta epsilon zeta") == 4 and m.match("gde, beta") == 3
    found = m.mentions("gamma delta epsilon zeta", 0)
    assert len(found) == 2 and len(mapping.non_overlapping(found)) == 1
    twins = [(1, "Bor", ["old town"]), (2, "Ust", ["old town"])]
    assert mapping.Matcher(twins).match("old town (Ust)") == 2 and mapping.Matcher(twins).match("old town") is None


def test_similarity_ignores_what_stands_beside_and_order():
    m = mapping.Matcher(ROLES)
    assert m.match("urgently wanted: backend devloper, night shifts") == 1 and m.match("coordinater / nurse 2 pcs") == 2
    assert m.match("D B A") == 4 and m.match("DBX") is None


@pytest.mark.parametrize("block", [1, 2])
def test_blocks_of_the_reference_give_the_same(spark, data, block):
    ref = spark.createDataFrame([*ROLES, *[(k + 100, n, a) for k, n, a in CITIES], (900, "Alpha Beta", []), (901, "Alpha Beta", ["x1"])], "id bigint, name string, aliases array<string>")
    values = ["Senior Бэкенд-разработчик", "developer, server-side", "ninja", "г. Верегжрад", "dtht;uhfl", "Alpha Beta", "alpha beta x1", "  ", None, "Teplyy Zaton", "DBAs", "Тёплый Затон или Вережград"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(99, values[0])], "i int, v string")
    whole = sorted(tuple(r) for r in mapping.map_values(df, "v", ref, "id", "name", "aliases").select("i", "ref_id").collect())
    parts = sorted(tuple(r) for r in mapping.map_values(df, "v", ref, "id", "name", "aliases", block=block).select("i", "ref_id").collect())
    assert whole == parts and len({r[1] for r in whole}) > 5


def test_answers_too_many_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mapping, "small", lambda df: df)
    ref = spark.createDataFrame(CITIES, "id bigint, name string, aliases array<string>")
    df = spark.createDataFrame([(i, "г. Вережград") for i in range(50)] + [(50, "вг"), (51, None)], "i int, v string")
    rows = mapping.map_values(df, "v", ref, "id", "name", "aliases").collect()
    assert len(rows) == 52 and sum(r.ref_id == 1 for r in rows) == 51


def test_planted_values_on_the_tables(spark, data):
    """Names with a letter dropped, in another order of words or with words beside must be found again."""
    import random

    rnd = random.Random(6)
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/role_reference.parquet").collect()]
    m = mapping.Matcher(rows)
    tried = right = 0
    for key, _, aliases in rows:
        for name in aliases:
            words = name.split()
            k = rnd.randrange(1, len(name) - 1)
            for value in (name[:k] + name[k + 1 :], ", ".join(reversed(words)), f"senior {name} (remote)", f"{name.upper()} 2 pcs"):
                tried += len(name) > 4
                right += len(name) > 4 and m.match(value) == key
    assert right >= 0.97 * tried
