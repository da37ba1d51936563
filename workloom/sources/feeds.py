"""Feeds as Spark sources: exchange rates as XML, paged JSON, segment planning and reference trees."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from workloom.runtime import materialise


def rates_xml(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Rates (date, char_code, nominal, value) of one day's XML; decimal commas; malformed rows are left out."""
    rows = spark.read.format("xml").option("rowTag", "Valute").schema("CharCode string, Nominal string, Value string").load(path)
    value = F.expr("try_cast(replace(Value, ',', '.') as double)")
    got = rows.select(F.lit(day).cast("date").alias("date"), F.col("CharCode").alias("char_code"), F.expr("try_cast(Nominal as int)").alias("nominal"), value.alias("value"))
    return got.where("char_code is not null and nominal > 0 and value is not null")


def rates_of_days(days: DataFrame, fetch: Callable[[str], str | None], attempts: int = 3) -> DataFrame:
    """Rates (date, char_code, nominal, value) of many days: `fetch` runs on the workers, gets a day as YYYY-MM-DD and
    gives its XML, or None for a day without rates. It is tried `attempts` times; if it still fails, so does
    the job. Malformed rows are left out; a day is fetched once, however often it is asked for."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pages = []
            for day in frame["day"]:
                for n in range(1, attempts + 1):
                    try:
                        pages.append((day, fetch(day)))
                        break
                    except Exception:
                        if n == attempts:
                            raise
            yield pd.DataFrame(pages, columns=["day", "page"])

    pages = days.select(F.col(days.columns[0]).cast("date").cast("string").alias("day")).where("day is not null").distinct().mapInPandas(work, "day string, page string")
    rows = F.from_xml("page", "Valute array<struct<CharCode:string,Nominal:string,Value:string>>")
    one = pages.where("page is not null").select("day", F.explode(rows["Valute"]).alias("v"))
    value = F.replace("v.Value", F.lit(","), F.lit(".")).try_cast("double")
    got = one.select(F.col("day").cast("date").alias("date"), F.col("v.CharCode").alias("char_code"), F.col("v.Nominal").try_cast("int").alias("nominal"), value.alias("value"))
    return got.where("char_code is not null and nominal > 0 and value is not null")


def crawl(
    spark: SparkSession, segments: Iterable[tuple[str, ...]], count: Callable[[tuple[str, ...]], int], split: Callable[[tuple[str, ...]], list[tuple[str, ...]]],
    drain: Callable[[tuple[str, ...]], list[str]], *, cap: int, depth: int = 8, closed: Iterable[tuple[str, ...]] = (),
) -> tuple[DataFrame, dict[str, list]]:
    """(items, ledger) of a search that shows at most `cap` results a query: segments with more are split, at most
    `depth` times, until each part has few enough; the parts are drained on the workers, each whole or not
    at all.

    items: (segment, item). ledger: `closed`, the segments drained now or before (give them to the next run to go
    on from there), `uncovered`, those over the cap that can't be split, and `failed`, those whose count or
    drain failed. Only if the last two are empty is the sweep complete, so that absence means closed."""
    done = {tuple(s) for s in closed}
    ledger: dict[str, list] = {"closed": sorted(done), "uncovered": [], "failed": []}
    todo, leaves = [(tuple(s), 0) for s in segments], []
    while todo:
        segment, level = todo.pop()
        if segment in done:
            continue
        try:
            n = count(segment)
        except Exception:
            ledger["failed"].append(segment)
            continue
        if n <= cap:
            leaves.append(segment)
        elif parts := (split(segment) if level < depth else []):
            todo += [(tuple(p), level + 1) for p in parts]
        else:
            ledger["uncovered"].append(segment)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for segment in frame["segment"]:
                try:
                    items, failed = drain(tuple(segment)), False
                except Exception:
                    items, failed = [], True
                yield pd.DataFrame({"segment": [list(segment)] * (len(items) + 1), "item": [*items, None], "failed": [False] * len(items) + [failed]})

    leaves = sorted(set(leaves))
    asked = spark.createDataFrame([(list(s),) for s in leaves], "segment array<string>").repartition(max(1, len(leaves)))
    got = materialise(asked.mapInPandas(work, "segment array<string>, item string, failed boolean"), "crawl")
    bad = {tuple(r[0]) for r in got.where("failed").select("segment").collect()}  # at most one row a segment
    ledger["failed"] = sorted([*ledger["failed"], *bad])
    ledger["closed"] = sorted(done | (set(leaves) - bad))
    return got.where("item is not null").select("segment", "item"), ledger


def paged(spark: SparkSession, folder: str, max_pages: int = 100_000) -> DataFrame:
    """(segment, page, item): the items, as JSON texts, of search pages saved as `segment-page.json` files in a
    folder that all executors see. A segment's pages count from 0 up to the page that is its last by
    its own word, a missing page or max_pages. Both shapes of pages are read."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder).select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    name = F.regexp_extract("file", r"^(.+)-(\d+)\.json$", 1)
    at = lambda *paths: F.coalesce(*[F.get_json_object("value", p) for p in paths])
    last = F.coalesce(at("$.vacancySearchResult.paging.lastPage.page").cast("int"), at("$.pages").cast("int") - 1, F.lit(0))
    items = F.from_json(at("$.vacancySearchResult.vacancies", "$.vacancySearchResult.items", "$.vacancies", "$.items"), "array<string>")
    pages = files.select(F.url_decode(name).alias("segment"), F.regexp_extract("file", r"-(\d+)\.json$", 1).cast("int").alias("page"), last.alias("last"), items.alias("items")).where("segment <> ''")
    upto = Window.partitionBy("segment").orderBy("page")  # the pages of one segment
    known = pages.select("*", F.row_number().over(upto).alias("k"), F.coalesce(F.max(F.col("page") >= F.col("last")).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)).alias("over"))
    read = known.where((F.col("page") == F.col("k") - 1) & ~F.col("over") & (F.col("page") < max_pages))
    return read.select("segment", "page", F.explode("items").alias("item"))


#: A chat message as exported, one JSON object a line.
MESSAGE = "channel string, message_id int, date timestamp, text string, views int"


def messages(spark: SparkSession, folder: str, *, stream: bool = False) -> DataFrame:
    """Chat messages from files of JSON lines in a folder, all at once or as a stream that takes files up as they come.
    Lines that are no message are left out."""
    reader = (spark.readStream if stream else spark.read).schema(MESSAGE).option("mode", "DROPMALFORMED")
    return reader.json(folder).where("channel is not null and message_id is not null")


def split_segments(count, areas: list, cap: int) -> list[list]:
    """Halves a list of areas until each part has at most `cap` results or one area; parts over the cap
    are reported by their count staying above it."""
    todo, out = [areas], []
    while todo:
        part = todo.pop()
        if len(part) > 1 and count(part) > cap:
            todo += [part[len(part) // 2 :], part[: len(part) // 2]]
        elif part:
            out.append(part)
    return out


def children_of(tree: list[dict], wanted: str) -> list[dict]:
    """The areas directly under the area with the id, found at any depth of a reference tree."""
    stack = list(tree)
    while stack:
        node = stack.pop()
        if str(node.get("id")) == wanted:
            return node.get("areas") or []
        stack += node.get("areas") or []
    return []


def roles_table(spark: SparkSession, categories: list[dict]) -> DataFrame:
    """(category_id, category, role_id, role) of the nested reference of roles."""
    rows = [(str(c["id"]), c["name"], str(r["id"]), r["name"]) for c in categories for r in c.get("roles") or []]
    return spark.createDataFrame(rows, "category_id string, category string, role_id string, role string")
