"""Detail pages: which to fetch first, fetching on the workers, and the cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workloom.functions.extract import page_text
from workloom.operators.slim import TEASER
from workloom.operators.state import missing, upsert
from workloom.runtime import materialise
from workloom.schemas import DETAILS
from workloom.sources.lake import require_success


def work_list(wanted: DataFrame, slim: DataFrame, most: int | None = None) -> DataFrame:
    """The ids of `wanted` in the order of work: first board postings of unknown level, then the others, by id; at
    most `most`."""
    unknown = slim.where("source = 'hh' and seniority = 'unknown'").select("vacancy_id").distinct().withColumn("_first", F.lit(0))
    ids = wanted.select("vacancy_id").where("vacancy_id is not null").distinct().join(unknown, "vacancy_id", "left")
    ids = ids.orderBy(F.coalesce("_first", F.lit(1)), "vacancy_id").select("vacancy_id")
    return ids if most is None else ids.limit(most)


def cut_between_words(text: str, most: int) -> str:
    """At most `most` characters, cut at the last blank if there is one after the start."""
    if len(text) <= most:
        return text
    at = text[:most].rfind(" ")
    return text[: at if at > 0 else most]


def fetch_missing(wanted: DataFrame, cache: DataFrame, fetch: Callable[[str], str | None], *, attempts: int = 3, most_failures: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(cache with what was missing, failures): `fetch` gives the page of an id, or None for one that is gone (cached
    without a text). It runs on the workers, is tried `attempts` times, and an id that still fails is left
    for the next run. Fails if at least the share `most_failures` of the ids failed.

    Pages become text there, so none comes to the driver. An id is fetched once, however often it is wanted."""
    todo = missing(wanted.where("vacancy_id is not null").select("vacancy_id").distinct(), cache, "vacancy_id")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for i in frame["vacancy_id"]:
                error = None
                for _ in range(attempts):
                    try:
                        page, error = fetch(i), None
                        break
                    except Exception as e:  # any failure of one id must not end the others
                        page, error = None, str(e) or type(e).__name__
                text = page_text(page, ("data-qa", "vacancy-description")) if page is not None else None
                text = page_text(page) if page is not None and text is None else text
                rows.append((i, text, cut_between_words(text, TEASER) if text else None, error))
            yield pd.DataFrame(rows, columns=["vacancy_id", "description_text", "description_teaser", "error"])

    got = materialise(todo.mapInPandas(work, "vacancy_id string, description_text string, description_teaser string, error string"), "details")
    count = got.agg(F.count("*").alias("n"), F.count("error").alias("failed")).first()
    require_success(count["failed"], count["n"], most_failures)
    now = F.current_timestamp()
    fresh = got.where("error is null").select("vacancy_id", now.alias("fetched_at"), "description_text", "description_teaser", F.col("description_text").alias("description_fts"))
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in DETAILS.fields])
    return upsert(cache.select(*DETAILS.names), fresh, ["vacancy_id"], ["fetched_at"]), got.where("error is not null").select("vacancy_id", "error")
