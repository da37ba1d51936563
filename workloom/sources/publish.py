"""What leaves the lake: artifact load, mirror plan with its gate and retries, synonym file, scopes."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloom.functions.extract import synonyms
from workloom.sources.lake import Stale, exists

#: What is mirrored: (path under the root, path in the mirror, whether it must be there).
MIRRORED = (
    ("derived/slim_active.parquet", "slim/active.parquet", True),
    ("derived/agg", "agg", False),
    ("derived/agg/weekly_role_salary.parquet", "", True),
    ("derived/slim_events_30d", "slim/events_30d", False),
)


def mirror_plan(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(local path, path in the mirror) of what is there to be mirrored; fails if something required isn't."""
    at = lambda path: f"{root.rstrip('/')}/{path}"
    lacking = [path for path, _, required in MIRRORED if required and not exists(spark, at(path))]
    if lacking:
        raise Stale("missing: " + ", ".join(lacking))
    return [(at(path), to) for path, to, _ in MIRRORED if to and exists(spark, at(path))]


class Transient(RuntimeError):
    """A failure that may pass."""


def with_retries(do: Callable[[], object], attempts: int = 3, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """The result of `do`, called again after a Transient failure, each time after a longer pause; the last
    failure, and any other, is raised."""
    if attempts < 1:
        raise ValueError("attempts must be at least 1")
    for n in range(1, attempts + 1):
        try:
            return do()
        except Transient:
            if n == attempts:
                raise
            sleep(pause * n)


def load_artifact(spark: SparkSession, path: str, schema: str, least: int = 0) -> DataFrame:
    """The rows of a published artifact (JSON lines, gzipped or not) under a declared schema; fails if it has fewer
    than `least` rows. Malformed lines are left out."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    if least and len(rows.limit(least).select(F.lit(1)).collect()) < least:
        raise Stale(f"{path} has fewer than {least} rows")
    return rows


def write_synonyms(taxonomy: list[tuple[str, list[str], list[str]]], path: str) -> int:
    """Writes the synonym map of a taxonomy as a sorted JSON file on the driver; returns the number of names."""
    names = synonyms(taxonomy)
    with open(path, "w", encoding="utf-8", newline="\n") as f:
        f.write(json.dumps(names, ensure_ascii=False, indent=2, sort_keys=True) + "\n")
    return len(names)


def scope_roles(roles: DataFrame, *, ids: Sequence[int] = (), category_id: str | None = None, category: str | None = None) -> list[int]:
    """The role ids of a market scope from feeds.roles_table: those given, or those of the category with the id or,
    without one, the name. Fails if there is no such category. A reference of fixed size."""
    if ids:
        return [int(i) for i in ids]
    wanted = (F.col("category_id") == str(category_id)) if category_id is not None else (F.col("category") == category)
    found = [int(r[0]) for r in roles.where(wanted).select("role_id").collect()]
    if not found:
        raise ValueError(f"no category {category_id or category}")
    return sorted(found)


def scope_channels(channels: DataFrame, *, usernames: Iterable[str] = (), roles: Iterable[str] = ()) -> DataFrame:
    """The channels with one of the user names, in any letter case and with or without @, or, if none is given, those
    that have a user name and one of the roles."""
    bare = lambda c: F.lower(F.regexp_replace(c, "^@+", ""))
    names = [u.lstrip("@").lower() for u in usernames]
    if names:
        return channels.where(bare(F.coalesce("username", F.lit(""))).isin(names))
    return channels.where((F.coalesce("username", F.lit("")) != "") & F.col("role").isin(list(roles)))
