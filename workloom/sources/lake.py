"""The append-only lake: scan with column back-fill, batch append, day-partitioned event files, gates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workloom.schemas import LAKE


class Stale(RuntimeError):
    """A gate refused a table: too old, too small or empty."""


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def exists(spark: SparkSession, folder: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def scan(spark: SparkSession, folder: str, source: str | None = None, schema: T.StructType = LAKE, columns: list[str] | None = None, *, with_file: bool = False) -> DataFrame:
    """The lake under a declared schema: columns that old files lack are null, further ones are
    ignored, and no footer is read to infer anything. `source` also lives in the path, so it prunes
    folders. with_file adds `file`, the file that a row comes from. A lake that isn't there yet is an
    empty table."""
    more = [F.col("_metadata.file_path").alias("file")] if with_file else []
    if not exists(spark, folder):
        return _empty(spark, schema).select(*(columns or schema.names), *[F.lit(None).cast("string").alias("file") for _ in more])
    own = T.StructType([f for f in schema.fields if f.name != "source"] + [T.StructField("source", T.StringType())])
    df = spark.read.schema(own).option("basePath", folder).parquet(folder)
    if source is not None:
        df = df.where(F.col("source") == source)
    return df.select(*(columns or schema.names), *more)


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, bool, int]]:
    """(path, is a folder, time of change) of what lies directly in a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(x.getPath().toString(), x.isDirectory(), x.getModificationTime()) for x in fs.listStatus(p)] if fs.exists(p) else []


def _rename(spark: SparkSession, old: str, new: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{old} can't be moved to {new}")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _parquet_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    return [(f, t) for f, is_dir, t in _listed(spark, folder) if not is_dir and f.endswith(".parquet")]


def newest_has(spark: SparkSession, folder: str, column: str) -> bool:
    """Whether the newest file of the newest month has a column. Columns are only ever added, so one footer
    answers for the lake, however many files it has. False for an empty lake."""
    folders = lambda at, prefix: sorted((f for f, is_dir, _ in _listed(spark, at) if is_dir and f.rsplit("/", 1)[1].startswith(prefix)), reverse=True)
    for year in folders(folder, "year="):
        for month in folders(year, "month="):
            files = [x for source in folders(month, "source=") for x in _parquet_files(spark, source)]
            if files:
                return column in spark.read.parquet(max(files, key=lambda x: (x[1], x[0]))[0]).columns
    return False


def append(batch: DataFrame, folder: str) -> None:
    """Appends one batch, which must hold one fetched_at and be non-empty, as year/month/source folders."""
    moments = batch.select("fetched_at").distinct().limit(2).collect()
    if len(moments) != 1 or moments[0][0] is None:
        raise ValueError("a batch has exactly one fetched_at")
    load(batch, folder)


def load(rows: DataFrame, folder: str) -> None:
    """Appends rows of any moments, as year/month/source folders."""
    parts = rows.withColumn("year", F.year("fetched_at")).withColumn("month", F.lpad(F.month("fetched_at").cast("string"), 2, "0"))
    parts.write.mode("append").option("compression", "zstd").partitionBy("year", "month", "source").parquet(folder)


def write_events(events: DataFrame, folder: str) -> None:
    """Event files by day, zero-padded, replacing what was there."""
    day = lambda f: F.date_format("ts", f)
    out = events.withColumns({"year": day("yyyy"), "month": day("MM"), "day": day("dd")})
    out.repartition("year", "month", "day").sortWithinPartitions("ts", "event_id").write.mode("overwrite").partitionBy("year", "month", "day").parquet(folder)


def write_artifact(rows: DataFrame, folder: str, least: int) -> int:
    """Gzipped JSON rows; refuses to replace the artifact by fewer than `least` rows."""
    n = rows.count()
    if n < least:
        raise Stale(f"{n} rows, at least {least} are needed")
    rows.select(F.col("row").alias("value")).write.mode("overwrite").option("compression", "gzip").text(folder)
    return n


def require_fresh(df: DataFrame, ts: str, since) -> None:
    newest = df.agg(F.max(ts)).first()[0]
    if newest is None or newest < since:
        raise Stale(f"newest {ts} is {newest}, needed is {since}")


def checked_vectors(df: DataFrame, vector: str, size: int) -> DataFrame:
    """df, failing on the first vector of another dimension."""
    ok = F.size(vector) == size
    return df.withColumn(vector, F.when(ok, F.col(vector)).otherwise(F.raise_error(F.concat(F.lit("vector of size "), F.size(vector).cast("string"))).cast(df.schema[vector].dataType)))


def write_snapshot(slim: DataFrame, folder: str, files: int | None = None) -> None:
    """The snapshot table, compressed, replacing the one before; files: their number, by default Spark's."""
    out = slim if files is None else slim.coalesce(files)
    out.write.mode("overwrite").option("compression", "zstd").parquet(folder)


def write_aggregates(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet table for each aggregate; one without rows keeps its schema."""
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")


def require_rows(tables: dict[str, DataFrame]) -> None:
    """Fails if an aggregate is empty, naming all that are."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise Stale("empty: " + ", ".join(sorted(empty)))


def require_success(failed: int, tried: int, most: float = 0.5) -> None:
    """Fails if at least the share `most` of what was tried, and at least one, failed."""
    if failed and failed >= max(1, tried * most):
        raise Stale(f"{failed} of {tried} failed")


def merge_vectors(new: DataFrame, stored: DataFrame, key: str = "vacancy_id") -> DataFrame:
    """The stored vectors with new ones in place of those of the same key; null keys are left out."""
    fresh = new.where(F.col(key).isNotNull()).dropDuplicates([key])
    kept = stored.where(F.col(key).isNotNull()).join(fresh.select(key), key, "left_anti")
    return fresh.unionByName(kept.select(*fresh.columns))


def export_vectors(stored: DataFrame, folder: str, size: int, key: str = "vacancy_id", vector: str = "vector") -> int:
    """Writes (key, vector) and returns the number of rows; fails before anything is written if a vector is
    null or has another dimension. An empty store gives an empty table of the same schema."""
    rows = stored.select(key, F.col(vector).cast("array<float>").alias(vector))
    bad = rows.where(F.col(vector).isNull() | (F.size(vector) != size)).limit(1).collect()
    if bad:
        raise ValueError(f"the vector of {bad[0][0]} has not the size {size}")
    write_snapshot(rows, folder)
    return stored.sparkSession.read.parquet(folder).count()


def compaction_plan(spark: SparkSession, folder: str, today: str) -> list[tuple[str, int]]:
    """(partition, number of files) of the year/month/source folders of closed months, those before today's, that have
    more than one file."""
    out = []
    for year, is_year, _ in _listed(spark, folder):
        for month, is_month, _ in _listed(spark, year) if is_year and "/year=" in year else ():
            for part, is_part, _ in _listed(spark, month) if is_month and "/month=" in month else ():
                n = len(_parquet_files(spark, part)) if is_part else 0
                at = f"{int(year.rsplit('=', 1)[1]):04d}-{int(month.rsplit('=', 1)[1]):02d}"
                if n > 1 and at < today[:7]:
                    out.append((part, n))
    return sorted(out)


def compact_partition(spark: SparkSession, partition: str, lake: str, trash: str, schema: T.StructType = LAKE) -> int:
    """Rewrites the files of a partition as one beside it, checks the number of rows, moves the old files to the
    same place under `trash` and the new one in. On a mismatch nothing is touched. Returns the rows."""
    old = [f for f, _ in _parquet_files(spark, partition)]
    inner = T.StructType([f for f in schema.fields if f.name != "source"])
    rows = spark.read.schema(inner).parquet(*old)
    expected, fresh = rows.count(), f"{trash.rstrip('/')}/_new/{uuid.uuid4().hex}"
    rows.coalesce(1).write.option("compression", "zstd").parquet(fresh)
    made = [f for f, _ in _parquet_files(spark, fresh)]
    got = spark.read.parquet(fresh).count()
    if got != expected or len(made) != 1:
        _delete(spark, fresh)
        raise Stale(f"{partition} has {expected} rows, rewritten {got}")
    place = partition.rstrip("/").split(lake.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1]
    for f in old:
        _rename(spark, f, f"{trash.rstrip('/')}/{place}/{f.rsplit('/', 1)[1]}")
    _rename(spark, made[0], f"{partition}/compacted-{uuid.uuid4().hex}.parquet")
    _delete(spark, fresh)
    return expected
