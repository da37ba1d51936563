"""Session defaults and the few helpers every plan shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is hinted for broadcast only when its counted rows stay under this.
BROADCAST_ROWS = 100_000


def session(app: str = "workloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans assume (UTC, AQE, Arrow)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, which import it in Arrow functions. Needed once a session on a cluster whose
    workers don't have it installed; `session` does it."""
    here = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(tempfile.mkdtemp(prefix="workloom-"), "workloom")  # on the driver, which serves it
    spark.sparkContext.addPyFile(shutil.make_archive(to, "zip", os.path.dirname(here), os.path.basename(here)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one on a local master."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    got = spark.sparkContext._jsc.sc().getCheckpointDir()
    if got.isDefined():
        return got.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    at = tempfile.mkdtemp(prefix="workloom-")
    spark.sparkContext.setCheckpointDir(at)
    return at


#: Folders of stages written by this driver and not yet removed, and those of them that several queries share.
_STAGES: set[str] = set()
_SHARED: set[str] = set()


def _forget(spark: SparkSession, path: str) -> None:
    _STAGES.discard(path)
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may already be gone
        pass


def fresh_folder(spark: SparkSession, label: str) -> str:
    """The name of a new folder beside the stages, removed with them."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _STAGES.add(path)
    atexit.register(_forget, spark, path)
    return path


def materialise(df: DataFrame, label: str = "stage", *, shared: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, so a lost executor costs
    a re-read, and what later steps see (partition ids, samples, seeds) can't change between reads.
    The files are removed by `release` once nothing reads them, or when the driver exits. shared: several
    queries read them, so `release_all` spares them."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    if shared:
        _SHARED.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def is_kept(stage: DataFrame) -> bool:
    """Whether the files of a result of `materialise` are still there."""
    return getattr(stage, "stage_path", None) in _STAGES


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed; 0 if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else 0


def release(*stages: DataFrame) -> None:
    """Removes the files of results of `materialise` that no later step reads any more."""
    for df in stages:
        if path := getattr(df, "stage_path", None):
            _forget(df.sparkSession, path)


def release_all(spark: SparkSession) -> None:
    """Removes the files of all stages that no queries share: for a long session, between queries whose results are not
    needed any more."""
    for path in _STAGES - _SHARED:
        _forget(spark, path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows; otherwise df, and Catalyst shuffles."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def distinct_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


Query = Callable[[SparkSession, str], DataFrame]


def utc_date(c: Column | str) -> Column:
    """The UTC calendar date of a timestamp, whatever the session's time zone."""
    return F.to_date(F.to_utc_timestamp(c, F.current_timezone()))
