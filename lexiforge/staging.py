"""Durable cut points of long plans.

A stage is a Parquet table in the folder that ``spark.checkpoint.dir`` names, which
every executor and the driver share; a lost executor costs a re-read, never a
recomputation of the lineage above it. The shuffles that made a stage are deleted with
the write's end, and a stage that nothing reads any more can be discarded.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_DEFAULTS = {_CLEANUP: "false", _ALL_KEYS: "true", _WRITERS: "0", _BROADCAST: "10485760b"}
_written: dict[str, SparkSession] = {}
_named: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder. A session in one process that names none (tests) gets a folder of its own; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="lexiforge-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextlib.contextmanager
def _set(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, _DEFAULTS[k]) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shuffles_end_with_their_query(spark: SparkSession):
    return _set(spark, {_CLEANUP: "true"})


def staged(df: DataFrame, label: str, together: bool = False, codec: str = "snappy", by: tuple[int, list[str]] | None = None, then: list[DataFrame] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a reader of it.

    ``together``: rows that were dealt out by a key stay where they are for joins on that key and more columns,
    none of which is broadcast: what is small as a compressed table can be many times larger in memory, and then on disk.
    ``by`` (buckets, columns): the table keeps how its rows are dealt out, so what joins or groups it by these
    columns needs no exchange. Rows that were dealt out so before fill one file a task.
    ``then``: frames of the same columns whose rows are appended, each after the shuffles of the one before have ended.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex
    path = f"{shared_dir(spark)}/lexiforge/{label}-{run}"
    _written[path] = spark
    with _set(spark, {_CLEANUP: "true"} | ({_ALL_KEYS: "false", _BROADCAST: "-1"} if together else {}) | ({_WRITERS: "16"} if by else {})):
        if by is None:
            for d in (df, *then):
                d.write.mode("append").option("compression", codec).parquet(path)
            out = spark.read.schema(df.schema).parquet(path)
        else:
            _named[path] = f"lexiforge_{label}_{run}"
            for d in (df, *then):
                d.write.mode("append").format("parquet").option("compression", codec).option("path", path).bucketBy(by[0], *by[1]).saveAsTable(_named[path])
            out = spark.table(_named[path])
    out.lexiforge_stage = path
    return out


def scratch(spark: SparkSession, label: str) -> str:
    """A folder of one's own below the shared one, deleted with the stages of this process."""
    path = f"{shared_dir(spark)}/lexiforge/{label}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again; frames read from it end here."""
    _delete(getattr(df, "lexiforge_stage", ""))


def _delete(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is not None:
        with contextlib.suppress(Exception):  # the session may have ended
            if path in _named:
                spark.sql(f"DROP TABLE IF EXISTS {_named.pop(path)}")
            jvm = spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release() -> None:
    """Delete every staged table of this process."""
    for path in list(_written):
        _delete(path)


atexit.register(release)
