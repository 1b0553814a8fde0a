"""Session settings and the shared folder every job may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    # Adaptive execution picks partition counts, splits skewed joins and re-checks broadcast sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partitioned overwrite replaces only the partitions present in the data written.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str = "lakemart",
    *,
    master: str | None = None,
    time_zone: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library expects; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_CONF, "spark.sql.session.timeZone": time_zone, **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may do without the setting: there a fresh folder of this machine is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="lakemart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/lakemart/{name}-{uuid.uuid4().hex}"


# Tables stored since the innermost ``lean`` block began; None outside of one.
_temporary: ContextVar[list[str] | None] = ContextVar("_temporary", default=None)

LEAN_CONF = {
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffle files go with the execution that wrote them, not when the driver's garbage is collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """For a job that ends in written tables: it leaves those on disk and little else.

    Tables are written with zstd, shuffle files are deleted with the write that needed them, and the tables ``stored``
    inside are deleted at the end, so no DataFrame over them may be handed out.
    """
    before = {name: spark.conf.get(name, None) for name in LEAN_CONF}
    outer = _temporary.set([])
    for name, value in LEAN_CONF.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
        files = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in map(files.Path, _temporary.get()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _temporary.reset(outer)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into a Parquet table of the shared folder, and that table.

    All readers see the same rows, lost executors cost no recomputation, and unlike a checkpoint of
    rows the table is compressed, read by column, and of a size Catalyst knows.
    """
    path = new_table_path(df.sparkSession, name)
    if (temporary := _temporary.get()) is not None:
        temporary.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
