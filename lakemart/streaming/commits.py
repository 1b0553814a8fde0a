"""New files of a landing folder merged into a change log as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemart.contracts import TableContract
from lakemart.sources.change_log import append_commit


def merge_landing_files(
    spark: SparkSession,
    landing: str,
    log_path: str,
    contract: TableContract,
    schema: StructType,
    checkpoint: str,
    *,
    commit_prefix: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int = 1000,
) -> StreamingQuery:
    """Every batch of new Parquet files becomes one commit of the log; runs until no file is left.

    Late rows need no watermark: reads resolve versions by the ordering column. A commit is named
    after ``commit_prefix`` and the batch number, so a batch that is run again after a failure replaces
    itself. Batch numbers start anew with a new checkpoint: give each checkpoint a prefix of its own
    that sorts after the commits before, such as the time the stream was set up.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        append_commit(prepare(batch), log_path, contract, f"{commit_prefix}{batch_id:010d}")

    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(landing)
        .writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
