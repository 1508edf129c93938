"""Messages that take effect once, though a log holds some twice and jobs restart.

A log written at least once repeats messages; the first of equal numbers within
the watermark's delay is kept. A sink that fails part-way is given the batch
again; a ledger of finished batches per sink tells which are done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERY_ID = "sql.streaming.queryId"


def first_of_each(messages: DataFrame, by: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first message of each number, such as (partition, offset).

    In a stream, numbers are remembered for ``delay`` after the message's
    ``time``, and messages later than that are dropped, so ``delay`` must cover
    how late a message or its repeat may come. A table needs no delay.
    """
    if not messages.isStreaming:
        return messages.dropDuplicates(list(by))
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(by))


def once_per_batch(
    folder: str, sink: str, write: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that gives ``sink`` each batch until it
    has succeeded once.

    The ledger is kept per sink and streaming query, so a query that starts
    anew with an empty checkpoint has its own. A driver lost after ``write`` and
    before the ledger's entry gives the batch again: ``write`` must replace what
    it wrote under the same number, as ``batch_folder`` does.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty(QUERY_ID) or "batch"
        entry = f"{folder.rstrip('/')}/ledger/{sink}/{query}/{number}"
        if _exists(spark, f"{entry}/_SUCCESS"):
            return
        write(batch, number)
        done = spark.createDataFrame([(sink, query, number)], "sink string, query string, batch long")
        done.coalesce(1).write.mode("overwrite").json(entry)

    return apply


def batch_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """Write a batch as Parquet in a folder of its number, replacing what a
    failed attempt left there."""
    place = folder.rstrip("/")
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{place}/batch={number}")


def finished_batches(spark: SparkSession, folder: str, sink: str) -> DataFrame:
    """The ledger of a sink: sink, query and batch."""
    schema = "sink string, query string, batch long"
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{folder.rstrip('/')}/ledger/{sink}")


def written_once(spark: SparkSession, folder: str, sink: str, output: str, schema: object) -> DataFrame:
    """Rows that ``batch_folder`` wrote in batches the ledger has finished."""
    rows = spark.read.schema(schema).option("basePath", output).parquet(f"{output.rstrip('/')}/batch=*")
    rows = rows.withColumn("_batch", F.regexp_extract(F.input_file_name(), "/batch=([0-9]+)/", 1).cast("long"))
    done = finished_batches(spark, folder, sink).select(F.col("batch").alias("_batch")).distinct()
    return rows.join(done, "_batch", "left_semi").drop("_batch", "batch")


def _exists(spark: SparkSession, place: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
