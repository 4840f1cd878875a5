"""Incremental ingest: new files are taken once, finished ones are skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _holds_files(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder with data."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(at) and any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(at))


def ingest_new(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, overwrite: bool = False, key: str = "sample", fmt: str = "parquet") -> None:
    """Process the files of ``source`` that the checkpoint hasn't seen and write them partitioned by ``key`` and ``src``.

    ``src`` marks the file that a row comes from. What is done is told by sample and file together: a sample whose files
    come at different times keeps them all, and a file whose rows the target holds is skipped, or replaced with
    ``overwrite``. Each (sample, file) is one folder that is moved into place whole, and a batch that is run again after a
    crash writes the same folders, so nothing is lost or doubled at whatever point it stopped. ``transform`` gets and must
    keep the columns ``key`` and ``src``. The stream ends when all files that are there have been read; a later call goes on from its checkpoint.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    stream = stream.withColumn("src", F.md5(F.col("_metadata.file_path").cast("binary")))

    def put(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        if not overwrite and _holds_files(spark, target):
            done = spark.read.parquet(target).select(key, "src").distinct()
            rows = rows.join(done, [key, "src"], "left_anti")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key, "src").parquet(target)

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts per tumbling window and keys over a stream or table, late rows dropped past the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))
