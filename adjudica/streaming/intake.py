"""Take in new files of a landing folder: Spark remembers which ones it has read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from adjudica.plans.cleaning import clean
from adjudica.sources import documents


def take_in_lines(
    spark: SparkSession, folder: str, out: str, progress: str, dataset: str, as_of: date, layout: str = "2022"
) -> None:
    """Clean the records of all JSON-lines files that have not been read yet, then stop.

    ``progress`` keeps the list of files read. A batch overwrites its own folder, so one that is repeated
    after a failure leaves no second copy. Amendments stay within their file, so a batch needs no state.
    Lines that are no record are written, with their file, to the folder ``<out>-rejects`` in the same way.
    """
    lines = spark.readStream.text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
    records = documents.judged_lines(lines)

    def write_batch(batch: DataFrame, number: int) -> None:
        bad = batch.where(F.col(documents.REJECTED).isNotNull()).select("path", F.col(documents.REJECTED).alias("line"))
        bad.write.mode("overwrite").parquet(f"{out}-rejects/batch={number}")
        flat = documents.flatten(batch.where(F.col(documents.REJECTED).isNull()).drop(documents.REJECTED), layout)
        placed = documents.with_source(flat, dataset, F.col("path")).drop("path")
        clean(placed, layout, as_of, ["sourceFile"]).write.mode("overwrite").parquet(f"{out}/batch={number}")

    (
        records.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
