"""The clean job over files that arrived since the last run.

File discovery with a checkpoint takes the place of listing run-date folders. The
job itself is the batch job; loading an epoch again after a failure replaces what it
left in the quarantine and the metrics, and changes nothing in the tables but stamps.
"""

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.clean import CleanJob, run_clean
from tidemark.sources.readers import CORRUPT_COLUMN, text_schema


def clean_arrivals(
    spark: SparkSession, raw_path: str, checkpoint: str, job: CleanJob, multiline: bool = False
) -> None:
    """Process every raw file not processed yet, then stop."""

    def load(batch: DataFrame, epoch: int) -> None:
        run_clean(batch, job, ds=f"epoch-{epoch:010d}")

    arrivals = (
        spark.readStream.schema(text_schema(job.raw_schema))
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(raw_path)
    )
    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
