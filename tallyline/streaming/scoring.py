"""Scoring as a Structured Streaming job.

Scoring is stateless and row-wise: features are column expressions and the
model is a set of small broadcast tables, so the batch scoring functions run
unchanged on a streaming DataFrame as stream-static joins. New input files
are picked up as they land; the sink is exactly-once through its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyline import schemas as S
from tallyline.operators.hierarchy import HierarchicalMedianModel
from tallyline.plans import jobs
from tallyline.session import scratch_path


def read_inputs_stream(spark: SparkSession, path: str, columns: list[str], fmt: str = "csv") -> DataFrame:
    """Stream of scoring inputs from files in ``path`` (all columns as text for CSV)."""
    reader = spark.readStream.schema(S.string_schema(columns)).option("maxFilesPerTrigger", 64)
    if fmt == "csv":
        return reader.options(header=True, quote='"', escape='"').csv(path)
    return reader.format(fmt).load(path)


def score_task1_stream(
    spark: SparkSession,
    model: HierarchicalMedianModel,
    input_path: str,
    output_path: str,
    checkpoint: str | None = None,
    fmt: str = "csv",
    available_now: bool = False,
) -> StreamingQuery:
    """Continuously score Task 1 input files into Parquet under ``output_path``."""
    stream = read_inputs_stream(spark, input_path, S.TASK1_TEST_COLUMNS, fmt)
    scored = jobs.score_task1(model, stream)
    writer = scored.writeStream.format("parquet").option("path", output_path).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-task1")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.outputMode("append").start()


def score_task2_stream(
    spark: SparkSession,
    model: HierarchicalMedianModel,
    input_path: str,
    output_path: str,
    checkpoint: str | None = None,
    fmt: str = "csv",
    available_now: bool = False,
) -> StreamingQuery:
    """Continuously score Task 2 input files into Parquet under ``output_path``."""
    stream = read_inputs_stream(spark, input_path, S.TASK2_TEST_COLUMNS, fmt)
    scored = jobs.score_task2(model, stream)
    writer = scored.writeStream.format("parquet").option("path", output_path).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-task2")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.outputMode("append").start()
