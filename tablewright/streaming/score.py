"""Scoring rows as they arrive, with Structured Streaming.

Scoring looks at one row at a time, so the stream keeps no state and needs no
watermark; the checkpoint folder makes a restart continue where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.functions.columns import named
from tablewright.operators.header import clean_header
from tablewright.plans.score import score_output, score_rows
from tablewright.sources.sinks import write_table
from tablewright.sources.staging import drop_staged, stage
from tablewright.sources.tables import (
    MALFORMED,
    MALFORMED_COUNT,
    NULL_TEXT,
    from_requests,
    from_split_requests,
    mark_requests,
    mark_split_requests,
    marked_text,
    marking,
    without_malformed,
)


# Files that a batch of a stream takes unless told otherwise.
FILES_PER_TRIGGER = 1000


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    files_per_trigger: int | None = FILES_PER_TRIGGER,
) -> DataFrame:
    """New files of a folder: Parquet, CSV, or requests as JSON, one per line.

    A request is a record of column values (``requests``) or a document with
    columns and rows apart (``split_requests``).

    The progress of a CSV or request stream reports the malformed rows it left out, under
    ``observedMetrics['malformed']``. A batch takes at most ``files_per_trigger`` files, so
    that a long backlog is worked off in parts; ``None`` takes all.
    """
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if format == "requests":
        return from_requests(reader.text(path), schema, MALFORMED_COUNT)
    if format == "split_requests":
        return from_split_requests(reader.text(path), schema, MALFORMED_COUNT)
    if format == "csv":
        # The header of each file must match the schema instead of being ignored.
        reader = reader.options(
            header=True, nullValue=NULL_TEXT, enforceSchema=False, columnPruning=False
        )
        return without_malformed(marking(reader, schema).csv(path), MALFORMED_COUNT)
    if format != "parquet":
        raise ValueError(f"Unknown format '{format}', use parquet, csv, requests or split_requests.")
    return reader.schema(schema).parquet(path)


def text_schema(names: Sequence[str]) -> T.StructType:
    """All columns as text, the way the fields of a CSV stream are read."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def write_stream(
    rows: DataFrame,
    output_path: str,
    checkpoint: str,
    format: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Append to a folder: all available rows and stop, or every ``interval``."""
    writer = rows.writeStream.format(format).option("checkpointLocation", checkpoint)
    if format == "csv":
        writer = writer.option("header", True)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start(output_path)


def score_stream(
    model: PipelineModel,
    stream: DataFrame,
    output_path: str,
    checkpoint: str,
    ids: Sequence[str] = (),
    label: str | None = None,
    run: Row | None = None,
    keep_input: bool = False,
    format: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """The same rows as batch scoring, written as they come in."""
    stream = clean_header(stream)
    scored = score_rows(model, stream, run)
    kept = stream.columns if keep_input else None
    result = score_output(scored, ids, label, kept, format)
    return write_stream(result, output_path, checkpoint, format, interval)


# The column that holds a broken record's text in the quarantine, and the folder of a batch.
BROKEN_TEXT = "value"
BATCH = "batch"


def marked_batch(spark: SparkSession, files: list[str], format: str, schema: T.StructType | None) -> DataFrame:
    """The records of some files, broken ones marked with their text."""
    if format == "csv":
        return marked_text(spark, files)
    readers = {"requests": mark_requests, "split_requests": mark_split_requests}
    if format not in readers or schema is None:
        raise ValueError(f"Unknown format '{format}', use csv, or requests or split_requests with a schema.")
    return readers[format](spark.read.text(files), schema)


def score_files(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    output_path: str,
    checkpoint: str,
    quarantine: str | None = None,
    format: str = "csv",
    schema: T.StructType | None = None,
    ids: Sequence[str] = (),
    label: str | None = None,
    run: Row | None = None,
    keep_input: bool = False,
    output_format: str = "parquet",
    interval: str | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Score new files of a folder, each batch of files into a folder of its own.

    The stream is one of file names; a batch reads its files as batch scoring does, so CSV
    columns go by each file's own header. A batch overwrites ``batch=<number>``, so one that is
    run again after a failure leaves no row twice. Broken records go as text to ``quarantine``,
    or are left out without it.
    """
    names = "path string, modificationTime timestamp, length long, content binary"

    def scored_batch(batch: DataFrame, number: int) -> None:
        files = [row.path for row in batch.collect()]
        if not files:
            return
        parsed = marked_batch(spark, files, format, schema)
        # Parsed once; staged by position, as header texts need not be valid column names.
        staged = stage(parsed.toDF(*[f"c{i}" for i in range(len(parsed.columns))]), "batch")
        try:
            marked = spark.read.parquet(staged).toDF(*parsed.columns)
            broken = named(MALFORMED).isNotNull()
            rows = clean_header(marked.filter(~broken).drop(MALFORMED))
            scored = score_rows(model, rows, run)
            result = score_output(scored, ids, label, rows.columns if keep_input else None, output_format)
            write_table(result, f"{output_path}/{BATCH}={number}", output_format)
            if quarantine is not None:
                texts = marked.filter(broken).select(named(MALFORMED).alias(BROKEN_TEXT))
                write_table(texts, f"{quarantine}/{BATCH}={number}", "parquet")
        finally:
            drop_staged(spark, staged)

    stream = (
        spark.readStream.format("binaryFile")
        .schema(names)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(source)
        .select("path")
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(scored_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
