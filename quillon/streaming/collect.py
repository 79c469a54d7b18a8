"""Incremental collection of result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.operators.results import collect_vectors, parse_result_lines
from quillon.sources.epochs import read_epochs, write_epoch
from quillon.sources.results import attach_batches, located_lines, numbered_lines
from quillon.streaming.sink import run_available

LINE_SCHEMA = (
    "file_name string, file_path string, file_block bigint, line_no bigint, key string, "
    "vector array<double>, error_text string, error_class string, norm double, norm_warning boolean"
)


def result_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """New result files of a folder, line by line with their origin."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    return located_lines(reader.option("maxFilesPerTrigger", files_per_trigger).text(path))


def parse_stream(
    spark: SparkSession, results: str, lines: str, checkpoint: str, dim: int, files_per_trigger: int = 1000
) -> DataFrame:
    """Append the parsed lines of result files not seen before; returns all lines so far.

    The source's checkpoint hands each file out once and each epoch replaces its own
    folder, so a restart after a crash neither loses nor repeats lines. An epoch reads
    nothing that was stored before.
    """

    def each(arrived: DataFrame, epoch: int) -> None:
        parsed = parse_result_lines(numbered_lines(arrived), dim)
        columns = [part.split()[0] for part in LINE_SCHEMA.split(", ")]
        write_epoch(parsed.select(*columns), lines, epoch)

    run_available(result_stream(spark, results, files_per_trigger), each, checkpoint)
    return read_epochs(spark, lines, LINE_SCHEMA)


def collect_stream(
    spark: SparkSession, results: str, lines: str, checkpoint: str,
    records: DataFrame, batches: DataFrame, dim: int, files_per_trigger: int = 1000,
) -> DataFrame:
    """Take in new result files; returns the vectors of all lines so far.

    Lines meet their batches when they are read, not when they arrive: a batch that becomes
    known later, or is delivered twice, gives what one collection of all files gives.
    """
    stored = parse_stream(spark, results, lines, checkpoint, dim, files_per_trigger)
    return collect_vectors(attach_batches(stored, batches), records)
