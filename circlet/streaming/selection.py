"""R09-R11 and R12 over a stream of alignment records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.operators.selection import READ, competitive_groups, competitive_summary, depletion_candidates
from circlet.params import Params
from circlet.sources.alignments import parse_sam
from circlet.sources.tabular import file_name


def stream_depleted(spark: SparkSession, folder: str, p: Params, arrival: str | None = None) -> DataFrame:
    """Reads kept by nuclear depletion as SAM files arrive in ``folder``, once per (sample, name, mate).

    The rule looks at one record at a time; only the seen keys are state. By default every key is kept
    and the result is whole whenever a file arrives. With ``arrival`` the state is bounded instead: keys
    expire that long after their file was written, which is right only if all records of a read arrive
    within that time.
    """
    lines = spark.readStream.format("text").load(folder)
    named = lines.select(
        "value", F.regexp_replace(file_name(), "\\.sam$", "").alias("sample"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )
    kept = depletion_candidates(parse_sam(named), p)
    if arrival is None:
        return kept.dropDuplicates(list(READ))
    return kept.withWatermark("arrived", arrival).dropDuplicatesWithinWatermark(list(READ))


def stream_competitive(alignments: DataFrame, p: Params, quiet: str, late: str = "0 seconds", arrived: str = "arrived") -> DataFrame:
    """R09 over arriving records: a read's group closes, and its decision comes out, ``quiet`` after its last record.

    The group is a session window over ``arrived``, so only open reads are state, as partial aggregates, and the records of a read
    may come in any order and any number of micro-batches. Records may be ``late`` by so much before the watermark drops them.
    ``session`` tells the span of a group; a read that falls silent for longer than ``quiet`` has one group for each part.
    """
    watched = alignments.withWatermark(arrived, late)
    return competitive_groups(watched, p, F.session_window(arrived, quiet).alias("session"))


def decisions(alignments: DataFrame, p: Params, quiet: str, output: str, checkpoint: str, late: str = "0 seconds") -> DataFrame:
    """Runs ``stream_competitive`` over what has arrived so far and returns all decisions written to ``output``.

    The next call with the same folders goes on where this one stopped.
    """
    stream = stream_competitive(alignments, p, quiet, late)
    run = stream.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint)
    run.trigger(availableNow=True).start().awaitTermination()
    return alignments.sparkSession.read.schema(stream.schema).parquet(output)


def decision_summary(closed: DataFrame, p: Params) -> DataFrame:
    """R11 over closed groups."""
    return competitive_summary(closed, p)
