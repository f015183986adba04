"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from circlet.durable import materialize, shared_dir  # noqa: F401

HEAVY_SHARE = 1000
SLICE_ROWS = 256
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def whole_text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_bucket(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def attach_group(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with their one-row-per-key groups, safe for a key that holds most of the rows.

    At most ``HEAVY_SHARE`` keys can hold a thousandth of ``total`` rows each: those groups are broadcast. Any
    other key is small enough for one task of the shuffle join. Columns of both sides must differ but for the key.
    """
    least = max(2, total // HEAVY_SHARE)
    heavy = groups.where(F.col(size) >= least)
    light = groups.where(F.col(size) < least)
    extra = [c for c in groups.columns if c != key]
    marked = rows.join(F.broadcast(heavy.withColumnsRenamed({c: f"heavy_{c}" for c in extra})), key, "left")
    settled = marked.where(F.col(f"heavy_{size}").isNotNull()).select(*rows.columns, *[F.col(f"heavy_{c}").alias(c) for c in extra])
    rest = marked.where(F.col(f"heavy_{size}").isNull()).select(*rows.columns).join(light, key).select(*rows.columns, *extra)
    return settled.unionByName(rest)


def lean_worker() -> None:
    """Makes a Python worker give freed Arrow memory back to the system at once; workers live on between stages."""
    pa.set_memory_pool(pa.system_memory_pool())


def replace_text(rows: DataFrame, name: str, kind: T.DataType, compute: Callable[[list[str]], Iterable]) -> DataFrame:
    """Replaces the column ``text`` by a column computed from it in the tasks. All others pass as they are, unconverted."""
    names, arrow = [c for c in rows.columns if c != "text"], to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        for batch in (whole.slice(i, SLICE_ROWS) for whole in batches for i in range(0, whole.num_rows, SLICE_ROWS)):
            made = pa.array(list(compute(batch.column(batch.schema.get_field_index("text")).to_pylist())), type=arrow)
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], made], names=[*names, name])

    return rows.mapInArrow(run, T.StructType([*[rows.schema[n] for n in names], T.StructField(name, kind)]))


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m"):
    """Inside, rows go to Python workers in batches of bounded bytes, however long single rows are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def hash_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by the hash of a key: the same ones at every run. All rows if there are fewer."""
    total = rows.count()
    if total <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int((1 << 30) * bound / total))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, bound: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, label, text) of at most about ``bound`` labelled rows; ``allowed`` is a condition on doc_id.

    An id that is labelled twice takes the smaller label. The label side is bounded, so it is broadcast.
    """
    clean = labels.select(F.col(id_column).alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    chosen = hash_sample(clean.groupBy("doc_id").agg(F.min("label").alias("label")), "doc_id", bound)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def keep_scored(docs: DataFrame, score, condition: Column, text_column: str = "text") -> DataFrame:
    """Whole rows whose ``score`` meets a condition. ``score`` maps rows with a text to their other columns and a score.

    Columns travel under numbers, so that no name can clash with those that the scorer makes.
    """
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = F.coalesce(F.col(f"c{docs.columns.index(text_column)}"), F.lit("")).alias("text")
    return score(numbered.select("*", text)).where(condition).select(*numbered.columns).toDF(*docs.columns)
