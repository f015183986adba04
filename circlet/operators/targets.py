"""Configured deletions and motif searches as tables.

An item of the configuration becomes a row by its JSON text, and the rules below are column expressions. A configured deletion whose numbers do not parse is an
error; a search is left out. All tables here are as long as the configuration.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from circlet.functions import coords as C

FIELDS = ("id", "name", "description", "left_breakpoint", "right_breakpoint", "deleted_size", "breakpoint_tolerance_bp", "tolerance_bp", "size_tolerance_bp")
SEARCH_BREAKPOINT_TOLERANCE, SEARCH_SIZE_TOLERANCE = 100, 150
TWO_NUMBERS = "([0-9]{2,6})[^0-9]+([0-9]{2,6})"  # fixed: breakpoints written into the texts of a search
TARGET = ("name", "source", "reason", "left_breakpoint", "right_breakpoint", "deleted_size", "breakpoint_tolerance_bp", "size_tolerance_bp")


def _stated(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) != ""


def _number(name: str) -> Column:
    return F.trim(F.col(name)).try_cast("int")


def check_numbers(items: Iterable[Mapping]) -> list[Mapping]:
    """The items, if every number that they state is one; null would match any event."""
    listed = list(items)
    for item in listed:
        for name in FIELDS[3:]:
            text = "" if item.get(name) is None else str(item[name]).strip()
            if text and not re.fullmatch("[+-]?[0-9]+", text):
                raise ValueError(f"{item.get('name') or item.get('id')}: {name} is not a whole number: {text}")
    return listed


def item_rows(spark: SparkSession, items: Iterable[Mapping]) -> DataFrame:
    """Items in their order with text fields."""
    lines = spark.createDataFrame([(i, json.dumps(dict(x), default=str)) for i, x in enumerate(items)], "ord int, line string")
    schema = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">"
    return lines.select("ord", F.from_json("line", schema).alias("item")).select("ord", "item.*")


def search_rows(spark: SparkSession, searches: Iterable[Mapping], length: int, breakpoint_tolerance=None, size_tolerance=None) -> DataFrame:
    """Searches that name their ends: stated, or the first two numbers in their texts. What does not parse is left out."""
    texts = F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in ("id", "name", "description")])
    both = _stated("left_breakpoint") & _stated("right_breakpoint")
    end = lambda name, i: F.when(both, _number(name)).otherwise(F.regexp_extract(texts, TWO_NUMBERS, i).try_cast("int"))
    placed = item_rows(spark, searches).withColumns({"left": end("left_breakpoint", 1), "right": end("right_breakpoint", 2)})
    size = F.when(F.col("deleted_size").isNull(), C.directed_gap("left", "right", length)).otherwise(_number("deleted_size"))
    near = F.lit(SEARCH_BREAKPOINT_TOLERANCE if breakpoint_tolerance is None else int(breakpoint_tolerance))
    wide = F.lit(SEARCH_SIZE_TOLERANCE if size_tolerance is None else int(size_tolerance))
    return placed.select(
        "ord", F.coalesce("id", F.lit("")).alias("id"), F.coalesce("name", F.lit("")).alias("name"), "left", "right", size.alias("size"),
        F.coalesce(_number("breakpoint_tolerance_bp"), _number("tolerance_bp"), near).alias("near"),
        F.coalesce(_number("size_tolerance_bp"), wide).alias("wide"),
    ).where("left is not null and right is not null and size is not null")


def _listed(rows: DataFrame, *fields) -> Column:
    """All rows in their order as one array (the tables are as long as the configuration)."""
    return F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*fields).alias("row")))), lambda x: x["row"])


def deletion_targets(spark: SparkSession, known: Iterable[Mapping], searches: Iterable[Mapping], length: int, breakpoint_tolerance=None, size_tolerance=None) -> DataFrame:
    """one row with ``targets``: the configured ones, then those of searches that repeat none before them."""
    rows = item_rows(spark, check_numbers(known)).where(_stated("name"))
    near = F.coalesce(_number("breakpoint_tolerance_bp"), _number("tolerance_bp"), F.lit(50))
    configured = rows.agg(_listed(
        rows, F.trim("name").alias("name"), F.lit("analysis.known_deletions").alias("source"), F.lit("configured_known_deletion_match").alias("reason"),
        _number("left_breakpoint").alias("left_breakpoint"), _number("right_breakpoint").alias("right_breakpoint"), _number("deleted_size").alias("deleted_size"),
        near.alias("breakpoint_tolerance_bp"), F.coalesce(_number("size_tolerance_bp"), near).alias("size_tolerance_bp"),
    ).alias("kept"))
    named = search_rows(spark, searches, length, breakpoint_tolerance, size_tolerance)
    named = named.withColumn("called", F.trim(F.when(F.col("name") != "", F.col("name")).otherwise(F.col("id")))).where("called <> ''")
    inferred = named.agg(_listed(
        named, F.col("called").alias("name"), F.lit("analysis.known_sequence_searches").alias("source"), F.lit("configured_sequence_search_target_match").alias("reason"),
        F.col("left").alias("left_breakpoint"), F.col("right").alias("right_breakpoint"), F.col("size").alias("deleted_size"),
        F.col("near").alias("breakpoint_tolerance_bp"), F.col("wide").alias("size_tolerance_bp"),
    ).alias("new"))

    def repeats(old: Column, new: Column) -> Column:
        ends = [C.within_window(new[e], old[e], old["breakpoint_tolerance_bp"], length) for e in ("left_breakpoint", "right_breakpoint")]
        size = old["deleted_size"].isNull() | (F.abs(new["deleted_size"] - old["deleted_size"]) <= old["size_tolerance_bp"])
        return F.coalesce(ends[0] & ends[1] & size, F.lit(False))

    def add(kept: Column, new: Column) -> Column:
        return F.when(F.exists(kept, lambda old: repeats(old, new)), kept).otherwise(F.concat(kept, F.array(new)))

    return configured.join(inferred, F.lit(True)).select(F.aggregate("new", F.col("kept"), add).alias("targets"))  # one row each


def search_targets(spark: SparkSession, known: Iterable[Mapping], searches: Iterable[Mapping], length: int, breakpoint_tolerance=None, size_tolerance=None) -> DataFrame:
    """Ends and tolerances that each search looks for; the first configured deletion near both ends lends its own.

    Of searches with the same id the last one counts.
    """
    rows = item_rows(spark, known).where(_number("left_breakpoint").isNotNull() & _number("right_breakpoint").isNotNull())
    rows = rows.where(F.col("deleted_size").isNull() | _number("deleted_size").isNotNull())
    lenders = rows.agg(_listed(
        rows, F.coalesce("name", F.lit("")).alias("name"), _number("left_breakpoint").alias("left"), _number("right_breakpoint").alias("right"),
        F.coalesce(_number("breakpoint_tolerance_bp"), _number("tolerance_bp"), F.lit(SEARCH_BREAKPOINT_TOLERANCE)).alias("near"),
        F.coalesce(_number("size_tolerance_bp"), F.lit(SEARCH_SIZE_TOLERANCE)).alias("wide"),
    ).alias("lenders"))
    met = search_rows(spark, searches, length, breakpoint_tolerance, size_tolerance).join(lenders, F.lit(True))  # lenders is one row
    close = F.filter("lenders", lambda k: C.within_window("left", k["left"], k["near"], length) & C.within_window("right", k["right"], k["near"], length))
    lent = met.withColumn("lent", F.try_element_at(close, F.lit(1)))
    target = F.struct(
        F.col("name").alias("deletion_name"), F.col("left").alias("target_left_breakpoint"), F.col("right").alias("target_right_breakpoint"), F.col("size").alias("target_deleted_size"),
        F.coalesce("lent.near", "near").alias("breakpoint_tolerance_bp"), F.coalesce("lent.wide", "wide").alias("size_tolerance_bp"),
        F.coalesce("lent.name", F.lit("")).alias("matched_configured_target_label"),
    )
    return lent.groupBy(F.col("id").alias("deletion_id")).agg(F.max_by(target, "ord").alias("t")).select("deletion_id", "t.*")
