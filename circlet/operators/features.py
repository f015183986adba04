"""Interval features on the circle: preparation and matching."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.functions import coords as C
from circlet.operators.ranking import last_known, running_max

COLUMNS = "contig string, start int, end int, strand string, feature_type string, gene_id string, gene_name string, transcript_id string, product string"

# fixed values: which record type stands for a name that occurs several times
TYPE_PRIORITY = {"gene": 0, "tRNA": 1, "rRNA": 1, "CDS": 2, "transcript": 3, "exon": 4, "region": 5}
CODING_PREFIXES = ("mt-co", "mt-cy", "mt-nd", "mt-atp")
CODING_TYPES = ("cds", "gene", "protein_coding")

LITERAL_FEATURES = 2000  # above this, features are joined instead of carried as a constant


def _starts(col: Column, *prefixes: str) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | col.startswith(prefix)
    return test


def _blank_to_null(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def add_regions(features: DataFrame, regions: Iterable[Mapping], length: int) -> DataFrame:
    """configured regions as features, split at the origin."""
    rows = []
    for item in regions:
        name, start, end = str(item.get("name", "")).strip(), int(item.get("start") or 0), int(item.get("end") or 0)
        if name and start > 0 and end > 0:
            spans = [(start, end)] if start <= end else [(start, length), (1, end)]
            rows += [("", s, e, ".", "region", name, name, "", str(item.get("reason", ""))) for s, e in spans]
    if not rows:
        return features
    return features.unionByName(features.sparkSession.createDataFrame(rows, COLUMNS), allowMissingColumns=True)


def _priority() -> Column:
    table = F.create_map(*[F.lit(x) for kv in TYPE_PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.col("feature_type")), F.lit(99))


def one_per_name(features: DataFrame) -> DataFrame:
    """one feature per name by type priority, length, start, end; regions keep every range."""
    name = F.coalesce(_blank_to_null("gene_name"), _blank_to_null("gene_id"), _blank_to_null("product"))
    span = F.concat_ws("-", "start", "end")
    key = F.when(F.col("feature_type") == "region", F.concat_ws(":", "_name", span)).otherwise(F.col("_name"))
    usable = features.withColumn("_name", name).filter("_name is not null and start is not null and end is not null")
    w = W.partitionBy("_key").orderBy(_priority(), F.col("end") - F.col("start"), "start", "end")
    return (
        usable.withColumn("_key", key)
        .withColumn("_n", F.row_number().over(w))
        .filter("_n = 1")
        .withColumn("gene_name", F.col("_name"))
        .drop("_name", "_key", "_n")
    )


def infer_type(name, feature_type) -> Column:
    """display type from name and record type."""
    text = F.lower(F.coalesce(C._c(name), F.lit("")))
    raw = F.lower(F.coalesce(C._c(feature_type), F.lit("")))
    return (
        F.when(raw == "region", "region")
        .when(raw.contains("trna") | _starts(text, "mt-t", "trn"), "tRNA")
        .when(raw.contains("rrna") | _starts(text, "mt-r", "rrn"), "rRNA")
        .when(raw.contains("protein_coding") | raw.contains("cds") | _starts(text, *CODING_PREFIXES), "protein_coding")
        .otherwise(F.coalesce(C._c(feature_type), F.lit("")))
    )


def _alias_match(rule: Mapping) -> Column:
    test = F.lit(True)
    if rule.get("raw_name"):
        test = test & (F.col("gene_name") == str(rule["raw_name"]))
    if rule.get("gene_id"):
        test = test & (F.col("gene_id") == str(rule["gene_id"]))
    for bound in ("start", "end"):
        if rule.get(bound) is not None:
            test = test & (F.col(bound) == int(rule[bound]))
    return F.coalesce(test, F.lit(False))


def display_name(aliases: Iterable[Mapping], base: Column) -> Column:
    """configured display names; of several matching rules the last one wins."""
    rules = [r for r in aliases if str(r.get("display_name", "")).strip()]
    out = base
    for rule in rules:
        out = F.when(_alias_match(rule), F.lit(str(rule["display_name"]).strip())).otherwise(out)
    return out


def apply_aliases(features: DataFrame, aliases: Iterable[Mapping]) -> DataFrame:
    """F03 and F04."""
    named = features.withColumns(
        {"raw_gene_name": F.col("gene_name"), "display_name": display_name(aliases, F.col("gene_name"))}
    )
    return named.withColumn("gene_name", F.col("display_name")).withColumn(
        "feature_type", infer_type("gene_name", "feature_type")
    )


def prepare(features: DataFrame, regions, aliases, length: int) -> DataFrame:
    """The feature table every annotation uses."""
    return apply_aliases(one_per_name(add_regions(features, regions, length)), aliases)


_ENTRY = (
    "struct<ord:int,name:string,type:string,start:int,end:int,coding:boolean,control:boolean,rna:boolean>"
)


class Features:
    """A prepared feature table, with the matching operators on it.

    A table of up to ``LITERAL_FEATURES`` rows travels inside the plan as one constant, so matching
    needs no shuffle at all. A larger one is joined: interval overlaps by bucket, nearest features
    against the distinct positions (never more than the circle has).
    """

    def __init__(self, table: DataFrame, length: int, limit: int = LITERAL_FEATURES):
        self.length, self._given, self._limit = length, table, limit
        name = F.coalesce(_blank_to_null("gene_name"), _blank_to_null("gene_id"), _blank_to_null("product"), F.lit("unknown"))
        lower = F.lower("name")
        coding = F.lower("type").isin(*CODING_TYPES)
        per_name = W.partitionBy("name")
        entries = (
            table.filter("start is not null and end is not null")
            .select(name.alias("name"), F.coalesce("feature_type", F.lit("")).alias("type"),
                    F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
            .withColumns({
                "coding": F.min(coding).over(per_name),
                "control": lower.contains("d-loop") | lower.contains("d_loop") | lower.contains("control"),
                "rna": lower.contains("trn") | lower.contains("rrn") | _starts(lower, "mt-t", "mt-r"),
            })
        )
        self._entries = entries
        head = entries.limit(limit + 1).collect()
        self.small = len(head) <= limit
        if self.small:
            rows = sorted((r.asDict() for r in head), key=lambda r: (r["start"], r["end"], r["name"]))
            text = json.dumps([{**r, "ord": i} for i, r in enumerate(rows)])
            self._constant = F.from_json(F.lit(text), f"array<{_ENTRY}>")
        else:
            # (start, end, name) order as one sortable number is not needed: keep it as a struct
            same = W.partitionBy("start", "end", "name", "type").orderBy(F.lit(1))  # equal rows stay apart
            self._table = entries.withColumn("ord", F.xxhash64("start", "end", "name", "type")).withColumn("copy", F.row_number().over(same))

    def genes(self) -> Features:
        """The features that can anchor a gene: named ones, without configured regions."""
        named = F.coalesce(_blank_to_null("gene_name"), _blank_to_null("gene_id")).isNotNull()
        return Features(self._given.where(named & (F.coalesce("feature_type", F.lit("")) != "region")), self.length, self._limit)

    # -- overlaps -------------------------------------------------------------------------

    def overlaps(self, df: DataFrame, pieces: Column, out: str) -> DataFrame:
        """Add ``out``: features that share bases with ``pieces``, in (start, end, name) order."""
        if self.small:
            hit = F.transform(
                self._constant,
                lambda f: F.struct(
                    f["start"].alias("start"), f["end"].alias("end"), f["name"].alias("name"), f["type"].alias("type"),
                    f["coding"].alias("coding"), f["control"].alias("control"), f["rna"].alias("rna"),
                    C.pieces_overlap(F.col("_pieces"), F.array(F.struct(f["start"].alias("start"), f["end"].alias("end")))).alias("overlap"),
                ),
            )
            found = F.filter(hit, lambda h: h["overlap"] > 0)
            return df.withColumn("_pieces", pieces).withColumn(out, found).drop("_pieces")
        keyed = df.withColumn("_pieces", pieces)
        width = max(1, self.length // 256)

        def cut(pos):
            return F.floor(pos / F.lit(width)).cast("int")

        spans = keyed.select("_pieces").distinct().select("_pieces", F.explode("_pieces").alias("p"))
        spans = spans.withColumn("bucket", F.explode(F.sequence(cut(F.col("p.start")), cut(F.col("p.end")))))
        cells = self._table.withColumn("bucket", F.explode(F.sequence(cut(F.col("start")), cut(F.col("end")))))
        low = F.greatest(F.col("p.start"), F.col("start"))
        shared = F.least(F.col("p.end"), F.col("end")) - low + 1
        met = spans.join(cells, "bucket").filter((shared > 0) & (F.col("bucket") == cut(low)))
        fields = ["start", "end", "name", "type", "coding", "control", "rna"]
        per = met.groupBy("_pieces", "ord", "copy", *fields).agg(F.sum(shared).cast("int").alias("overlap"))
        lists = per.groupBy("_pieces").agg(F.array_sort(F.collect_list(F.struct(*fields, "overlap"))).alias(out))
        joined = keyed.join(lists, "_pieces", "left").drop("_pieces")
        blank = F.array().cast(joined.schema[out].dataType)
        return joined.withColumn(out, F.coalesce(F.col(out), blank))

    def ranked_hits(self, df: DataFrame, start, end, out: str) -> DataFrame:
        """Q04: overlapping features ranked by overlap (largest first), name, start."""
        piece = F.array(F.struct(C._c(start).alias("start"), C._c(end).alias("end")))
        hit = self.overlaps(df, piece, out)
        rank = F.array_sort(F.transform(out, lambda h: F.struct((-h["overlap"]).alias("k"), h["name"].alias("name"), h["start"].alias("start"), h["end"].alias("end"))))
        return hit.withColumn(out, rank)

    def at(self, df: DataFrame, pos, out: str) -> DataFrame:
        """``name:type:start-end`` of every feature that contains the position."""
        hit = self.overlaps(df, F.array(F.struct(C._c(pos).alias("start"), C._c(pos).alias("end"))), out)
        return hit.withColumn(out, F.array_join(F.transform(out, _label), ";"))

    # -- nearest --------------------------------------------------------------------------

    def nearest(self, df: DataFrame, pos: str, out: str) -> DataFrame:
        """closest feature by linear distance (0 inside); ties take (start, end, name, type) order.

        The positions are sorted among the ends of the features, whatever the number of either. What a position needs is the
        last feature that ended before it, the first that starts after it, and the first start whose
        features, with all before them, reach it: the running maximum of ends first gets there with a feature that contains it.
        """
        features = self._entries.select("start", "end", "name", "type")
        at = df.select(F.col(pos).cast("int").alias("x")).filter("x is not null").distinct()
        whole = F.struct("start", "end", "name", "type")
        by_end = features.groupBy(F.col("end").alias("x")).agg(F.min(whole).alias("f"))
        by_start = features.groupBy(F.col("start").alias("x")).agg(F.min(whole).alias("f"))
        behind = self._swept(at, by_end, positions_first=True, backwards=False, out="before")
        ahead = self._swept(at, by_start, positions_first=True, backwards=True, out="after")
        # starts at which the running maximum of ends grows, at the end that it grows to
        reach = features.groupBy("start").agg(F.max("end").alias("end")).withColumn("f", F.struct("end", "start"))
        records = running_max(reach, ["start"], "end", "_top").filter(F.col("end") > F.coalesce("_top", F.lit(-(1 << 30)))).select(F.col("end").alias("x"), F.struct("start").alias("f"))
        around = self._swept(at, records, positions_first=False, backwards=True, out="first").filter("first.start <= x")
        held = around.select("x", F.col("first.start").alias("start")).join(features, "start").filter("end >= x")
        inside = held.groupBy("x").agg(F.min(whole).alias("inside"))

        def scored(f, distance):
            return F.when(F.col(f).isNotNull(), F.struct(distance.alias("d"), F.col(f"{f}.start").alias("start"), F.col(f"{f}.end").alias("end"), F.col(f"{f}.name").alias("name"), F.col(f"{f}.type").alias("type")))

        best = F.array_min(F.array_compact(F.array(scored("inside", F.lit(0)), scored("before", F.col("x") - F.col("before.end")), scored("after", F.col("after.start") - F.col("x")))))
        found = at.join(inside, "x", "left").join(behind, "x", "left").join(ahead, "x", "left").select(F.col("x").alias("_x"), best.alias(out))
        placed = df.join(found, F.col(pos).cast("int") == F.col("_x"), "left").drop("_x")
        text = F.concat(_label(F.col(out)), F.lit(";distance="), F.col(out)["d"].cast("string"))
        return placed.withColumn(out, F.coalesce(text, F.lit("")))

    def _swept(self, at: DataFrame, marks: DataFrame, positions_first: bool, backwards: bool, out: str) -> DataFrame:
        """x and the feature of the last mark that stands before it, in either direction."""
        kind = marks.schema["f"].dataType
        position, mark = (0, 1) if positions_first else (1, 0)
        rows = at.select("x", F.lit(position).alias("k"), F.lit(None).cast(kind).alias("f")).unionByName(marks.select("x", F.lit(mark).alias("k"), "f"))
        swept = last_known(rows, [F.desc("x") if backwards else F.asc("x"), "k"], "f", out)
        return swept.filter(F.col("k") == position).select("x", out)

    # -- impact ---------------------------------------------------------------------------

    def impact(self, df: DataFrame, left: str, right: str) -> DataFrame:
        """what a deleted arc removes, fully or partly, and the class of the change."""
        hit = self.overlaps(df, C.deleted_pieces(left, right, self.length), "_hits")
        full = lambda h: h["overlap"] >= h["end"] - h["start"] + 1
        names = F.array_distinct(F.transform("_hits", lambda h: h["name"]))
        hit = hit.withColumn("_names", names)
        count = F.size("_names")
        label = F.when(count == 0, "intergenic").otherwise(F.array_join("_names", "+"))
        kind = (
            F.when(F.exists("_hits", lambda h: h["control"]), "d_loop_involved")
            .when(F.exists("_hits", lambda h: h["rna"]), "rrna_trna_involved")
            .when(count == 0, "intergenic")
            .when(count == 1, "single_feature")
            .when(count == 2, "two_features")
            .when(F.forall("_hits", lambda h: h["coding"]), "multi_feature_protein_coding_only")
            .otherwise("multi_feature_mixed")
        )
        detail = F.transform(
            "_hits",
            lambda h: F.concat_ws(":", h["name"], F.when(full(h), "full").otherwise("partial"), h["overlap"].cast("string")),
        )
        return hit.withColumns(
            {
                "affected_feature_label": label,
                "affected_features": F.array_join("_names", ";"),
                "fully_removed_features": F.array_join(F.transform(F.filter("_hits", full), lambda h: h["name"]), ";"),
                "partially_overlapped_features": F.array_join(
                    F.transform(F.filter("_hits", lambda h: ~full(h)), lambda h: h["name"]), ";"
                ),
                "feature_impact_class": kind,
                "per_feature_overlap_details": F.array_join(detail, ";"),
            }
        ).drop("_hits", "_names")


def _label(f) -> Column:
    span = F.concat(f["start"].cast("string"), F.lit("-"), f["end"].cast("string"))
    return F.concat_ws(":", f["name"], f["type"], span)


# ---- display tables ----------------------------------------------------------------------


def display_class() -> Column:
    """class shown for a feature row with ``gene_name`` and ``feature_type``."""
    name, kind = F.lower("gene_name"), F.lower("feature_type")
    gene_like = kind.isin("cds", "gene")
    return (
        F.when(kind == "region", "configured region")
        .when(kind.contains("trna") | _starts(name, "mt-t", "trn"), "tRNA")
        .when(kind.contains("rrna") | _starts(name, "mt-r", "rrn"), "rRNA")
        .when(kind.contains("protein_coding") | (gene_like & _starts(name, *CODING_PREFIXES)), "protein_coding")
        .when(gene_like & (name != ""), "gene")
        .otherwise(F.coalesce(F.nullif(kind, F.lit("")), F.lit("feature")))
    )


def display_features(features: DataFrame, regions, aliases) -> DataFrame:
    """one row per displayed name, plus configured regions, with length."""
    base = F.coalesce(_blank_to_null("gene_name"), _blank_to_null("gene_id"), _blank_to_null("product"))
    named = features.withColumn("feature_name", display_name(aliases, base)).filter(
        "feature_name is not null and feature_name <> '' and start is not null and end is not null"
    )
    w = W.partitionBy("feature_name").orderBy(_priority(), F.col("end") - F.col("start"), "start", "end")
    own = named.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(
        "feature_name", display_class().alias("feature_class"), "start", "end", "strand",
        (F.col("end") - F.col("start") + 1).alias("length_bp"),
    )
    rows = [
        (str(r.get("name", "")), "configured region", int(r["start"]), int(r["end"]), ".",
         abs(int(r["end"]) - int(r["start"])) + 1)
        for r in regions
    ]
    if not rows:
        return own
    schema = "feature_name string, feature_class string, start int, end int, strand string, length_bp int"
    return own.unionByName(features.sparkSession.createDataFrame(rows, schema))


def track_features(features: DataFrame, regions, aliases) -> DataFrame:
    """features drawn on a position track: genes and regions only, where there are any."""
    raw = F.lower(F.coalesce("feature_type", F.lit("")))
    marked = features.withColumn("_keep", raw.isin("gene", "region"))
    some = F.max(F.col("_keep")).over(W.partitionBy(F.lit(1)))
    kept = marked.withColumn("_some", some).filter("_keep or not _some").drop("_keep", "_some")
    named = apply_aliases(kept, aliases).filter("end > start")
    own = named.select("start", "end", F.col("gene_name").alias("name"), display_class().alias("class"))
    rows = [(int(r["start"]), int(r["end"]), str(r["name"]), "region") for r in regions]
    if rows:
        extra = features.sparkSession.createDataFrame(rows, "start int, end int, name string, class string")
        own = own.unionByName(extra)
    return own.distinct()


def implied_length(length: int, features: DataFrame, events: DataFrame) -> int:
    """the configured circle length, else the largest coordinate seen."""
    if length > 0:
        return length
    a = features.agg(F.max("end")).first()[0]
    b = events.agg(F.greatest(F.max("left_breakpoint"), F.max("right_breakpoint"))).first()[0]
    return max([int(v) for v in (a, b) if v is not None], default=1)
