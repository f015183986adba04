"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its words (runs of digits, letters and all characters beyond ASCII) joined by single blanks. A few stems are
looked for first; only texts with a stem meet the rules, and of those only the ones whose stem and keyword they
hold. A rule marks its places in the text, and the marked words give their numbers. A detection that lies inside
another one of at least its priority is suppressed; of equal stretches the higher priority stays, then the earlier rule.
The base phrases are rules too: their places are all counted and their labels stay whatever suppresses them.

All happens inside the row: nothing shuffles, and a task holds one text with its detections at a time.

Defined cases: a null or empty text, or one without words, has no words, no places and the score 0. Rows that repeat an id are scanned
each by themselves. Places of one rule do not overlap; those of the base phrases cannot. An empty table gives an empty result. Other
columns are dropped, so their names cannot clash.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from circlet.llm.license_rules import RULES, Rule

NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHTS = {4: 0.99, 3: 0.9, 2: 0.7, 1: 0.4}  # score of the strongest detection that stays
HIT = "array<struct<start:int,before:int,below:int,rule:int,label:string,base:boolean>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _fix(frame: DataFrame, columns: list[str], name: str, value: Column) -> DataFrame:
    """Adds a column and keeps the optimizer from copying its expression into every use."""
    return frame.select(*columns, F.explode(F.array(value)).alias(name))


def _rule_table(rules: list[Rule]) -> Column:
    """The rules as one constant."""
    rows = [
        {"rule": i, "label": r.label, "priority": r.priority, "stem": r.stem, "keyword": r.keyword, "pattern": f"(?<= )(?i:({r.pattern}))(?= )", "base": r.base}
        for i, r in enumerate(rules)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rule:int,label:string,priority:int,stem:string,keyword:string,pattern:string,base:boolean>>")


def _places(rule: Column, marked: Column) -> Column:
    """Detections of one rule in a text in which it has marked them."""
    words = F.split(marked, " ")
    numbered = F.transform(words, lambda w, i: F.struct((i - 1).alias("i"), w.startswith("\x01").alias("starts"), w.endswith("\x02").alias("ends")))

    def zipped(all_words: Column) -> Column:
        starts = F.transform(F.filter(all_words, lambda x: x["starts"]), lambda x: x["i"])
        ends = F.transform(F.filter(all_words, lambda x: x["ends"]), lambda x: x["i"])
        return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (-e).alias("before"), (-rule["priority"]).alias("below"), rule["rule"].alias("rule"), rule["label"].alias("label"), rule["base"].alias("base")))

    return _let(numbered, zipped)


def _hits(norm: Column, rules: list[Rule]) -> Column:
    """All detections, by start, longest first, then priority and order of the rules."""
    stems = F.array(*[F.lit(s) for s in sorted({r.stem for r in rules})])
    none = F.array().cast(HIT)

    def tried(low: Column, present: Column) -> Column:
        fitting = F.filter(_rule_table(rules), lambda r: F.array_contains(present, r["stem"]) & F.contains(low, r["keyword"]))
        found = F.transform(fitting, lambda r: _let(F.regexp_replace(norm, r["pattern"], F.lit("\x01$1\x02")), lambda marked: F.when(F.contains(marked, F.lit("\x01")), _places(r, marked)).otherwise(none)))
        return F.array_sort(F.flatten(found)).cast(HIT)

    return _let(F.lower(norm), lambda low: _let(F.filter(stems, lambda s: F.contains(low, s)), lambda present: F.when(F.size(present) > 0, tried(low, present)).otherwise(none)))


def _kept(hits: Column) -> Column:
    """Distinct labels of the detections that stay, and the highest priority among them."""
    levels = sorted(WEIGHTS)
    begin = F.struct(*[F.lit(-1).alias(f"end{p}") for p in levels], F.array().cast("array<string>").alias("labels"), F.lit(0).alias("top"))

    def step(state: Column, hit: Column) -> Column:
        end, priority = -hit["before"], -hit["below"]
        reach = F.coalesce(*[F.when(priority == p, state[f"end{p}"]) for p in levels])  # farthest end of this priority and above
        inside = reach >= end
        return F.struct(
            *[F.when((priority >= p) & (end > state[f"end{p}"]), end).otherwise(state[f"end{p}"]).alias(f"end{p}") for p in levels],
            F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(hit["label"]))).alias("labels"),
            F.when(inside, state["top"]).otherwise(F.greatest(state["top"], priority)).alias("top"),
        )

    return F.aggregate(hits, begin, step)


def detections(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words and the sorted array ``hits`` of all detections of every document, suppressed ones too."""
    only = F.trim(F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")), NO_WORD, " "))
    norm = F.concat(F.lit(" "), only, F.lit(" "))
    rows = docs.select(F.col(id_column).alias("doc_id"), norm.alias("made"))
    rows = _fix(rows, ["doc_id"], "norm", F.col("made"))
    n_words = F.when(F.col("norm") == "  ", F.lit(0)).otherwise(F.length("norm") - F.length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) - 1)
    return _fix(rows.select("doc_id", n_words.cast("long").alias("n_words"), "norm"), ["doc_id", "n_words"], "hits", _hits(F.col("norm"), RULES if rules is None else rules))


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, the base places, base labels, labels of all detections that stay, and a score, for every document."""
    found = detections(docs, id_column, text_column, rules)
    base = F.filter("hits", lambda h: h["base"])
    read = _fix(found.select("doc_id", "n_words", "hits", base.alias("made")), ["doc_id", "n_words", "hits"], "base", F.col("made"))
    read = _fix(read.select("*", _kept(F.col("hits")).alias("made")), ["doc_id", "n_words", "base"], "kept", F.col("made"))
    starts = F.transform("base", lambda h: h["start"].cast("long"))
    base_labels = F.array_distinct(F.transform("base", lambda h: h["label"]))
    weight = F.coalesce(*[F.when(F.col("kept.top") == p, F.lit(w)) for p, w in WEIGHTS.items()], F.lit(0.0))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    return read.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(F.array_union(base_labels, F.col("kept.labels"))).alias("labels"), weight.alias("score"),
    )


def license_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """One row for each detection: doc_id, row (number of the document's row), label, priority, rule, first and last word, kept.

    The window runs over the detections of one text.
    """
    found = detections(docs, id_column, text_column, rules).withColumn("row", F.monotonically_increasing_id())
    each = found.select("doc_id", "row", F.posexplode("hits").alias("place", "hit")).select("doc_id", "row", "place", "hit.*")
    before = Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    end, priority = -F.col("before"), -F.col("below")
    reach = F.coalesce(*[F.when(priority == p, F.max(F.when(priority >= p, end)).over(before)) for p in WEIGHTS])
    return each.select("doc_id", "row", "label", priority.alias("priority"), "rule", F.col("start").alias("first_word"), end.alias("last_word"), (F.coalesce(reach, F.lit(-1)) < end).alias("kept"))
