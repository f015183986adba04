"""Reads that span a position: brute force, and the work that the plan does."""

from pyspark.sql import functions as F

from circlet.operators import coverage as P
from circlet.params import Params


def test_spanning_shuffles_blocks_at_the_origin_only(spark, monkeypatch):
    """Blocks are shuffled for their longest per start once; reads over the origin count as by brute force."""
    plans = []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(P, "materialize", keep)
    p = Params(length=100, reference_window=5)
    rows = [
        ("s", "normal", "a", 80, 100), ("s", "normal", "a", 80, 95), ("s", "normal", "a", 1, 20), ("s", "normal", "a", 1, 8),
        ("s", "normal", "b", 97, 100), ("s", "normal", "b", 1, 30), ("s", "normal", "c", 60, 100), ("s", "normal", "d", 10, 40),
        ("s", "half", "a", 1, 30), ("s", "half", "e", 70, 100), ("s", "half", "e", 1, 3),
    ]
    blocks = spark.createDataFrame(rows, "sample string, rotation_name string, name string, start int, end int")
    wanted = spark.range(1, 101).select(F.lit("s").alias("sample"), F.col("id").cast("int").alias("position"))
    got = {(r["rotation_name"], r["position"]): r["depth"] for r in P.spanning_reads(blocks, wanted, p).collect()}

    def spans(rotation, position):
        names = set()
        for _, turn, name, start, end in rows:
            if turn == rotation and start + 5 <= position <= end - 5:
                names.add(name)
        for name in {r[2] for r in rows if r[1] == rotation}:
            own = [r for r in rows if r[1] == rotation and r[2] == name]
            tail = min((r[3] for r in own if r[4] == 100), default=None)
            head = max((r[4] for r in own if r[3] == 1), default=None)
            at = position if position <= 50 else position - 100
            if tail is not None and head is not None and -4 <= at <= 5 and tail + 5 - 100 <= at <= head - 5:
                names.add(name)
        return len(names)

    assert got == {(t, q): spans(t, q) for t in ("normal", "half") for q in range(1, 101)}
    assert plans[0].count("partial_max(end") == 1  # the longest block of a start is looked for once
