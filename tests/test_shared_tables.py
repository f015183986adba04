"""Tables that queries share: narrow ones hold the same rows and carry no column that nobody reads."""

from pathlib import Path

import pytest

from circlet.plans import fixtures as X0
from circlet.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
def test_narrow_events(spark, monkeypatch):
    """Observations and exact clusters start from segments without provenance, and get the rows of the wide events."""
    X0.forget_stages()
    taken, call = [], X0.D.call_events

    def seen(segments, p):
        taken.append(set(segments.columns))
        return call(segments, p)

    monkeypatch.setattr(X0.D, "call_events", seen)

    def results():
        clusters = X0.exact_clusters(spark, str(DATA)).drop("supporting_samples", "rotations")
        return sorted(map(str, X0.observed(spark, str(DATA)).collect())), sorted(map(str, clusters.collect()))

    narrow = results()
    assert len(taken) == 1 and not taken[0] & {"sa_tag", "alignment_score", "edit_distance", "alignment_type"}
    X0.forget_stages()
    X0.events(spark, str(DATA))
    assert narrow == results() and narrow[0] and narrow[1]
    assert "sa_tag" in taken[1] and len(taken) == 2
    X0.forget_stages()


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
def test_narrow_evidence(spark, monkeypatch):
    """Counts of labels start from the evidence rows without the wide columns of their cluster, and are the same."""
    X0.forget_stages()
    made = []

    def seen(df, name):
        made.append((name, len(df.columns)))
        return materialize(df, name)

    materialize = X0.materialize
    monkeypatch.setattr(X0, "materialize", seen)
    narrow = sorted(map(str, QUERIES["a_counts"](spark, str(DATA)).collect()))
    assert ("labelled", 7) in made and "evidence" not in dict(made)
    X0.forget_stages()
    QUERIES["a_evidence"](spark, str(DATA))
    assert narrow == sorted(map(str, QUERIES["a_counts"](spark, str(DATA)).collect())) and narrow
    X0.forget_stages()
