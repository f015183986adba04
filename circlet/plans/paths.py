"""The two end-to-end plans: remap calls to clusters, and evidence of two callers to tiers.

Tables that several later steps read are written once to the shared folder, as the stages of a job
would be.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circlet.durable import materialize
from circlet.operators import calling as D
from circlet.operators import clusters as K
from circlet.operators import conflicts as X
from circlet.operators import evidence as Q
from circlet.operators import tiers as T
from circlet.params import Params


@dataclass
class RemapResult:
    events: DataFrame
    ambiguous: DataFrame
    assigned: DataFrame
    clusters: DataFrame
    members: DataFrame


def remap_path(segments: DataFrame, p: Params) -> RemapResult:
    """Segments -> events -> conflicts -> clusters and their member rows."""
    events = materialize(D.call_events(segments, p), "events")
    accepted, ambiguous = X.split_conflicts(events, p.slop, p.length)
    rows = accepted.unionByName(ambiguous) if p.ambiguous_direction_policy == "include" else accepted
    assigned = K.assign_clusters(rows, p.slop, p.length)
    clusters = K.cluster_table(assigned, p.slop, p.length, p.min_support)
    return RemapResult(events, ambiguous, assigned, clusters, K.member_rows(assigned, clusters))


@dataclass
class EvidenceResult:
    candidates: DataFrame
    ambiguous: DataFrame
    observations: DataFrame
    clusters: DataFrame
    graded: DataFrame
    enriched: DataFrame


def evidence_path(candidates: DataFrame, p: Params, annotate: Callable[[DataFrame], DataFrame] = lambda c: c, stored: bool = False) -> EvidenceResult:
    """Caller rows -> observations -> clusters (support 1) -> annotation -> tiers. ``stored``: the rows were written already."""
    candidates = candidates if stored else materialize(candidates, "candidates")
    found, ambiguous = Q.consolidate(candidates, p)
    found = materialize(found, "observations")
    assigned = K.assign_clusters(found, p.slop, p.length, Q.OBSERVATION_ORDER)
    # a cluster lists the rotation sets of its observations, each as one text
    named = assigned.withColumn("rotation_name", F.nullif(F.array_join("rotation_support", ";"), F.lit("")))
    clusters = K.cluster_table(named, p.slop, p.length, 1, Q.OBSERVATION_ORDER)
    members = K.member_rows(assigned, clusters, Q.OBSERVATION_ORDER)
    graded = T.grade(annotate(clusters), members, p)
    return EvidenceResult(candidates, ambiguous, members, clusters, graded, T.enrich_observations(members, graded))
