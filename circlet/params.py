"""Engine parameters. Defaults are the fixed values users of the method expect."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # coordinate space
    length: int = 16569
    species: str = "human"
    contig_names: tuple[str, ...] = ("MT", "chrM", "MTDNA")
    rotations: dict[str, int] | None = None
    # segment and pair filters
    min_anchor_length: int = 20
    min_deletion_size: int = 100
    max_deletion_size: int = 16000
    min_mapq: int = 0
    include_secondary: bool = True
    include_supplementary: bool = True
    min_segment_aligned_fraction: float = 0.15
    max_soft_clip_fraction: float = 0.9
    max_query_overlap: int = 10
    max_query_gap: int = 20
    arc_assignment: str = "alignment_directed"  # or legacy_shortest_arc
    pairing_mode: str = "all_compatible"  # or adjacent
    ambiguous_direction_policy: str = "exclude"  # or include
    # clustering and local support
    slop: int = 10
    min_support: int = 2
    reference_window: int = 20
    # read selection
    selection_min_mapq: int = 20
    include_low_mapq: bool = True
    include_multimappers: bool = True
    include_supplementary_reads: bool = True
    include_secondary_reads: bool = True
    include_chimeric_reads: bool = True
    include_mates: bool = False
    competitive_min_mapq: int = 0
    competitive_min_aligned_fraction: float = 0.5
    competitive_ambiguous_mapq_below: int = 10
    competitive_nuclear_aligned_fraction: float = 0.5
    keep_ambiguous: bool = True
    depletion_min_mapq: int = 20
    depletion_min_aligned_fraction: float = 0.8
    # junction-file caller
    junction_min_anchor: int = 12
    junction_max_query_overlap: int = 20
    junction_max_query_gap: int = 20
    require_same_orientation: bool = True
    require_gene_anchors: bool = True
    exclude_same_gene: bool = True
    # evidence tiers
    exclude_expected_transcripts: bool = True
    minimum_supported: int = 2
    minimum_strong: int = 2
    primary_profile: str = "standard"
    profiles: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "stringent": ("strong",),
            "standard": ("strong", "supported"),
            "exploratory": ("strong", "supported", "review"),
        }
    )
    # statistics and view tables
    denominator: str = "total_usable_reads"  # or mt_evidence_reads
    log2_pseudocount: float = 0.5
    view_min_support: float = 0.0
    view_max_per_group: int = 0
    density_bin: int = 50
    density_smooth_bins: int = 7
    table_min_reads: int = 0
    table_always_targets: bool = True
    table_max_rows: int = 0  # export rule of the display table; 0 shows every row

    def __post_init__(self) -> None:
        if self.length <= 0:
            raise ValueError("length must be positive")
        if self.arc_assignment not in ("alignment_directed", "legacy_shortest_arc"):
            raise ValueError(f"unknown arc_assignment {self.arc_assignment!r}")
        if self.pairing_mode not in ("all_compatible", "adjacent"):
            raise ValueError(f"unknown pairing_mode {self.pairing_mode!r}")
        if self.ambiguous_direction_policy not in ("exclude", "include"):
            raise ValueError(f"unknown ambiguous_direction_policy {self.ambiguous_direction_policy!r}")

    @property
    def rotation_starts(self) -> dict[str, int]:
        return self.rotations or {"normal": 1, "half": self.length // 2 + 1}
