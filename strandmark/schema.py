"""Parameters and the call table's columns."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace


@dataclass(frozen=True)
class Params:
    """Thresholds of both analyses. ``keep_multimappers`` sets the three MAPQ minima to zero."""

    sample: str = "sample"
    analysis: str = "ndigenome"
    control_sample: str = ""
    ndigenome_min_count: int = 10
    ndigenome_min_fraction: float = 0.20
    ndigenome_min_mapq: int = 1
    ndigenome_opposite_window: int = 5
    ndigenome_ambiguous_min_count: int = 3
    ndigenome_ambiguous_min_fraction: float = 0.05
    digenome_overhang: int = 0
    digenome_pair_window: int = 2
    digenome_min_mapq: int = 1
    digenome_forward_cutoff: int = 5
    digenome_reverse_cutoff: int = 5
    digenome_depth_cutoff: int = 10
    digenome_fraction_cutoff: float = 0.20
    digenome_pair_score_cutoff: float = 2.5
    artifact_window: int = 10
    max_softclip_fraction: float = 0.20
    max_indel_fraction: float = 0.20
    min_support_mean_mapq: float = 10.0
    control_min_depth: int = 1
    control_max_fraction: float = 0.05
    control_min_fold: float = 5.0
    control_max_q: float = 0.05
    keep_multimappers: bool = False

    def __post_init__(self) -> None:
        if self.analysis not in ("digenome", "ndigenome"):
            raise ValueError(f"unknown analysis {self.analysis!r}")
        for name, value in asdict(self).items():
            if isinstance(value, (int, float)) and name != "digenome_overhang" and value < 0:
                raise ValueError(f"{name} must not be negative")
            if ("fraction" in name or name.endswith("max_q")) and not 0 <= value <= 1:
                raise ValueError(f"{name} must lie between 0 and 1")
        if self.keep_multimappers:
            for name in ("ndigenome_min_mapq", "digenome_min_mapq", "min_support_mean_mapq"):
                object.__setattr__(self, name, 0)

    @property
    def min_mapq(self) -> int:
        return self.ndigenome_min_mapq if self.analysis == "ndigenome" else self.digenome_min_mapq

    @property
    def padding(self) -> int:
        """How far evidence for a call can lie from it."""
        return max(self.artifact_window, self.ndigenome_opposite_window, abs(self.digenome_overhang) + 3 * self.digenome_pair_window)

    def but(self, **changes) -> "Params":
        return replace(self, **changes)


READ_SCHEMA = "read_ord long, query_name string, flag int, contig string, reference_start long, reference_end long, mapping_quality int, cigar string, nm int"
METRICS = [
    "endpoint_count", "strand_depth", "endpoint_fraction", "support_mean_mapq", "support_read_count", "local_mean_mapq", "local_read_count", "support_mean_nm", "support_nm_count", "local_mean_nm",
    "local_nm_count", "softclip_fraction", "softclipped_count", "secondary_endpoint_count", "indel_position", "indel_type", "indel_length", "indel_read_count", "indel_fraction",
]

# The call table's columns, in the order of the written tables.
CALL_COLUMNS = (
    "sample analysis control_sample control_status contig position_0based position_1based strand forward_position_0based forward_position_1based reverse_position_0based reverse_position_1based "
    "endpoint_count strand_depth endpoint_fraction opposite_position_0based opposite_position_1based opposite_count opposite_depth opposite_fraction forward_endpoint_count forward_depth forward_fraction "
    "reverse_endpoint_count reverse_depth reverse_fraction digenome_pair_score rgen_digenome_score signal_classification classification filter_status filter_reasons support_mean_mapq local_mean_mapq "
    "support_mean_nm local_mean_nm softclip_fraction secondary_endpoint_count indel_position_0based indel_position_1based indel_type indel_length indel_read_count indel_fraction known_indel_overlap "
    "control_endpoint_count control_depth control_fraction control_forward_endpoint_count control_forward_depth control_forward_fraction control_reverse_endpoint_count control_reverse_depth "
    "control_reverse_fraction control_digenome_pair_score control_rgen_digenome_score control_fold_enrichment control_fisher_p control_fisher_q"
).split()
#: Written with eight significant digits.
FLOAT_COLUMNS = [c for c in CALL_COLUMNS if "fraction" in c or "score" in c or "mean" in c or c in ("control_fold_enrichment", "control_fisher_p", "control_fisher_q")]
