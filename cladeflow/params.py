"""Per-domain parameters: median RED per rank, and the ranks themselves."""

from __future__ import annotations

from dataclasses import dataclass

RANKS = ("phylum", "class", "order", "family", "genus", "species")
GENUS = RANKS.index("genus")
SPECIES = RANKS.index("species")
NAMED_RANKS = RANKS[:SPECIES]  # species names never attach to a tree node
RANK_LETTERS = tuple(rank[0] for rank in RANKS)

# Median RED of phylum, class, order, family and genus by taxonomy release.
MEDIAN_RED = {
    ("d__Bacteria", "r220"): (
        0.3280941769231098,
        0.449727838796469,
        0.6083500718998613,
        0.7576141066814935,
        0.9220350796053899,
    ),
    ("d__Archaea", "r220"): (
        0.2128708845277663,
        0.35878546884559126,
        0.5316295929627715,
        0.7250725361353227,
        0.9069458981600348,
    ),
    ("d__Bacteria", "r232"): (
        0.3399759686386926,
        0.4764466993167481,
        0.6467334973890564,
        0.7972969419385083,
        0.9438360803986985,
    ),
    ("d__Archaea", "r232"): (
        0.2859284763413424,
        0.42852344844350987,
        0.5692329378979698,
        0.758762614031466,
        0.9250910192387802,
    ),
}


@dataclass(frozen=True)
class DomainParams:
    """One domain's literal name and its five median RED values, phylum to genus."""

    domain: str
    median_red: tuple[float, ...]

    def __post_init__(self) -> None:
        if len(self.median_red) != len(NAMED_RANKS):
            raise ValueError(f"expected {len(NAMED_RANKS)} median RED values, got {self.median_red}")

    @property
    def medians(self) -> tuple[float, ...]:
        """Median RED of all six ranks; species sits at the tips, RED 1."""
        return (*self.median_red, 1.0)

    @property
    def upper_edges(self) -> tuple[float, ...]:
        """Upper RED edge of each rank's bin: midpoint to the next rank's median, 1 for species."""
        medians = self.medians
        return (*((low + high) / 2 for low, high in zip(medians, medians[1:])), 1.0)


def preset(domain: str, release: str = "r220", red_cutoffs: tuple[float, ...] | None = None) -> DomainParams:
    """Parameters of a domain; the cutoffs follow the domain unless they are given."""
    if red_cutoffs:
        return DomainParams(domain, tuple(float(red) for red in red_cutoffs))
    return DomainParams(domain, MEDIAN_RED[domain, release])


def as_domains(params: DomainParams | list[DomainParams] | tuple[DomainParams, ...]) -> tuple[DomainParams, ...]:
    return (params,) if isinstance(params, DomainParams) else tuple(params)
