"""Ordered bands over a numeric column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Labels between ascending edges.

    ``edges[i]`` is the upper end of ``labels[i]``; one label more than edges
    means the last band is open.  ``closed="left"`` puts a value that equals
    an edge into the band above it, ``"right"`` into the band below it.
    Values under ``floor`` (at it, when right-closed) and above the last edge
    of a closed list get no band.
    """

    labels: Sequence[str]
    edges: Sequence[int]
    closed: str = "left"
    floor: int | None = None

    def __post_init__(self) -> None:
        if self.closed not in ("left", "right"):
            raise ValueError(f"closed must be 'left' or 'right', not {self.closed!r}")
        if len(self.labels) - len(self.edges) not in (0, 1):
            raise ValueError("need as many labels as edges, or one more")
        if list(self.edges) != sorted(set(self.edges)):
            raise ValueError("edges must ascend")

    def right_closed(self) -> "Bands":
        return Bands(self.labels, self.edges, "right", self.floor)


def bucketize(value: Column, bands: Bands) -> Column:
    """Band label of ``value``; null stays null."""
    right = bands.closed == "right"
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    if bands.floor is not None:
        chain = chain.when(value <= bands.floor if right else value < bands.floor, F.lit(None).cast("string"))
    for label, edge in zip(bands.labels, bands.edges):
        chain = chain.when(value <= edge if right else value < edge, F.lit(label))
    return chain.otherwise(F.lit(bands.labels[-1])) if len(bands.labels) > len(bands.edges) else chain


def label_rank(label: Column, labels: Sequence[str]) -> Column:
    """Position of a label in its display order, for sorting; unknown labels sort last."""
    chain = F.when(label == labels[0], F.lit(0))
    for position, name in enumerate(labels[1:], start=1):
        chain = chain.when(label == name, F.lit(position))
    return chain.otherwise(F.lit(len(labels)))


# ---- fixed values ----------------------------------------------------------
AGE_BANDS = Bands(
    labels=("18-25", "26-35", "36-50", "51-65", "65+"),
    edges=(26, 36, 51, 66),
)
BALANCE_TIERS = Bands(
    labels=("Negative", "Under $1K", "$1K-$10K", "$10K-$50K", "$50K-$100K", "Over $100K"),
    edges=(0, 1_000, 10_000, 50_000, 100_000),
)
CREDIT_SCORE_BANDS = Bands(
    labels=("Poor (<580)", "Fair (580-669)", "Good (670-739)", "Very Good (740-799)", "Excellent (800+)"),
    edges=(579, 669, 739, 799, 900),
    closed="right",
    floor=0,
)
DELINQUENCY_BUCKETS = Bands(
    labels=("Current", "1-30 DPD", "31-60 DPD", "61-90 DPD", "91-180 DPD", "180+ DPD"),
    edges=(0, 30, 60, 90, 180),
    closed="right",
    floor=-1,
)
INACTIVITY_BANDS = Bands(
    labels=("0-30 days", "31-60 days", "61-90 days", "Over 90 days"),
    edges=(30, 60, 90),
    closed="right",
)
RISK_RATINGS = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC")
