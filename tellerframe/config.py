"""Business parameters, passed explicitly to every plan that needs them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class Rules:
    """One immutable set of parameters per run.

    ``as_of`` replaces "today": without a fixed day no result could be
    reproduced.  ``run_at`` is stamped on every row a run writes.
    """

    as_of: date
    run_at: str = "1970-01-01T00:00:00"
    environment: str = "dev"
    # fixed values
    fx_to_cad: Mapping[str, Decimal] = field(default_factory=lambda: {"USD": Decimal("1.36")})
    dormancy_days: int = 730
    large_amount: Decimal = Decimal("10000")
    amount_ceiling: int = 500_000
    freshness_days: int = 730
    halt_below_score: Decimal = Decimal("70")
    warn_below_score: Decimal = Decimal("85")
    version: str = "1.0.0"

    @property
    def masks_pii(self) -> bool:
        return self.environment != "prod"
