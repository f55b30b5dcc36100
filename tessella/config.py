"""Column roles and model settings of one segmentation run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class SegmentationConfig:
    """Which columns play which part, and how the clusterers are set up.

    ``numeric`` and ``categorical`` columns are features. ``flags`` names those numbers that
    are 0 or 1: their means are shares. ``described`` numbers are averaged per segment and
    ``carried`` columns only stay in the labelled table. ``outcome`` is never a feature: it
    is only averaged per finished segment, and may be None.
    """

    id_col: str = "customer_id"
    # The feature order the published results are based on.
    numeric: tuple[str, ...] = (
        "credit_score",
        "age",
        "tenure",
        "balance",
        "products_number",
        "credit_card",
        "active_member",
        "estimated_salary",
    )
    categorical: tuple[str, ...] = ("country", "gender")
    flags: tuple[str, ...] = ("credit_card", "active_member")
    described: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()
    outcome: str | None = "churn"

    # Sweep range, seed and iteration limit of the published run.
    min_k: int = 2
    max_k: int = 10
    seed: int = 42
    max_iter: int = 100

    # What to do with a NULL or NaN in a numeric feature: "error" or "skip".
    invalid: str = "error"
    # Size of one partition of the fitted table. It depends on the data alone,
    # so that a fit does not change with the cluster it runs on.
    rows_per_partition: int = 100_000
    # Models of a sweep fitted at once; each holds a copy of the vectors in memory.
    parallelism: int = 3

    @property
    def index_cols(self) -> tuple[str, ...]:
        return tuple(f"{c}_index" for c in self.categorical)

    @property
    def feature_cols(self) -> tuple[str, ...]:
        return self.numeric + self.index_cols

    @property
    def columns(self) -> tuple[str, ...]:
        """Every column with a part, once."""
        outcome = (self.outcome,) if self.outcome else ()
        parts = (self.id_col,) + self.numeric + self.categorical + self.described + self.carried + outcome
        return tuple(dict.fromkeys(parts))

    def columns_of(self, df_columns: Sequence[str]) -> list[str]:
        """The columns with a part in the order of a table, which must have them all."""
        absent = [c for c in self.columns if c not in df_columns]
        if absent:
            raise ValueError(f"the table has no columns {absent}")
        return [c for c in df_columns if c in self.columns]

    @property
    def ks(self) -> range:
        return range(self.min_k, self.max_k + 1)
