"""Column roles of a dataset: what the audit, cleaning and features act on."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Declared roles of the columns of one table.

    ``required`` is the expected column list in order (defaults to key,
    numeric, categorical, target).  ``ranges`` are plausible value ranges,
    ``allowed`` the legal categories per column, ``allowed_targets`` the legal
    target classes.  ``key`` is the row key: Spark has no positional index, so
    a key column stands in for it wherever the reference used row positions.
    """

    key: str | None
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str | None
    excluded: tuple[str, ...] = ()
    required: tuple[str, ...] | None = None
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    iqr_exempt: tuple[str, ...] = ()
    allowed: dict[str, tuple] = field(default_factory=dict)
    allowed_targets: tuple = ()
    allow_extra: bool = False
    allow_missing: bool = False
    allow_all_null: bool = False
    imbalance_warning: float = 1.5

    @property
    def required_columns(self) -> tuple[str, ...]:
        if self.required is not None:
            return self.required
        cols: list[str] = []
        for c in (self.key, *self.numeric, *self.categorical, self.target):
            if c and c not in cols:
                cols.append(c)
        return tuple(cols)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)


# ---- roles of the fixture views (FIXTURES.md §2) ---------------------------
ORDERS_DIRTY = Roles(
    key="o_orderkey",
    numeric=("price_txt", "price"),
    categorical=("status",),
    target="priority",
    excluded=("o_orderkey",),
    required=("o_orderkey", "price_txt", "price", "status", "priority"),
    ranges={"price": (1.0, 600000.0)},
    allowed={"status": ("F", "O", "P")},
    allowed_targets=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
)

ML_ORDERS = Roles(
    key="row_id",
    numeric=("price", "balance"),
    categorical=("status", "segment"),
    target="tier",
    excluded=("row_id",),
    required=("row_id", "price", "balance", "status", "segment", "tier"),
)
