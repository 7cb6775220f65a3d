"""Parameters of the two pipelines, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class GridParams:
    """How word boxes become a grid.

    row_tolerance: vertical tolerance of a row as a share of the typical height.  block_gap: gap between blocks
    as a multiple of the typical step.  support: share of rows that must have a gutter.  max_cols: columns of a
    block at most.  column_cuts: manual boundaries as shares of the page width; they replace the found ones.
    review_conf: a cell with a word below it is flagged.  overlays, workbooks: whether a run
    draws on prepared page images and writes its tables as workbooks, too.
    """

    row_tolerance: float = 0.45
    block_gap: float = 3.0
    support: float = 0.30
    max_cols: int = 20
    column_cuts: tuple[float, ...] = ()
    review_conf: float = 40.0
    overwrite: bool = False
    overlays: bool = False
    workbooks: bool = False

    def __post_init__(self) -> None:
        if not 0 < self.support <= 1 or not 1 <= self.max_cols <= 64 or self.row_tolerance <= 0 or self.block_gap <= 0:
            raise ValueError("a parameter is out of range")
        cuts = tuple(sorted(set(self.column_cuts)))
        if len(cuts) > 63 or any(not 0 < c < 1 for c in cuts):
            raise ValueError("column cuts lie between 0 and 1, 63 at most")
        object.__setattr__(self, "column_cuts", cuts)

    @staticmethod
    def cuts_of(text: str) -> tuple[float, ...]:
        """Shares from a comma-separated list; blank parts are skipped."""
        return tuple(float(x) for x in text.split(",") if x.strip())


@dataclass(frozen=True)
class RegistryParams:
    """The work-list's delimiter, the day written to new records (dd.MM.yyyy; None: today), and the address rule.

    strict_units: a unit word counts in an address only at a word boundary; off by default, as the plain rule is.  portion: documents that are
    stored together.
    """

    sep: str = ";"
    loaded_on: str | None = None
    strict_units: bool = False
    portion: int = 100_000

    def __post_init__(self) -> None:
        if len(self.sep) != 1:
            raise ValueError("the delimiter is one character")
        if self.portion < 1:
            raise ValueError("a portion is a document at least")
