"""Run parameters, passed explicitly to every operator that needs one."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime


@dataclass(frozen=True)
class Limits:
    """Up to where the plans for small inputs are taken; results never depend on them."""

    # A lookup with no more rows and bytes goes to every executor.
    broadcast_rows: int = 200_000
    broadcast_bytes: int = 64 << 20
    # Beyond that, so many of the heaviest keys do.
    heavy_keys: int = 1_000
    # Up to this many new entities are numbered by a window per id.
    window_rows: int = 1_000_000
    # Name blocks above this are cut into cells of this size.
    cell_rows: int = 4_096


@dataclass(frozen=True)
class MatchConfig:
    """Settings of one run; its date and time are always given.

    ``threshold``, ``ratio`` and ``min_len`` are part of the result of the fuzzy
    name match, not tuning knobs: the length rules drop pairs that would score
    above the threshold.
    """

    odate: date
    run_ts: datetime
    exception_ids: tuple[str, ...] = ()
    threshold: float = 0.781
    ratio: float = 0.72
    min_len: int = 4
    # Number names that match nothing (False leaves them at pointer 0).
    allocate_new_names: bool = True
    # Number a primary address whose first line is blank.
    number_blank_address: bool = True
    # Look special-id addresses up in the master before numbering them.
    reuse_special: bool = False
    # The id used for blocking and joining, and the id tested for "special".
    entity_id: str = "work_ein"
    special_id: str = "empr_ein"
    record_id: str = "input_order"
    # Master tables are published in so many buckets of their id; a root keeps the number it began with.
    master_buckets: int = 64
    limits: Limits = Limits()
