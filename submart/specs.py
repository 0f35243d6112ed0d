"""Run parameters and source / target descriptions.

The three jobs describe every source with the same handful of settings: how
the table keeps history (its SCD kind), where it lives, which columns key a
version and stamp its time, and an optional trailing window.  Here those
settings are frozen dataclasses, validated when they are built, so a bad
configuration fails before any Spark job starts.
"""

from __future__ import annotations

import datetime as dt
import enum
from dataclasses import dataclass


class ScdKind(str, enum.Enum):
    """How a source table keeps history."""

    #: only current rows; optionally read a trailing window of days
    CURRENT_SCD1 = "CURRENT_SCD1"
    #: an *active* table with current rows and a *hist* table with every
    #: version, each stamped with its insert time
    DELTA_SCD4 = "DELTA_SCD4"
    #: one full copy per date, told apart by a date column
    SNAPSHOT = "SNAPSHOT"

    @classmethod
    def parse(cls, value: "ScdKind | str") -> "ScdKind":
        if isinstance(value, ScdKind):
            return value
        try:
            return cls(str(value).upper())
        except ValueError:
            raise ValueError(f"unknown SCD kind {value!r}; expected one of "
                             f"{[k.value for k in cls]}") from None


def _tuple(value) -> tuple[str, ...]:
    if value is None:
        return ()
    if isinstance(value, str):
        # the jobs write compound keys as "a,b"
        return tuple(v.strip() for v in value.split(",") if v.strip())
    return tuple(value)


@dataclass(frozen=True)
class SourceSpec:
    """One source of a job.

    ``location`` (SCD1 / SNAPSHOT), ``active`` and ``hist`` (SCD4) are either a
    catalog table name (``db.table``) or a path; paths are read with
    ``format``.
    """

    name: str
    kind: ScdKind
    location: str | None = None
    active: str | None = None
    hist: str | None = None
    keys: tuple[str, ...] = ()
    ts_column: str | None = None
    window_days: int | None = None
    #: also drop rows after the run date (the jobs keep them: restating an
    #: old date rewrites every day since)
    window_until_run_date: bool = False
    snapshot_column: str | None = None
    drop_duplicates: bool = False
    columns: tuple[str, ...] | None = None
    tie_break: tuple[str, ...] | None = None
    #: rank hot keys of a history table in pieces (see ``scd4_asof``);
    #: ``None`` decides by the table's size
    skew_safe: bool | None = None
    #: storage partition column that holds ``to_date(ts_column)``; when set,
    #: the trailing window is also applied to it so whole directories prune
    partition_column: str | None = None
    #: register the result under this temp view name (the jobs do, by ``name``)
    view_name: str | None = None
    format: str = "parquet"

    def __post_init__(self):
        object.__setattr__(self, "kind", ScdKind.parse(self.kind))
        object.__setattr__(self, "keys", _tuple(self.keys))
        if self.columns is not None:
            object.__setattr__(self, "columns", _tuple(self.columns))
        if self.tie_break is not None:
            object.__setattr__(self, "tie_break", _tuple(self.tie_break))
        if self.window_days is not None:
            days = int(self.window_days)
            if days < 0:
                raise ValueError(f"{self.name}: window_days must be >= 0")
            object.__setattr__(self, "window_days", days)
        if self.kind is ScdKind.CURRENT_SCD1:
            if not self.location:
                raise ValueError(f"{self.name}: CURRENT_SCD1 needs a location")
            if self.window_days is not None and not self.ts_column:
                raise ValueError(f"{self.name}: a window needs ts_column")
        elif self.kind is ScdKind.DELTA_SCD4:
            if not (self.active and self.hist):
                raise ValueError(f"{self.name}: DELTA_SCD4 needs active and hist")
            if not self.keys or not self.ts_column:
                raise ValueError(f"{self.name}: DELTA_SCD4 needs keys and ts_column")
        elif self.kind is ScdKind.SNAPSHOT:
            if not (self.location and self.snapshot_column):
                raise ValueError(f"{self.name}: SNAPSHOT needs location and snapshot_column")


@dataclass(frozen=True)
class TargetSpec:
    """A partitioned target table.

    ``columns`` is the target's column order with the partition columns
    last; results are matched to it **by position**, as an
    ``INSERT OVERWRITE ... PARTITION`` does.
    """

    name: str
    location: str
    partition_columns: tuple[str, ...]
    columns: tuple[str, ...] | None = None
    keys: tuple[str, ...] = ()
    format: str = "parquet"
    #: files written per partition value: rows of one value are spread over
    #: this many writer tasks by a hash of ``keys`` (or of the whole row).
    #: ``None`` writes as the result is partitioned, right for a result with
    #: a single partition value (one file per task, no extra shuffle)
    files_per_partition: int | None = None
    #: let AQE size the files instead: ``REBALANCE`` by the partition
    #: columns, which splits a large partition value over several tasks and
    #: merges small ones (needs ``spark.sql.adaptive.enabled``; takes
    #: precedence over ``files_per_partition`` when AQE is on)
    rebalance: bool = False
    max_records_per_file: int | None = None
    #: catalog targets only: store the table in this many buckets of ``keys``,
    #: so that reads joined or grouped by them need no shuffle
    buckets: int | None = None
    #: path targets only: the catalog table over the path (``db.table``), made
    #: if missing, whose written partitions are registered after each write
    catalog_table: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "partition_columns", _tuple(self.partition_columns))
        object.__setattr__(self, "keys", _tuple(self.keys))
        if self.columns is not None:
            cols = _tuple(self.columns)
            object.__setattr__(self, "columns", cols)
            n = len(self.partition_columns)
            if n and tuple(cols[-n:]) != self.partition_columns:
                raise ValueError(f"{self.name}: partition columns must come last")
        if not self.partition_columns:
            raise ValueError(f"{self.name}: a partitioned target needs partition columns")
        if self.files_per_partition is not None and int(self.files_per_partition) < 1:
            raise ValueError(f"{self.name}: files_per_partition must be >= 1")
        if self.buckets is not None and (int(self.buckets) < 1 or not self.keys or self.is_path):
            raise ValueError(f"{self.name}: buckets need a number of at least 1, keys and a catalog table")
        if self.catalog_table and not self.is_path:
            raise ValueError(f"{self.name}: catalog_table is for targets that are paths")

    @property
    def is_path(self) -> bool:
        return "/" in self.location or ":" in self.location


@dataclass(frozen=True)
class RunContext:
    """The run date and the date that decides active versus history reads.

    ``current_date`` is injected rather than read inside a transform, so a
    run is reproducible and tests are deterministic.
    """

    run_date: dt.date
    current_date: dt.date

    @property
    def reads_active(self) -> bool:
        return self.run_date == self.current_date

    @property
    def iso(self) -> str:
        return self.run_date.isoformat()
