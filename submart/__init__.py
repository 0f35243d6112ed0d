"""submart: a subscriber mart built from slowly changing dimension tables.

Read sources as of a run date, roll usage up per subscriber and day, enrich
subscribers with lookups, join everything into a dated profile and write it
with idempotent partition overwrite, all as Spark DataFrame transformations.
"""

from .specs import RunContext, ScdKind, SourceSpec, TargetSpec

__all__ = ["RunContext", "ScdKind", "SourceSpec", "TargetSpec"]
