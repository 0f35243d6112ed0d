"""The jobs' transformations, as DataFrame in / DataFrame out functions."""

from .enrich import ENRICHED_COLUMNS, enrich_subscribers
from .joins import (fits_broadcast, fits_broadcast_many, hot_keys, lookup_join,
                    row_count, row_counts, salted_left_join)
from .profile import PROFILE_COLUMNS, build_profile
from .usage import MEASURES, OUTPUT_MEASURES, aggregate_usage

__all__ = [
    "ENRICHED_COLUMNS", "MEASURES", "OUTPUT_MEASURES", "PROFILE_COLUMNS",
    "aggregate_usage", "build_profile", "enrich_subscribers", "fits_broadcast",
    "fits_broadcast_many", "hot_keys", "lookup_join", "row_count", "row_counts",
    "salted_left_join",
]
