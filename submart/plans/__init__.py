"""Job plans: the three run-date pipelines and the driver-table mapping."""

from .pipelines import (JOBS, Layout, enrichment_result, enrichment_specs,
                        parse_context, profile_result, profile_specs, run_all,
                        run_subs_enriched, run_subs_profile, run_usage_daily,
                        usage_result, usage_specs)

__all__ = [
    "JOBS", "Layout", "enrichment_result", "enrichment_specs", "parse_context",
    "profile_result", "profile_specs", "run_all", "run_subs_enriched",
    "run_subs_profile", "run_usage_daily", "usage_result", "usage_specs",
]
