"""Registered jobs: operators over telemetry projected from the given tables, each with its check in plain SQL."""

from beaconry.plans import (  # noqa: F401
    column_jobs, context_jobs, delivery_jobs, instrument_jobs, normalize_jobs, report_jobs, scrub_jobs, session_jobs,
    source_jobs, stream_jobs,
)
from beaconry.plans.registry import ORACLES, QUERIES  # noqa: F401
