"""Sampling by a stable hash, so that a retried task or a replayed stream keeps the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions.trace_context import sampling_unit


def _clamped(rate: float) -> float:
    return min(1.0, max(0.0, float(rate)))


def sample_errors(df: DataFrame, rate: float, key: Column) -> DataFrame:
    """Keep an error iff its hash falls below the rate; a rate of 1 keeps everything, also rows without a key."""
    rate = _clamped(rate)
    return df if rate >= 1.0 else df.where(sampling_unit(key) < rate)


def sample_traces(df: DataFrame, rate: float | None, trace_id: str = "trace_id",
                  inbound_sampled: Column | None = None) -> DataFrame:
    """Keep whole traces: an inbound flag decides where there is one, else the hash of the trace id.

    Without a rate tracing is always on, whatever the inbound flag says.
    """
    if rate is None:
        return df
    decided = sampling_unit(F.col(trace_id)) < _clamped(rate)
    return df.where(decided if inbound_sampled is None else F.coalesce(inbound_sampled, decided))
