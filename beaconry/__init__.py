"""Telemetry analytics on Spark: operators over errors, logs, spans, requests, statements and sessions."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Executors need no copy of this package: what little Python runs there travels with its task.
register_pickle_by_value(sys.modules[__name__])
