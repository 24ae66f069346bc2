"""Structured Streaming jobs. Rates of intake are bounded by the source options (maxFilesPerTrigger and the like)."""
