"""Coverage analytics on Spark: report days, week grids, shares, text rules, deduplication and counters."""
