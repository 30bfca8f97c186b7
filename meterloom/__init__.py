"""Time-series preparation, statistics and forecasting as Spark jobs.

Every table is keyed by ``(series_id, ts)``.  No operator relies on row order
that is not stated, and none gathers a whole series in one task: ordered work
runs over bounded time chunks that exchange small carry-over rows.
"""

from meterloom.session import configure, get_session

__all__ = ["configure", "get_session"]
