"""Incremental maintenance of per-day roll-ups over arriving day shards."""

from webevents.streaming.daily import daily_activity_by_day, refresh_days, start_daily_refresh

__all__ = ["daily_activity_by_day", "refresh_days", "start_daily_refresh"]
