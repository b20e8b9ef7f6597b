"""Column -> Column rules: calendar, financial calendar, as-of, time of day."""

from caldim.functions import asof, calendar, fiscal, timeofday

__all__ = ["asof", "calendar", "fiscal", "timeofday"]
