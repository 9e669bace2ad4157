"""Column functions."""

from tidemark.functions.times import event_time, minutes_before, parse_time, seconds_between

__all__ = ["event_time", "minutes_before", "parse_time", "seconds_between"]
