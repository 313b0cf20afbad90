"""Scalar column functions (all JVM built-ins, no Python UDFs)."""

from custlens.functions.calendar import (calendar_parts, day_of_year, hour, iso_week,
                                         weekday_mon0, whole_days_between)
from custlens.functions.numeric import log_bucket, money_sum, nan_to_null, recode, row_sum

__all__ = ["calendar_parts", "day_of_year", "hour", "iso_week", "weekday_mon0",
           "whole_days_between", "log_bucket", "money_sum", "nan_to_null",
           "recode", "row_sum"]
