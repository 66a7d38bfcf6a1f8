"""SAS day numbers <-> timestamps, as native expressions.

A SAS date is a (possibly fractional) count of days since the SAS epoch.
Results are ``timestamp_ntz`` so they do not depend on any time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The SAS epoch and the microseconds in one day.
SAS_EPOCH = "1960-01-01 00:00:00"
MICROS_PER_DAY = 86_400_000_000
EPOCH_DAYS_BEFORE_1970 = 3_653


def _epoch() -> Column:
    return F.lit(SAS_EPOCH).cast("timestamp_ntz")


def sas_day_to_timestamp(day: Column | str) -> Column:
    """Day number -> timestamp_ntz, rounded to the microsecond.

    ``20574`` -> 2016-04-30 00:00, ``20574.5`` -> 2016-04-30 12:00. NULL (and
    values outside the timestamp range) give NULL instead of failing the job.
    """
    day = F.col(day) if isinstance(day, str) else day
    micros = F.round(day.cast("double") * F.lit(MICROS_PER_DAY)).try_cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def timestamp_to_sas_day(ts: Column | str) -> Column:
    """timestamp_ntz -> fractional day number since the SAS epoch (double).

    Built from the calendar fields: a difference of timestamps would pass
    through the session zone and shift local times that the zone skips.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.unix_date(ts.cast("date")).cast("bigint") + EPOCH_DAYS_BEFORE_1970
    seconds = days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (seconds * 1_000_000 + fraction).cast("double") / F.lit(float(MICROS_PER_DAY))
