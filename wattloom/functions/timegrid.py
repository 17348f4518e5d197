"""The 15-minute grid: slots, interval ids (``dti``), seasons and day types.

All functions take and return columns, so they stay inside whole-stage codegen. Timestamps
are ``TIMESTAMP_NTZ``: meter time has no zone, and no daylight-saving shift can move a slot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattloom.settings import DEFAULTS, SLOT_MINUTES, SLOTS_PER_DAY, SLOTS_PER_HOUR


def slot_timestamp(day: Column, idx: Column) -> Column:
    """Start of slot ``idx`` (1..96) of ``day``."""
    return F.timestamp_add("MINUTE", (idx - 1) * SLOT_MINUTES, day.cast("timestamp_ntz"))


def slot_dti(day: Column, idx: Column, epoch: dt.date = DEFAULTS.epoch) -> Column:
    """Interval id of slot ``idx`` of ``day``: 1 for the first slot of the epoch date."""
    days = F.date_diff(day.cast("date"), F.lit(epoch)).cast("long")
    return days * SLOTS_PER_DAY + idx


def dti_of(ts: Column, epoch: dt.date = DEFAULTS.epoch) -> Column:
    """Interval id of a timestamp."""
    idx = F.hour(ts) * SLOTS_PER_HOUR + F.floor(F.minute(ts) / SLOT_MINUTES) + 1
    return slot_dti(ts, idx, epoch)


def timestamp_of(dti: Column, epoch: dt.date = DEFAULTS.epoch) -> Column:
    """Timestamp at which interval ``dti`` starts."""
    start = F.lit(epoch).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", (dti - 1) * SLOT_MINUTES, start)


def bucket(dti: Column) -> Column:
    """Slot of the day as ``dti`` modulo 96; the last slot (23:45) is bucket 0."""
    return F.pmod(dti, F.lit(SLOTS_PER_DAY).cast("long"))


def hour_index(dti: Column) -> Column:
    """Hour of the day, 0..23."""
    return F.floor(F.pmod(dti - 1, F.lit(SLOTS_PER_DAY).cast("long")) / SLOTS_PER_HOUR)


def is_hour_start(dti: Column) -> Column:
    """True for the first slot of every hour."""
    return F.pmod(dti, F.lit(SLOTS_PER_HOUR).cast("long")) == 1


def season(ts: Column) -> Column:
    """1 March-May, 2 June-September, 3 October-November, 4 December-February."""
    # Season of the months January to December.
    months = F.array(*[F.lit(n) for n in (4, 4, 1, 1, 1, 2, 2, 2, 2, 3, 3, 4)])
    return F.get(months, F.month(ts) - 1)


def daytype(ts: Column) -> Column:
    """1 Monday-Friday, 2 Saturday and Sunday."""
    # Monday to Sunday.
    days = F.array(*[F.lit(n) for n in (1, 1, 1, 1, 1, 2, 2)])
    return F.get(days, F.weekday(ts))


def sdti(ts: Column) -> Column:
    """Season and day type in one index; every third value is kept free for holidays."""
    return (season(ts) - 1) * 3 + daytype(ts)
