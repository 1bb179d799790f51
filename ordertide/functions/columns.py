"""Column expressions shared by the operators.

Days, hours and clock times are those of UTC, computed from epoch microseconds, whatever the
session's time zone.
"""

from pyspark.sql import functions as F

from ordertide.constants import BUCKET_MINUTES, DINNER_WINDOW, LUNCH_WINDOW, TRUE_WORDS

_MINUTE_US = 60_000_000
_DAY_US = 86_400_000_000


def event_is(*types):
    """Predicate: the event type is one of ``types``."""
    column = F.col("event_type")
    return column == types[0] if len(types) == 1 else column.isin(*types)


def count_if(condition):
    return F.count(F.when(condition, 1))


def count_orders(*types):
    """Number of events of the given types that carry an order id."""
    return F.count(F.when(event_is(*types), F.col("order_id")))


def any_of(condition):
    """1 when any row of the group meets the condition, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def time_bucket(ts, minutes=BUCKET_MINUTES):
    """Start of the N-minute bucket of a timestamp; null stays null."""
    micros = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(minutes * _MINUTE_US)))


def positive(column):
    """The value as a number when above zero, else null (text and NaN give null)."""
    value = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    return F.when((value > 0) & ~F.isnan(value), value)


def minutes_between(start, end):
    """Minutes from start to end, with fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(6e7)


def to_time(column):
    """Text or timestamp to a UTC timestamp, null when it cannot be read."""
    return F.col(column).try_cast("timestamp")


def flag(column):
    """Text flag to boolean; anything but the known true words is false."""
    text = F.lower(F.trim(F.col(column).cast("string")))
    return F.coalesce(text.isin(*TRUE_WORDS), F.lit(False))


def zone_label(zone, name):
    """``Z05 – name``; the id stands in for a missing name."""
    return F.concat(F.col(zone), F.lit(" – "), F.coalesce(F.col(name), F.col(zone)))


def at_least(column, floor):
    """Clip from below; null stays null."""
    return F.when(column.isNotNull(), F.greatest(column, F.lit(floor)))


def or_zero(column):
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0))


def present(column, digits):
    """Half-even rounding for display."""
    return F.bround(column, digits)


def micros_of_day(ts):
    return F.pmod(F.unix_micros(ts), F.lit(_DAY_US))


def minute_of_day(ts):
    return F.floor(micros_of_day(ts) / _MINUTE_US).cast("int")


def hour_of_day(ts):
    return F.floor(micros_of_day(ts) / (60 * _MINUTE_US)).cast("int")


def day_start(ts):
    """Midnight before a time."""
    return F.timestamp_micros(F.unix_micros(ts) - micros_of_day(ts))


def day_of(ts):
    """The date of a time."""
    return F.date_from_unix_date(((F.unix_micros(ts) - micros_of_day(ts)) / _DAY_US).cast("int"))


def weekday_of(ts):
    """Day of the week, Monday 0."""
    return F.weekday(day_of(ts))


def clock_text(ts, between=":"):
    """Hour and minute of a time as text."""
    two = [F.lpad(n.cast("string"), 2, "0") for n in (hour_of_day(ts), minute_of_day(ts) % 60)]
    return F.concat(two[0], F.lit(between), two[1])


def _clock_us(text):
    hours, minutes = text.split(":")
    return (int(hours) * 60 + int(minutes)) * _MINUTE_US


def meal_period(ts):
    """``lunch``, ``dinner`` or null; both ends of a period belong to it."""
    clock = micros_of_day(ts)
    lunch = clock.between(_clock_us(LUNCH_WINDOW[0]), _clock_us(LUNCH_WINDOW[1]))
    dinner = clock.between(_clock_us(DINNER_WINDOW[0]), _clock_us(DINNER_WINDOW[1]))
    return F.when(lunch, "lunch").when(dinner, "dinner")


def is_weekend(ts):
    return weekday_of(ts) >= 5


def is_holiday(ts, holidays):
    """Whether month and day of ``ts`` are among (month, day) pairs of a calendar."""
    keys = [month * 100 + day for month, day in holidays]
    day = day_of(ts)
    return (F.month(day) * 100 + F.dayofmonth(day)).isin(*keys)


def epoch_ms(column):
    """Epoch milliseconds of a text or timestamp, 0 when it cannot be read."""
    return F.coalesce(F.unix_millis(to_time(column)), F.lit(0).cast("bigint"))


def rounded_int(column):
    """Whole number, ties to even; null when the value cannot be read."""
    return F.bround(F.col(column).try_cast("double"), 0).try_cast("int")
