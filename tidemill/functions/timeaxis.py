"""Time arithmetic on long microseconds, and the trading calendar. Nothing here depends on the session's time zone."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINUTE, HOUR, DAY = 60_000_000, 3_600_000_000, 86_400_000_000
#: Hours that an exchange's clock is ahead of UTC; no daylight saving.
OFFSET_HOURS = {"CN": 8, "SH": 8, "SZ": 8}
#: Sessions of the day in minutes: [9:30, 11:30] and [13:00, 15:00].
MORNING, AFTERNOON = (570, 690), (780, 900)


def offset_us(exchange: str) -> int:
    if exchange not in OFFSET_HOURS:
        raise ValueError(f"unknown exchange {exchange!r}")
    return OFFSET_HOURS[exchange] * HOUR


def micros(ts: Column | str) -> Column:
    """Epoch microseconds of a timestamp without a time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts.cast("timestamp_ntz"))


def floor_div(a: Column, b: int) -> Column:
    """a div b, rounded down also for negative a."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def floor_to(ts: Column, step: int) -> Column:
    return ts - F.pmod(ts, F.lit(step))


def local(ts: Column, exchange: str = "CN") -> Column:
    """Local wall-clock microseconds, written as if they were UTC."""
    return ts + F.lit(offset_us(exchange))


def epoch_day(ts: Column) -> Column:
    return floor_div(ts, DAY).cast("long")


def yyyymmdd(ts: Column) -> Column:
    return F.date_format(F.date_from_unix_date(epoch_day(ts).cast("int")), "yyyyMMdd").cast("int")


def minute_of_day(ts: Column) -> Column:
    return floor_div(F.pmod(ts, F.lit(DAY)), MINUTE).cast("int")


def hhmm(ts: Column) -> Column:
    m = minute_of_day(ts)
    return (F.call_function("div", m, F.lit(60)) * 100 + m % 60).cast("short")


def hh_mm(ts: Column) -> Column:
    m = minute_of_day(ts)
    return F.format_string("%02d:%02d", F.call_function("div", m, F.lit(60)).cast("int"), m % 60)


def tick_offset(tick: Column, tick_format: str = "HHMMSScc") -> Column:
    """Microseconds after midnight of an exchange's tick time.

    "HHMMSScc" takes the last three digits as milliseconds although one of them is a second's, as the feed's consumers do: order within a minute
    stays. "HHMMSSmmm" reads true milliseconds.
    """
    t = tick.cast("long")
    div = lambda n: F.call_function("div", t, F.lit(n))
    if tick_format == "HHMMSScc":
        h, m, s = div(1_000_000), div(10_000) % 100, div(100) % 100
    elif tick_format == "HHMMSSmmm":
        h, m, s = div(10_000_000), div(100_000) % 100, div(1000) % 100
    else:
        raise ValueError(f"unknown tick format {tick_format!r}")
    return ((h * 60 + m) * 60 + s) * 1_000_000 + (t % 1000) * 1000


def tick_parts(tick: Column) -> Column:
    """(hh, mm, ss, mmm) of a tick time of 7 to 9 digits; others give null. A leading 9 lacks its zero, and what still isn't 9 long lacks its last digit."""
    s = F.trim(tick.cast("string"))
    t = F.when((F.length(s) != 9) & s.startswith("9"), F.concat(F.lit("0"), s)).otherwise(s)
    t = F.when(F.length(t) != 9, F.concat(t, F.lit("0"))).otherwise(t)
    # counted from the right, so that an 8-digit rest keeps its place
    size = F.length(t)
    part = lambda end, n: F.substr(t, size - F.lit(end) + 1, F.lit(n)).cast("int")
    return F.when(F.length(s).between(7, 9) & s.rlike("^[0-9]+$"), F.struct(F.when(size >= 9, part(9, 2)).otherwise(F.substr(t, F.lit(1), size - 7).cast("int")).alias("hh"), part(7, 2).alias("mm"), part(5, 2).alias("ss"), part(3, 3).alias("mmm")))


def combine_date_tick(day: Column, parts: Column, exchange: str = "CN") -> Column:
    """Epoch microseconds of a local date and a struct of hours, minutes, seconds and, by the name `micros`, microseconds; null for parts that no clock shows."""
    hh, mm, ss, us = (parts[x].cast("long") for x in ("hh", "mm", "ss", "micros"))
    ok = hh.between(0, 23) & mm.between(0, 59) & ss.between(0, 59) & us.between(0, 999_999)
    return F.when(ok, F.unix_date(day).cast("long") * DAY + hh * HOUR + mm * MINUTE + ss * 1_000_000 + us - offset_us(exchange))


def base_day(trade_time: Column, exchange: str = "CN") -> Column:
    """Epoch microseconds of local midnight of a trade time's date."""
    return F.unix_date(extract_date(trade_time)).cast("long") * DAY - offset_us(exchange)


def extract_date(value: Column) -> Column:
    """Date of YYYY-MM-DD..., YYYY/MM/DD... or YYYYMMDD... text; null for anything else."""
    s = F.trim(value.cast("string"))
    return F.coalesce(F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring(s, 1, 10), "yyyy/MM/dd"), F.try_to_date(F.substring(s, 1, 8), "yyyyMMdd"))


def parse_instant(value: Column) -> Column:
    """Microseconds of digits (10, 13, 16 or 19 of them: s, ms, us, ns) or of one of five date-time forms; null for anything else."""
    s = F.trim(value.cast("string"))
    number = F.when(s.rlike("^[0-9]+$"), s.try_cast("long"))
    text = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss.SSSSSS", "yyyy/MM/dd HH:mm:ss", "yyyyMMddHHmmss")])
    n = F.length(s)
    return F.when(number.isNotNull() & (n == 10), number * 1_000_000).when(number.isNotNull() & (n == 13), number * 1000).when(number.isNotNull() & (n == 16), number).when(number.isNotNull() & (n == 19), F.call_function("div", number, F.lit(1000))).otherwise(micros(text))


def is_trading_time(ts: Column) -> Column:
    """Whether local microseconds are in the closed sessions."""
    t = F.pmod(ts, F.lit(DAY))
    return t.between(MORNING[0] * MINUTE, MORNING[1] * MINUTE) | t.between(AFTERNOON[0] * MINUTE, AFTERNOON[1] * MINUTE)


def trading_day(ts_utc: Column, strict: bool = False) -> Column:
    """struct<exchange, trading_date> of UTC microseconds in the half-open local sessions; null outside, or an error if `strict`."""
    t = local(ts_utc)
    m = minute_of_day(t)
    inside = ((m >= MORNING[0]) & (m < MORNING[1])) | ((m >= AFTERNOON[0]) & (m < AFTERNOON[1]))
    day = F.struct(F.lit("SSE").alias("exchange"), F.date_from_unix_date(epoch_day(t).cast("int")).alias("trading_date"))
    outside = F.raise_error(F.concat(F.lit("not a trading minute: "), ts_utc.cast("string"))) if strict else F.lit(None)
    return F.when(inside, day).otherwise(outside)


def is_minute_boundary(ts: Column) -> Column:
    return F.pmod(ts, F.lit(MINUTE)) == 0


def add_minutes(ts: Column, n: int) -> Column:
    return ts + F.lit(n * MINUTE)


def trading_neighbours(days: DataFrame, day: str = "day") -> DataFrame:
    """Each trading day with the one before and the one after (null at the ends). A calendar is small, so one ordered partition does."""
    w = Window.orderBy(day)
    return days.select(day).distinct().select(day, F.lag(day).over(w).alias("prev_day"), F.lead(day).over(w).alias("next_day"))


class Calendar:
    """Trading days on the driver: membership, and strictly the next or the one before; ValueError where there is none."""

    def __init__(self, days: Iterable[date]):
        self.days = sorted(set(days))

    def __contains__(self, day: date) -> bool:
        return day in self.days

    def next(self, day: date) -> date:
        later = [d for d in self.days if d > day]
        if not later:
            raise ValueError(f"no trading day after {day}")
        return later[0]

    def previous(self, day: date) -> date:
        before = [d for d in self.days if d < day]
        if not before:
            raise ValueError(f"no trading day before {day}")
        return before[-1]


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=k) for k in range((last - first).days + 1)]


def shift_date(day: date, source: date, target: date) -> date:
    """`day` moved as far as `source` is from `target`."""
    return target + (day - source)


def resolve_date(text: str | None) -> str:
    """Strictly YYYY-MM-DD; today's for None."""
    if text is None:
        return date.today().isoformat()
    return datetime.strptime(text, "%Y-%m-%d").date().isoformat()
