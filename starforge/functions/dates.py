"""Mixed-format date texts -> timestamps, by a small grammar in Spark expressions.

A text is read in one pass, whatever its layout:

1. the time of day (the last one) is cut out wherever it stands (``10:00``, ``10:00:30.5 pm``, ``10 am``, ``10h30``),
   with a zone behind it;
2. week days, ordinal endings and filler words are blanked, and what is left must be numbers, month names
   and separators;
3. its one to three date tokens are given their roles by their size and place: a month name is the month, a
   number of three or more digits or above 31 is the year, otherwise month comes before day and day before
   month only where the first number exceeds 12;
4. the fields make a timestamp if they are a real date.

These are the rules by which pandas reads mixed layouts month first.  Two-digit years lie in the 100 years
from 50 before this year.  Readings outside the range of nanosecond timestamps are NULL, as there.  Not read,
hence NULL: a time without a date, the words now and today (both depend on the day of the run), names of
months in other languages, and commas between digits.
A zone is dropped, so the wall-clock time of the text stays.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: English names and words as date texts use them.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december"]
WEEK_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
FILLERS = ["at", "on", "and", "ad", "of", "st", "nd", "rd", "th", "m", "t"]
ZONES = ["z", "utc", "gmt", "est", "edt", "cst", "cdt", "mst", "mdt", "pst", "pdt"]
# ---- end of fixed values

# First and last microsecond of a signed 64-bit count of nanoseconds from 1970 on.
_FIRST, _LAST = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"

_DAY_AND_TIME = r"-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?$"
_PLAIN = rf"^\d{{4}}{_DAY_AND_TIME}"
# plain, and surely in range
_USUAL = rf"^(?:1[7-9]|2[01])\d\d{_DAY_AND_TIME}"
_ZONE = rf"(?:\s*(?:{'|'.join(ZONES)}|[+-]\d\d:?\d\d)(?![a-z\d]))?"
_HALF = r"[ap]m?(?![a-z])"
_TIME = (r"(?<![\d:.+-])(\d{1,2}(?::|h)\d{1,2}(?:(?::|m)\d{1,3}(?:\.\d{1,9})?|m)?(?:\s*" + _HALF + r")?|\d{1,2}\s*" + _HALF
         + rf"){_ZONE}(?![\d:])")
_DIGITS_ONLY = r"^(\d{4})(\d\d)(\d\d)[t ]?(\d\d)(\d\d)(\d\d)?(\.\d+)?[ .,;]*$"
_DAY_NUMBER = r"(?<!\d)(\d{4})(\d\d)(\d\d)(?!\d)"
_SIX_DIGITS = r"^[ .,;]*(\d\d)(\d\d)(\d\d)[ .,;]*$"
_WORDS = r"(?<![a-z])(?:" + "|".join([f"{d[:3]}(?:{d[3:]})?" for d in WEEK_DAYS] + FILLERS) + r")(?![a-z])"
_MONTH = "(?:" + "|".join([f"{m[:3]}(?:{m[3:]})?" for m in MONTHS] + ["sept"]) + ")(?![a-z])"
_DATE = rf"^[ .,;/']*+(?:(?:\d++|{_MONTH})[ .,;/'-]*+)++$"
_QUARTER = r"^(?:(\d{4})-?q([1-4])|([1-4])q-?(\d{4}))$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _whole(text: Column) -> Column:
    return text.try_cast("int")


def _full_year(year: Column) -> Column:
    this = F.year(F.current_date())
    near = this - this % 100 + year
    return (F.when(year >= 100, year).when(near >= this + 50, near - 100).when(near < this - 50, near + 100)
             .otherwise(near))


def _token(text: Column) -> Column:
    """A date token: its value (the number, or the month of a name), whether it is a name, or long (3 digits up)."""
    named = text.rlike("^[a-z]")
    month = F.instr(F.lit("".join(name[:3] for name in MONTHS)), F.substring(text, 1, 3))
    return F.struct(F.when(named, ((month + 2) / 3).cast("int")).otherwise(_whole(text)).alias("v"), named.alias("name"),
                    (~named & (F.length(text) > 2)).alias("long"))


def _fields(tokens: Column, n: Column) -> Column:
    """(y, m, d) of the first ``n`` date tokens, not yet checked to be a date."""
    def ymd(y, m, d) -> Column:
        return F.struct(y.alias("y"), m.alias("m"), d.alias("d"))

    a, b, c = (F.get(tokens, i) for i in range(3))
    one, none = F.lit(1), F.lit(None).cast("int")
    x, y, z = a["v"], b["v"], c["v"]
    names = sum((F.coalesce(t["name"], F.lit(False)).cast("int") for t in (a, b, c)), F.lit(0))
    longs = sum((F.coalesce(t["long"], F.lit(False)).cast("int") for t in (a, b, c)), F.lit(0))
    three = (F.when(names == 0, F.when((x > 31) | a["long"], ymd(x, y, z)).when(x > 12, ymd(z, y, x)).otherwise(ymd(z, x, y)))
              .when(a["name"], F.when((y > 31) | (b["long"] & (longs == 1)), ymd(y, x, z)).otherwise(ymd(z, x, y)))
              .when(b["name"], F.when((x > 31) | (a["long"] & (longs == 1)), ymd(x, y, z)).otherwise(ymd(z, y, x)))
              .otherwise(F.when((y > 31) | (b["long"] & (longs == 1)), ymd(y, z, x)).otherwise(ymd(x, z, y))))
    two = (F.when(names == 0, F.when(x > 31, ymd(x, y, one)).when(y > 31, ymd(y, x, one)))
            .when(a["name"], F.when(y > 31, ymd(y, x, one))).otherwise(F.when(x > 31, ymd(x, y, one))))
    alone = F.when((names == 0) & (x > 999) & (x < 10000), ymd(x, one, one))
    return (F.when((names > 1) | (longs > 1), ymd(none, none, none)).when(n == 3, three).when(n == 2, two).when(n == 1, alone))


def _clock(text: Column) -> Column:
    """(h, i, s) of a time of day such as ``9:05:30.25 pm``; h is NULL for an impossible one, all 0 without text."""
    def read(parts: Column) -> Column:
        hour = F.coalesce(_whole(F.get(parts, 0)), F.lit(0))
        late, early = text.rlike(r"[\d\s]p"), text.rlike(r"[\d\s]a")
        half = F.when(late, F.when(hour <= 12, hour % 12 + 12)).when(early, F.when(hour <= 12, hour % 12)).otherwise(hour)
        second = F.concat(F.coalesce(F.get(parts, 2), F.lit("0")), F.lit("."), F.coalesce(F.substring(F.get(parts, 3), 1, 6), F.lit("0")))
        return F.struct(half.alias("h"), F.coalesce(_whole(F.get(parts, 1)), F.lit(0)).alias("i"),
                        second.cast("decimal(16,6)").alias("s"))
    midnight = F.struct(F.lit(0).alias("h"), F.lit(0).alias("i"), F.lit(0).cast("decimal(16,6)").alias("s"))
    return F.when(text == "", midnight).otherwise(_let(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), read))


def _compact_clock(digits: Column) -> Column:
    """(h, i, s) of ``hh``, ``hhmm`` or ``hhmmss``."""
    def part(at: int) -> Column:
        return F.coalesce(_whole(F.nullif(F.substring(digits, at, 2), F.lit(""))), F.lit(0))
    return F.struct(part(1).alias("h"), part(3).alias("i"), part(5).cast("decimal(16,6)").alias("s"))


def _from_parts(time: Column, words: Column) -> Column:
    """Timestamp of the time text and the date text without it."""
    def made(ymd: Column, clock: Column) -> Column:
        return F.when(clock["s"] < 60, F.try_make_timestamp_ntz(_full_year(ymd["y"]), ymd["m"], ymd["d"],
                                                               clock["h"], clock["i"], clock["s"]))

    def of_tokens(texts: Column) -> Column:
        # digits behind a whole date are a time of day
        late = (time == "") & (F.size(texts) == 4) & F.get(texts, 3).rlike(r"^(?:\d\d){1,3}$")
        n = F.when(late, 3).otherwise(F.size(texts))
        ymd = _let(F.transform(texts, _token), lambda tokens: _fields(tokens, n))
        clock = F.when(late, _compact_clock(F.get(texts, 3))).otherwise(_clock(time))
        return _let(F.struct(ymd.alias("ymd"), clock.alias("clock")), lambda p: made(p["ymd"], p["clock"]))

    tokens = F.regexp_extract_all(words, F.lit(r"\d+|[a-z]+"), F.lit(0))
    return F.when(words.rlike(_DATE) & ~words.rlike(r"\d,\d|[-/] *$"), _let(tokens, of_tokens))


def _mixed(text: Column) -> Column:
    """Timestamp of lower-case, stripped ``text``."""
    def of_plain(s: Column) -> Column:
        timed = s.rlike(r"[:hap]")
        time = F.when(timed, F.regexp_extract(s, "(?s)^.*" + _TIME, 1)).otherwise(F.lit(""))
        date = F.trim(F.when(timed, F.regexp_replace(s, _TIME, " ")).otherwise(s))
        return _let(F.struct(time.alias("time"), _let(date, with_days_apart).alias("date")),
                    lambda p: _from_parts(p["time"], p["date"]))

    def with_days_apart(date: Column) -> Column:
        return F.when(date.rlike(r"[a-z]|\d{6}"), F.regexp_replace(F.regexp_replace(
            F.regexp_replace(date, _WORDS, " "), _DAY_NUMBER, "$1 $2 $3"), _SIX_DIGITS, "$1 $2 $3")).otherwise(date)

    def of_quarter(groups: Column) -> Column:
        return F.try_make_timestamp_ntz(_whole(F.get(groups, 0)), _whole(F.get(groups, 1)) * 3 - 2, F.lit(1), F.lit(0), F.lit(0), F.lit(0))

    spaced = F.regexp_replace(F.regexp_replace(text, r"\s", " "), _DIGITS_ONLY, "$1 $2 $3 $4:$5:0$6$7")
    quarter = F.split(F.regexp_replace(text, _QUARTER, "$1$4 $2$3"), " ")
    return F.when(text.rlike(_QUARTER), _let(quarter, of_quarter)).otherwise(_let(spaced, of_plain))


def mixed_timestamp(c: Column, strip: Callable[[Column], Column]) -> Column:
    """TIMESTAMP_NTZ of the text ``c``, month first, NULL if it is no date; ``strip`` takes off outer white space.

    The common layout (``2023-01-05 10:00:00``) is a plain cast; only other texts take the grammar.
    """
    def in_range(t: Column) -> Column:
        return F.when((t >= F.lit(_FIRST).cast("timestamp_ntz")) & (t <= F.lit(_LAST).cast("timestamp_ntz")), t)

    general = _let(F.lower(c), lambda text: _let(strip(text), _mixed))
    rest = _let(F.when(c.rlike(_PLAIN), c.try_cast("timestamp_ntz")).otherwise(general), in_range)
    return F.when(c.rlike(_USUAL), c.try_cast("timestamp_ntz")).otherwise(rest)
