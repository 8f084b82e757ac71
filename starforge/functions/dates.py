"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parse formats tried in order, each behind a cheap shape test: a failed
# parse costs an exception on the JVM, a failed regex does not, so a value is
# only handed to the formats whose shape it has. Month-first before day-first:
# '05/06/2026' is 6 May, '13/05/2026' fails month-first and becomes 13 May.
_D2 = r"[0-9]{1,2}"
_Y = r"[0-9]{4}"
DATETIME_FORMATS = [
    ("yyyy-MM-dd HH:mm:ss", rf"^{_Y}-{_D2}-{_D2} {_D2}:[0-9]{{2}}:[0-9]{{2}}$"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", rf"^{_Y}-{_D2}-{_D2} {_D2}:[0-9]{{2}}:[0-9]{{2}}[.][0-9]{{1,6}}$"),
    ("yyyy-MM-dd'T'HH:mm:ss", rf"^{_Y}-{_D2}-{_D2}T{_D2}:[0-9]{{2}}:[0-9]{{2}}$"),
    ("yyyy-MM-dd HH:mm", rf"^{_Y}-{_D2}-{_D2} {_D2}:[0-9]{{2}}$"),
    ("yyyy-MM-dd", rf"^{_Y}-{_D2}-{_D2}$"),
    ("yyyy/MM/dd", rf"^{_Y}/{_D2}/{_D2}$"),
    ("M/d/yyyy", rf"^{_D2}/{_D2}/{_Y}$"),
    ("d/M/yyyy", rf"^{_D2}/{_D2}/{_Y}$"),
    ("M-d-yyyy", rf"^{_D2}-{_D2}-{_Y}$"),
    ("d-M-yyyy", rf"^{_D2}-{_D2}-{_Y}$"),
    ("MMM d yyyy", rf"^[A-Za-z]{{3}} {_D2} {_Y}$"),
    ("d MMM yyyy", rf"^{_D2} [A-Za-z]{{3}} {_Y}$"),
]

# The same formats in strptime notation (for SQL oracles).
STRPTIME_FORMATS = [
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M",
    "%Y-%m-%d",
    "%Y/%m/%d",
    "%m/%d/%Y",
    "%d/%m/%Y",
    "%m-%d-%Y",
    "%d-%m-%Y",
    "%b %d %Y",
    "%d %b %Y",
]


# One test every format's shape passes: numbers and words stop here.
ANY_SHAPE = rf"^(?:[A-Za-z]{{3,9}}, )?([0-9]{{1,4}}[-/.][0-9]{{1,2}}[-/.][0-9]{{1,4}}|[0-9]{{8}}T|[A-Za-z]{{3,9}}[., ]+{_D2}|{_D2}[ -][A-Za-z]{{3,9}}[., -]+{_Y})"


# -- the grammar: date part, separator, time part, fraction, half of the day, offset ---------------
# It takes what none of the formats above has. A date is year first, or month first (day first where
# that is no date), each with one of three separators; or has its month written out, in front or between.
_MONTH = ("(?:[Jj]an(?:uary)?|[Ff]eb(?:ruary)?|[Mm]ar(?:ch)?|[Aa]pr(?:il)?|[Mm]ay|[Jj]une?|[Jj]uly?|[Aa]ug(?:ust)?|[Ss]ept?(?:ember)?"
          "|[Oo]ct(?:ober)?|[Nn]ov(?:ember)?|[Dd]ec(?:ember)?)[.]?")
_SEP = r"[-/.]"
_DATE = (rf"(?:{_Y}{_SEP}{_D2}{_SEP}{_D2}|{_D2}{_SEP}{_D2}{_SEP}{_Y}|[0-9]{{8}}(?=T)|{_MONTH} {_D2},? {_Y}|{_D2}[ -]{_MONTH},?[ -]{_Y})")
_TIME = rf"(?:{_D2}:[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]{{1,9}})?)?|[0-2][0-9][0-5][0-9][0-5][0-9])"
_OFFSET = r" ?(?:[Zz]|UTC|GMT|[+-][0-9]{2}(?::?[0-9]{2})?)"
GRAMMAR = rf"^(?:[A-Za-z]{{3,9}}, )?{_DATE}(?:(?:T|,? ){_TIME}(?: ?[AaPp][Mm])?(?:{_OFFSET})?)?$"

# Rewriting steps that turn any text of the grammar into "year month day time[ half][offset]", in order; the
# month-first reading is replaced by the day-first one where it gives no date.
_YEAR_LAST = rf"^({_D2}){_SEP}({_D2}){_SEP}({_Y})"
_STEPS = [
    (r"^[A-Za-z]{3,9}, (?=[0-9A-Z])", ""),                                  # the day of the week
    (rf"^([A-Za-z]{{3}})[A-Za-z]*[.]? ({_D2}),? ({_Y})", "$3 $1 $2"),
    (rf"^({_D2})[ -]([A-Za-z]{{3}})[A-Za-z]*[.]?,?[ -]({_Y})", "$3 $2 $1"),
    (rf"^({_Y}){_SEP}({_D2}){_SEP}({_D2})", "$1 $2 $3"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})T", "$1 $2 $3 "),
    (_YEAR_LAST, "$3 $1 $2"),
    (rf"^({_Y} [0-9A-Za-z]+ {_D2})(?:T|,? )", "$1 "),
    (r" ([0-9]{2})([0-9]{2})([0-9]{2})(?![0-9:])", " $1:$2:$3"),            # a time without colons
    (rf"( {_D2}:[0-9]{{2}})(?![0-9:])", "$1:00"),                           # without seconds
    (r"[.,]([0-9]{1,6})[0-9]*", ".$1"),                                     # microseconds at most
    (r"(?<=[0-9]) ?([AaPp][Mm])", " $1"),
    (r" ?(?:[Zz]|UTC|GMT)$", "+00:00"),
    (r" ?([+-][0-9]{2})$", "$1:00"),
    (r" ?([+-][0-9]{2}):?([0-9]{2})$", "$1:$2"),
]
_CANONICAL = "yyyy [MMM][M] d[ h:mm:ss[.SSSSSS] a][ H:mm:ss[.SSSSSS]][XXX]"


def by_grammar(s: Column) -> Column:
    """Timestamp of text of the GRAMMAR's shape, NULL for a day or time there is not. Fractions beyond
    microseconds are cut; an offset is turned to UTC."""
    def read(year_last: str) -> Column:
        text = s
        for pattern, to in _STEPS:
            text = F.regexp_replace(text, pattern, year_last if pattern == _YEAR_LAST else to)
        return F.try_to_timestamp(text, F.lit(_CANONICAL))

    return F.coalesce(read("$3 $1 $2"), F.when(s.rlike(_YEAR_LAST), read("$3 $2 $1")))


def parse_datetime(c: Column) -> Column:
    """Mixed-format text -> timestamp, NULL when no format fits. The plain formats come first; only
    what they don't read is looked at by the grammar."""
    s = c.cast("string")
    parsed = [F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(f))) for f, shape in DATETIME_FORMATS]
    # behind a lambda the steps are evaluated one by one, and only for text that gets there; generated
    # together with the formats above they would make one method too long to be compiled to machine code
    other = F.transform(F.array(s), by_grammar).getItem(0)
    return F.when(s.rlike(ANY_SHAPE), F.coalesce(*parsed, F.when(s.rlike(GRAMMAR), other)))


def date_key(c: Column) -> Column:
    """YYYYMMDD integer of a date/timestamp column (NULL stays NULL)."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def key_year(k: Column) -> Column:
    return (k / 10000).cast("int")


def key_month(k: Column) -> Column:
    return ((k / 100).cast("int") % 100).cast("int")


def key_to_date(k: Column) -> Column:
    return F.to_date(k.cast("string"), "yyyyMMdd")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def calendar_attributes(d: Column) -> list[Column]:
    """dim_date attributes of a date column ``d`` (Monday = 0 for weekday)."""
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        day_name(d).alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]


def iso_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
