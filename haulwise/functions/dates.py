"""Date and timestamp standardization to ISO text.

Free-form dates are read month-first; when the first number cannot be a
month the day-first reading is used. Accepted layouts (after trimming and
mapping '/' to '-'): ``yyyy-M-d``, ``M-d-yyyy`` / ``d-M-yyyy``, ``yyyyMMdd``,
each optionally followed by ``[T ]H:mm[:ss[.f]]``, which may carry a ``Z`` /
``+hh:mm`` / ``+hhmm`` offset. Anything else, and impossible dates or times,
give NULL.

The date token is the leading run of digits and '-'; the rest is validated
by one range-checked regex, so no timestamp has to be built to know a time
is valid. ``with_date`` / ``with_timestamp_text`` add the result as a column
and keep each intermediate in its own projection, so it is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.functions.text import strip_text

DATE_RE = r"^(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}-\d{1,2}-\d{4}|\d{8})$"
ISO_RE = r"^\d{4}-\d{1,2}-\d{1,2}$"
LEAD_RE = r"^[0-9-]+"
# what may follow the date: groups 1 hour, 2 minute, 3 second, 4 fraction, 5 offset
REST_RE = (r"^[T ]([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d)(?:\.(\d{1,6}))?)?"
           r" ?(Z|[+-](?:[01]\d|2[0-3]):?[0-5]\d)?$")
MDY_RE = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
COMPACT_RE = r"^(\d{4})(\d{2})(\d{2})$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_steps(c):
    """(date, rest) columns for text ``c`` as single expressions."""
    t = F.replace(strip_text(_col(c)), F.lit("/"), F.lit("-"))
    d = F.regexp_extract(t, LEAD_RE, 0)
    rest = F.substring(t, F.length(d) + 1, F.length(t))
    return _date_steps_from(d, rest), rest


def _rest_groups(rest: Column) -> Column:
    """The groups of ``REST_RE`` as an array, by one match; a missing one is empty text."""
    return F.split(F.regexp_replace(rest, REST_RE, "$1|$2|$3|$4|$5"), r"\|")


def _iso(day: Column, groups: Column) -> Column:
    def g(i):
        return F.coalesce(F.get(groups, i - 1), F.lit(""))

    hh = F.lpad(F.coalesce(F.nullif(g(1), F.lit("")), F.lit("0")), 2, "0")
    mm = F.coalesce(F.nullif(g(2), F.lit("")), F.lit("00"))
    ss = F.coalesce(F.nullif(g(3), F.lit("")), F.lit("00"))
    frac6 = F.rpad(g(4), 6, "0")
    frac_txt = F.when((g(4) != "") & (frac6 != "000000"), F.concat(F.lit("."), frac6)).otherwise("")
    zone = g(5)
    z = F.regexp_replace(zone, ":", "")
    zone_txt = (F.when(zone == "", F.lit(""))
                .when((zone == "Z") | (F.substring(z, 2, 4) == "0000"), F.lit("+00:00"))
                .otherwise(F.concat(F.substring(z, 1, 3), F.lit(":"), F.substring(z, 4, 2))))
    return F.when(day.isNotNull(), F.concat(day.cast("string"), F.lit("T"), hh, F.lit(":"), mm,
                                            F.lit(":"), ss, frac_txt, zone_txt))


def parse_date(c) -> Column:
    """Free-form text -> DATE (NULL when blank or unparseable)."""
    return _date_steps(c)[0]


def standardize_date(c) -> Column:
    """Free-form text -> ``yyyy-MM-dd`` text."""
    return parse_date(c).cast("string")


def standardize_timestamp(c) -> Column:
    """Free-form text -> ISO-8601 text (seconds always, microseconds when
    non-zero, offset as +hh:mm when given)."""
    day, rest = _date_steps(c)
    return _iso(day, _rest_groups(rest))


def _staged(df: DataFrame, mapping: dict[str, str], final) -> DataFrame:
    """Shared staging: one projection per step for all columns at once."""
    names = {out: (f"_{out}_t", f"_{out}_d", f"_{out}_r") for out in mapping.values()}
    df = df.withColumns({names[o][0]: F.replace(strip_text(F.col(s)), F.lit("/"), F.lit("-")) for s, o in mapping.items()})
    df = df.withColumns({names[o][1]: F.regexp_extract(F.col(names[o][0]), LEAD_RE, 0) for o in mapping.values()})
    df = df.withColumns({names[o][2]: F.substring(F.col(names[o][0]), F.length(F.col(names[o][1])) + 1,
                                              F.length(F.col(names[o][0])))
                         for o in mapping.values()})
    helpers = [h for o in mapping.values() for h in names[o]]
    return final(df, names).drop(*helpers)


def _date_steps_from(d: Column, rest: Column) -> Column:
    ok = d.rlike(DATE_RE) & ((rest == "") | rest.rlike(REST_RE)) & ~d.startswith("0000")
    month_first = F.when(d.rlike(ISO_RE), d).otherwise(  # most texts: nothing to rearrange
        F.regexp_replace(F.regexp_replace(d, MDY_RE, "$3-$1-$2"), COMPACT_RE, "$1-$2-$3"))
    day_first = F.when(d.rlike(MDY_RE), F.regexp_replace(d, MDY_RE, "$3-$2-$1"))
    return F.when(ok, F.coalesce(month_first.try_cast("date"), day_first.try_cast("date")))


def with_dates(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Add a DATE column per ``{source text column: output column}``."""
    def final(d, names):
        return d.withColumns({o: _date_steps_from(F.col(names[o][1]), F.col(names[o][2])) for o in mapping.values()})
    return _staged(df, mapping, final)


def with_date(df: DataFrame, src: str, out: str) -> DataFrame:
    return with_dates(df, {src: out})


def with_timestamp_text(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ISO-8601 text column ``out`` standardized from ``src``."""
    def final(d, names):
        _, dcol, rcol = names[out]
        d = d.withColumns({f"_{out}_day": _date_steps_from(F.col(dcol), F.col(rcol)), f"_{out}_g": _rest_groups(F.col(rcol))})
        return d.withColumn(out, _iso(F.col(f"_{out}_day"), F.col(f"_{out}_g"))).drop(f"_{out}_day", f"_{out}_g")
    return _staged(df, {src: out}, final)
