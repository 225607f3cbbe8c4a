"""Columns of a trip record: duration, rider, member type, keys, labels, time parts.

Numbers are taken as doubles; :mod:`tripflow.functions.parsing` makes them from text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions.parsing import blank_to_null, seconds_between, whole


def derive_duration_clean(given: Column, started: Column, ended: Column) -> Column:
    """Given seconds, else end minus start rounded half to even."""
    return F.coalesce(given, F.bround(seconds_between(started, ended), 0))


def derive_duration_load(given: Column, started: Column, ended: Column) -> Column:
    """Given seconds, else end minus start, else 0; cut to a whole number."""
    seconds = F.coalesce(given, seconds_between(started, ended), F.lit(0.0))
    return whole(seconds, "int")


def clean_birth_year(number: Column, this_year: int) -> Column:
    """Whole year in [1900, this year], else NULL; a fraction gives NULL."""
    usable = number.between(schema.MIN_BIRTH_YEAR, this_year) & (number == F.floor(number))
    return F.when(usable, whole(number))


def load_birth_year(number: Column, this_year: int) -> Column:
    """The same year, with 0 for none."""
    year = clean_birth_year(number, this_year)
    return F.coalesce(year.cast("smallint"), F.lit(0).cast("smallint"))


def clean_gender(number: Column) -> Column:
    return F.when(number == F.floor(number), whole(number))


def load_gender(number: Column) -> Column:
    return F.coalesce(clean_gender(number).try_cast("smallint"), F.lit(0).cast("smallint"))


def load_coordinate(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0)).cast("float")


def _member_of(usertype: Column) -> Column:
    kind = F.lower(usertype)
    return F.when(kind == "subscriber", "member").when(kind == "customer", "casual")


def fill_member_clean(member: Column, usertype: Column) -> Column:
    return F.coalesce(member, _member_of(usertype))


def fill_member_load(member: Column, usertype: Column) -> Column:
    return F.coalesce(
        blank_to_null(member), _member_of(usertype), F.lit(schema.UNKNOWN_MEMBER)
    )


def default_bike_type(kind: Column) -> Column:
    return F.coalesce(kind, F.lit(schema.DEFAULT_BIKE))


def text_fill(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)


def file_stem(name: Column) -> Column:
    """Name of a monthly file without its ending or its clean-output ending."""
    return F.regexp_replace(file_name(name), r"(__clean\.parquet|\.csv)$", "")


def to_the_second(moment: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS', fractions dropped."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def year_month(moment: Column) -> Column:
    # two date fields are cheaper per row than a formatter
    month = F.lpad(F.month(moment).cast("string"), 2, "0")
    return F.concat_ws("-", F.lpad(F.year(moment).cast("string"), 4, "0"), month)


def ride_key(source_file: Column, started: Column, ended: Column, bike: Column) -> Column:
    """md5 identity of a loaded trip; two trips of one file with equal parts share it."""
    return F.md5(F.concat(
        source_file, F.lit("|"), to_the_second(started), F.lit("|"), to_the_second(ended),
        F.lit("|"), F.coalesce(bike, F.lit("")),
    ))


def station_label(name: Column, station_id: Column) -> Column:
    return F.coalesce(name, station_id.cast("string"))


def clean_station_id(value: Column) -> Column:
    """Trimmed id; empty and 'nan' give NULL."""
    text = F.trim(value.cast("string"))
    return F.when((text != "") & (text != "nan"), text)


def day(moment: Column) -> Column:
    return F.to_date(moment)


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)


def hour_start(moment: Column) -> Column:
    return F.date_trunc("hour", moment).cast("timestamp_ntz")


def weekday_name(moment: Column) -> Column:
    return F.date_format(moment, "EEEE")
