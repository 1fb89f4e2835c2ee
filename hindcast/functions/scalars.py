"""Scalar column expressions: parsing, rounding, labels and name handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.schemas import KIND_RANKS

# The spellings in which archives and pages write times.
ARCHIVE_TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)
GAUGE_TIME_FORMAT = "dd.MM.yyyy HH:mm"
CLOCK_SUFFIX = " Uhr"


def named(column: str) -> Column:
    """A column whose name may hold dots, as quantile columns do."""
    return F.col(f"`{column}`")


def as_utc(text: Column) -> Column:
    """Mixed-format text to an instant; text without offset means UTC, bad text is null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ARCHIVE_TIME_FORMATS])


def gauge_wall_time(text: Column) -> Column:
    """``dd.MM.yyyy HH:mm`` text (clock suffix allowed) to a wall-clock time without zone."""
    plain = F.trim(F.replace(text, F.lit(CLOCK_SUFFIX), F.lit("")))
    return F.try_to_timestamp(plain, F.lit(GAUGE_TIME_FORMAT)).cast("timestamp_ntz")


def decimal_comma(text: Column) -> Column:
    """Number text with a decimal comma to double; anything else, the text NaN included, is null."""
    return nan_to_null(F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def round_half_even(value: Column, digits: int = 2) -> Column:
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def kind_rank(kind: Column) -> Column:
    """Precedence of a forecast kind; unknown kinds rank below all known ones."""
    ranked = F.lit(None).cast("int")
    for name, rank in KIND_RANKS.items():
        ranked = F.when(kind == name, F.lit(rank)).otherwise(ranked)
    return F.coalesce(ranked, F.lit(-1))


def is_honest(kind: Column) -> Column:
    return F.coalesce(kind != "oracle", F.lit(True))


def backtest_label(offset_hours: Column, kind: Column) -> Column:
    note = F.when(is_honest(kind), F.lit("")).otherwise(F.lit(", perfect weather"))
    return F.concat(F.lit("Backtest -"), offset_hours.cast("string"), F.lit("h ("), kind, note, F.lit(")"))


def one_decimal(value: Column) -> Column:
    """Text of a double rounded to one decimal by its exact binary value, an exact half to the even digit.

    The built-in format rounds the shortest decimal form half up, so that 88.25 becomes 88.3 and 0.15, which is a little
    less than that, becomes 0.2. Here the fraction is counted in steps of ``2 ** -59``, and tenths of it are integers.
    """
    size = F.abs(value.cast("double"))
    whole = F.floor(size)
    tenths = ((size - whole) * F.lit(2.0 ** 59)).cast("long") * 10
    rest = tenths.bitwiseAND(F.lit(2 ** 59 - 1))
    digit = F.shiftright(tenths, 59)
    up = (rest > 2 ** 58) | ((rest == 2 ** 58) & (digit % 2 == 1))
    digit = digit + up.cast("int")
    text = F.concat((whole + F.floor(digit / 10)).cast("string"), F.lit("."), (digit % 10).cast("string"))
    return F.when(size < 2 ** 62, F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), text)).when(
        size.isNotNull(), F.format_string("%.1f", value.cast("double")))


def peak_label(value: Column, local_time: Column) -> Column:
    """Value to one decimal and local clock time, on two lines."""
    return F.concat(F.lit("Max: "), one_decimal(value), F.lit("°C\n"), F.date_format(local_time, "HH:mm"))


# Fixed value: how a quantile column spells its channel and level.
QUANTILE_NAME = r"^(.+)_q([0-9.]+)$"


def name_channel(name: Column) -> Column:
    return F.regexp_extract(name, QUANTILE_NAME, 1)


def name_level(name: Column) -> Column:
    return F.regexp_extract(name, QUANTILE_NAME, 2).try_cast("double")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def relabel(column: Column, mapping: dict[str, str]) -> Column:
    """Replace category values, leaving values outside the mapping as they are."""
    out = column
    for old, new in mapping.items():
        out = F.when(column == old, F.lit(new)).otherwise(out)
    return out
