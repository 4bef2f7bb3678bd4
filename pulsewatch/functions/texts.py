"""Numbers, names and dates as report text."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: display names of site codes ------------------------------
SITE_NAMES = {
    "d": "Desktop",
    "m": "Mobile",
    "t": "Tablet",
    "aa": "Android App",
    "aios": "iOS App",
    "0": "site_type = 0",
}
# -----------------------------------------------------------------------------


def round_even(value: Column, digits: int = 2) -> Column:
    """Round half to even; adding 0.0 turns a negative zero into zero."""
    return F.bround(value.cast("double"), digits) + F.lit(0.0)


def number_text(value: Column, digits: int = 2) -> Column:
    return F.format_number(round_even(value, digits), digits)


def currency_text(value: Column, prefix: str = "", symbol: str = "$",
                  code: Column | None = None) -> Column:
    sign = F.when(value < 0, "-").otherwise(prefix)
    parts = [sign, F.lit(symbol), number_text(F.abs(value))]
    if code is not None:
        parts.append(F.when(code == "", "").otherwise(F.concat(F.lit(" "), code)))
    return F.concat(*parts)


def _with_plus(value: Column, text: Column, plus: bool) -> Column:
    return F.concat(F.when(value > 0, "+").otherwise(""), text) if plus else text


def percent_text(value: Column, plus: bool = False, digits: int = 2) -> Column:
    scaled = round_even(value * 100, digits)
    return _with_plus(scaled, F.concat(number_text(scaled, digits), F.lit("%")), plus)


def bps_text(value: Column, plus: bool = False, digits: int = 0) -> Column:
    rounded = round_even(value, digits)
    return _with_plus(rounded, F.concat(number_text(rounded, digits), F.lit(" bps")), plus)


def compact_text(value: Column) -> Column:
    """1234 -> 1K, millions M, billions B; anything below 1000 in full."""
    def scaled(unit: float, suffix: str) -> Column:
        return F.concat(round_even(value / unit, 0).cast("bigint").cast("string"), F.lit(suffix))

    return (F.when(value < 1_000, number_text(value, 0))
            .when(value < 1_000_000, scaled(1e3, "K"))
            .when(value < 1_000_000_000, scaled(1e6, "M"))
            .otherwise(scaled(1e9, "B")))


def title_name(name: Column) -> Column:
    return F.initcap(F.lower(name))


def every_part_capitalized(name: Column) -> Column:
    """Like title_name, but every run of letters starts with a capital: Anne-Marie, O'Neil."""
    parts = F.split(F.lower(name), r"(?<=[^\p{L}])|(?=[^\p{L}])")
    return F.array_join(F.transform(parts, capitalize_first), "")


def capitalize_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))


def user_name(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def site_name(code: Column) -> Column:
    chain = None
    for key, shown in SITE_NAMES.items():
        chain = (F.when if chain is None else chain.when)(F.lower(code) == key, shown)
    return chain.otherwise(every_part_capitalized(code))


def percent_difference(before: Column, after: Column) -> Column:
    """Relative change; null where the base is zero."""
    return F.try_divide(after - before, before)


def bps_change(before: Column, after: Column, multiplier: float = 1.0) -> Column:
    return (after - before) * F.lit(float(multiplier))


def moment_text(moment: datetime, zone: str, show_zone: bool = True) -> Column:
    """Like "Fri  1 Mar 2024 09:30AM UTC" for a UTC moment in a time zone, with its abbreviation then."""
    utc = F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    text = F.concat(
        F.date_format(local, "EEE "), F.lpad(F.date_format(local, "d"), 2, " "),
        F.date_format(local, " MMM yyyy hh:mma"))
    if not show_zone:
        return text
    return F.concat(text, F.lit(moment.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).strftime(" %Z")))


def day_text(day: Column) -> Column:
    return F.concat(F.date_format(day, "EEE "), F.lpad(F.date_format(day, "d"), 2, " "),
                    F.date_format(day, " MMM yyyy"))
