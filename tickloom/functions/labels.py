"""Display texts and severity labels.

Numbers are rounded half up on their decimal text before they are printed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def _fixed(value: Column, digits: int) -> Column:
    return _decimal(value, digits).cast("string")


def _decimal(value: Column, digits: int) -> Column:
    return F.round(value.cast("decimal(34,12)"), digits)


def _grouped(value: Column, digits: int) -> Column:
    return F.format_number(_decimal(value, digits), digits)


def _or_dash(value: Column, text: Column) -> Column:
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(DASH)).otherwise(text)


def fmt_usd(value: Column) -> Column:
    """Short dollar amount: billions, millions, thousands or whole dollars."""
    steps = F.when(value >= 1e9, F.concat(_fixed(value / 1e9, 2), F.lit("B")))
    steps = steps.when(value >= 1e6, F.concat(_fixed(value / 1e6, 2), F.lit("M")))
    steps = steps.when(value >= 1e3, F.concat(_fixed(value / 1e3, 1), F.lit("K")))
    return _or_dash(value, F.concat(F.lit("$"), steps.otherwise(_fixed(value, 0))))


def fmt_price(value: Column) -> Column:
    return _or_dash(value, F.concat(F.lit("$"), _grouped(value, 2)))


def fmt_z(value: Column) -> Column:
    sign = F.when(value >= 0, F.lit("+")).otherwise(F.lit("-"))
    return _or_dash(value, F.concat(sign, _fixed(F.abs(value), 2)))


def fmt_percent(value: Column) -> Column:
    return _or_dash(value, F.concat(_fixed(value * 100, 1), F.lit("%")))


def fmt_count(value: Column) -> Column:
    return _or_dash(value, _grouped(value, 0))


def fmt_cv(value: Column) -> Column:
    return _or_dash(value, _fixed(value, 3))


def fmt_time(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "HH:mm:ss"), F.lit(DASH))


def fmt_time_centis(ts: Column) -> Column:
    """Time with hundredths of a second, cut off."""
    return F.coalesce(F.date_format(ts, "HH:mm:ss.SS"), F.lit(DASH))


def base_asset(symbol: Column, quote: str = "USDT") -> Column:
    """Symbol without the first occurrence of the quote asset."""
    at = F.instr(symbol, quote)
    rest = F.concat(F.substring(symbol, F.lit(1), at - 1), F.substr(symbol, at + len(quote)))
    return F.when(at > 0, rest).otherwise(symbol)


def asset_family(symbol: Column, first: str = "BTC", other: str = "ETH") -> Column:
    is_first = F.coalesce(symbol.startswith(first), F.lit(False))
    return F.when(is_first, F.lit(first.lower())).otherwise(F.lit(other.lower()))


def class_code(classification: Column) -> Column:
    return (
        F.when(classification == "Whale", F.lit("W"))
        .when(classification == "Pro", F.lit("PRO"))
        .otherwise(F.lit("RET"))
    )


def z_bar_percent(z: Column) -> Column:
    return F.least(F.abs(z) / 5 * 100, F.lit(100.0))


def z_bar_color(z: Column) -> Column:
    return F.when(z.isNotNull(), F.when(F.abs(z) > 3, F.lit("red")).otherwise(F.lit("neutral")))


def recent_z_color(z: Column) -> Column:
    size = F.abs(F.coalesce(z, F.lit(0.0)))
    return F.when(size > 2, F.lit("red")).when(size > 1, F.lit("amber")).otherwise(F.lit("neutral"))


def correlation_color(r: Column) -> Column:
    return (
        F.when(r.isNull(), F.lit("dim"))
        .when(r > 0.7, F.lit("green"))
        .when(r < -0.3, F.lit("red"))
        .otherwise(F.lit("amber"))
    )


def describe_trade(
    symbol: Column, usd: Column, classification: Column, z: Column, is_anomaly: Column
) -> Column:
    """One-line text of an enriched trade."""
    sign = F.when(z < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(
        F.lit("["),
        symbol,
        F.lit("] $"),
        _grouped(usd, 2),
        F.lit(" ("),
        classification,
        F.lit(") z="),
        F.coalesce(F.concat(sign, _fixed(F.abs(z), 2)), F.lit("warming")),
        F.when(is_anomaly, F.lit(" 🚨ANOMALY")).otherwise(F.lit("")),
    )
