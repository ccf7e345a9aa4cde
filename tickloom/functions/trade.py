"""Per-trade expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.params import Params

USD_SCALE = 10_000


def normalize_symbol(symbol: Column) -> Column:
    """Upper case without surrounding white space of any kind."""
    return F.upper(F.regexp_replace(symbol, r"^\s+|\s+$", ""))


def usd_value(price: Column, quantity: Column) -> Column:
    return F.round(price * quantity, 4)


def size_class(usd: Column, params: Params) -> Column:
    return (
        F.when(usd < params.retail_max, F.lit("Retail"))
        .when(usd <= params.pro_max, F.lit("Pro"))
        .otherwise(F.lit("Whale"))
    )


def regularized_z(usd: Column, mean: Column, stdev: Column) -> Column:
    """Distance from the mean in standard deviations, with a floor under the latter.

    NULL where the squares of the window are beyond any double.
    """
    floor = F.greatest(F.abs(mean) * 0.001, F.lit(1.0))
    z = (usd - mean) / F.greatest(stdev, floor)
    return F.when(F.abs(stdev) < float("inf"), z)


def anomaly_flag(z: Column, params: Params) -> Column:
    return F.coalesce(F.abs(z) > params.z_score_threshold, F.lit(False))


# An amount is a whole number of 1/10000 dollars, kept in two limbs of 20 bits and more: amount =
# SPLIT * hi + lo, lo of either sign. Sums of the limbs and of their products are doubles. For everyday amounts they are
# whole numbers below 2^53, and so exact in any order; larger ones only lose digits, as a
# double does, but never overflow before the squares of amounts of 1e156 dollars do.
SPLIT = float(1 << 20)
SUMS = ("hi", "lo", "hihi", "hilo", "lolo")


def limbs(usd: Column, names: tuple[str, str] = ("hi", "lo")) -> list[Column]:
    """Both limbs of a USD value; NULL, and thereby no part of any sum, if it is not finite."""
    unit = F.rint(usd * USD_SCALE)
    whole = F.rint(unit / SPLIT)
    hi = F.when(F.abs(usd) < 1e300, whole).otherwise(usd * (USD_SCALE / SPLIT))
    lo = F.when(F.abs(usd) < 1e300, unit - whole * SPLIT).otherwise(F.lit(0.0))
    finite = F.abs(usd) < float("inf")
    return [F.when(finite, c).alias(n) for c, n in zip((hi, lo), names)]


def limb_sums(hi: Column, lo: Column) -> dict[str, Column]:
    """The aggregates of ``SUMS`` over two columns of limbs."""
    parts = {"hi": hi, "lo": lo, "hihi": hi * hi, "hilo": hi * lo, "lolo": lo * lo}
    return {name: F.sum(part) for name, part in parts.items()}


def total_from_sums(sums: dict[str, Column]) -> Column:
    """The sum in USD."""
    return (sums["hi"] * SPLIT + sums["lo"]) / USD_SCALE


def mean_from_sums(n: Column, sums: dict[str, Column]) -> Column:
    # In this order the sum of everyday amounts is still a whole number when it is divided.
    return (sums["hi"] * SPLIT + sums["lo"]) / F.nullif(n, F.lit(0)) / USD_SCALE


def _moved(products: Column, a: Column, b: Column, n: Column) -> tuple[Column, Column, Column]:
    """Products and both sums about whole numbers near the two means."""
    near_a, near_b = F.rint(a / n), F.rint(b / n)
    rest_a, rest_b = a - n * near_a, b - n * near_b
    return products - near_a * b - near_b * rest_a, rest_a, rest_b


def spread_from_sums(
    n: Column, mixed: dict[tuple[str, str], Column], a: dict[str, Column], b: dict[str, Column]
) -> Column:
    """Covariance in units squared from the sums of the limbs of two series.

    ``mixed`` has the sum of products of each limb of the first with each of the second. Every
    sum is moved to the means of its limbs before anything is divided, so that everyday amounts
    cancel as whole numbers.
    """
    n = F.nullif(n, F.lit(0)).cast("double")
    total, rest_a, rest_b = F.lit(0.0), {}, {}
    for (x, y), products in mixed.items():
        weight = (SPLIT if x == "hi" else 1.0) * (SPLIT if y == "hi" else 1.0)
        moved, rest_a[x], rest_b[y] = _moved(products, a[x], b[y], n)
        total = total + moved * weight
    apart = [(r["hi"] * SPLIT + r["lo"]) / n for r in (rest_a, rest_b)]
    return total / n - apart[0] * apart[1]


def stdev_from_sums(n: Column, sums: dict[str, Column]) -> Column:
    """Population deviation in USD."""
    mixed = {
        ("hi", "hi"): sums["hihi"],
        ("hi", "lo"): sums["hilo"],
        ("lo", "hi"): sums["hilo"],
        ("lo", "lo"): sums["lolo"],
    }
    # Not a number only where squares overflow: then the deviation is beyond any double too.
    variance = F.nanvl(spread_from_sums(n, mixed, sums, sums), F.lit(float("inf")))
    return F.when(n > 0, F.sqrt(F.greatest(variance, F.lit(0.0))) / USD_SCALE)


def with_moments(rows: DataFrame) -> DataFrame:
    """Add ``mean`` and ``stdev`` to rows with ``n`` and the sums ``s_hi`` to ``s_lolo``.

    The figures of ``mean_from_sums`` and ``stdev_from_sums`` in short steps, for many rows: what is
    used twice is a column, and the generated code stays within what the JVM compiles.
    """
    kept = rows.columns
    rows = rows.selectExpr("*", "CAST(nullif(n, 0L) AS DOUBLE) AS _n")
    rows = rows.selectExpr("*", f"(s_hi * {SPLIT}D + s_lo) / _n AS _m")
    rows = rows.selectExpr("*", f"rint(_m / {SPLIT}D) AS _h")
    rows = rows.selectExpr("*", f"rint(_m) - _h * {SPLIT}D AS _l")
    rows = rows.selectExpr("*", "s_hi - _n * _h AS _rh", "s_lo - _n * _l AS _rl")
    # Sums of products about the whole number nearest to the mean, in limbs as well.
    rows = rows.selectExpr(
        "*",
        f"((s_hihi - _h * s_hi - _h * _rh) * {SPLIT}D * {SPLIT}D"
        f" + (s_hilo - _h * s_lo - _l * _rh) * {2 * SPLIT}D"
        " + (s_lolo - _l * s_lo - _l * _rl)) / _n AS _sq",
        f"(_rh * {SPLIT}D + _rl) / _n AS _r",
    )
    return rows.selectExpr(
        *[f"`{c}`" for c in kept],
        f"_m / {USD_SCALE} AS mean",
        f"IF(_n IS NULL, NULL, sqrt(greatest(nanvl(_sq - _r * _r, DOUBLE('Infinity')), 0D)) / {USD_SCALE}) AS stdev",
    )
