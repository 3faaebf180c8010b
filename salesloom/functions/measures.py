"""Measures of the sales tables: months, cycle days, weighted values and guarded ratios."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"
# Of amounts below 10^17 Spark keeps nine exact decimals by itself; larger ones take the long way.
_AMOUNT = (26, 9)
_NINTH = Decimal("0.000000001")
_UNITS = "decimal(38,0)"
_HUNDRED = Decimal(100)


def month_of(c: Column) -> Column:
    """First day of the month, as a date, of a date or timestamp."""
    return F.trunc(F.to_date(c), "MM")


def cycle_days(
    start: Column, *ends: Column, as_of: Column | None = None, mode: str = "elapsed"
) -> Column:
    """Days from ``start`` to the first end that is set, else to ``as_of`` (now by default).

    ``elapsed`` counts whole periods of 24 hours, ``calendar`` counts midnights passed.
    """
    now = F.current_timestamp() if as_of is None else as_of
    end = F.coalesce(*ends, now)
    if mode == "elapsed":
        return F.timestamp_diff("DAY", start, end)
    if mode == "calendar":
        return F.datediff(end, start).cast("bigint")
    raise ValueError(f"unknown mode {mode!r}: use 'elapsed' or 'calendar'")


def weighted_value(value: Column, percent: Column) -> Column:
    """``value * percent / 100``, rounded once half away from zero to nine decimals.

    Exact for any amount and percent. NULL where the result needs more than 28 digits before the
    point.
    """
    share = (_narrow(percent, 9, 0) * Decimal("0.01")).cast("decimal(11,2)")
    usual = (_narrow(value, *_AMOUNT) * share).try_cast(NUMERIC)
    both = F.struct(value.alias("value"), percent.alias("percent"))
    return F.coalesce(usual, _let(both, lambda p: _wide_share(p["value"], p["percent"])))


def _wide_share(value: Column, percent: Column) -> Column:
    """The same in whole billionths, hundreds apart from the rest, so no product loses a digit.

    Each step is a value of its own: what is used more than once is computed once.
    """

    def products(p: Column) -> Column:
        hundreds = ((p["units"] - p["rest"]).cast(_UNITS) * Decimal("0.01")).cast("decimal(36,0)")
        small = (p["rest"].cast("decimal(2,0)") * p["share"]).cast("decimal(22,0)")
        large = F.try_multiply(hundreds, p["share"]).try_cast(_UNITS)
        return F.struct(large.alias("large"), small.alias("small"), (small % _HUNDRED).alias("small_rest"))

    def total(p: Column) -> Column:
        small_part = ((p["small"] - p["small_rest"]) / _HUNDRED).cast("decimal(20,0)")
        up = F.when(p["small_rest"] >= 50, 1).otherwise(0).cast("decimal(1,0)")
        return F.try_add(p["large"], small_part + up).try_cast(_UNITS)

    def low(total: Column) -> Column:
        return F.struct(total.alias("total"), (total % billion).alias("low"))

    def amount(p: Column) -> Column:
        whole = ((p["total"] - p["low"]) / billion).try_cast("decimal(28,0)")
        return _amount(whole, p["low"], (value < 0) != (percent < 0))

    def parted(units: Column) -> Column:
        share = F.abs(percent.try_cast("decimal(20,0)"))
        return F.struct(units.alias("units"), (units % _HUNDRED).alias("rest"), share.alias("share"))

    billion = F.lit(Decimal(10**9))
    parts = _let(_billionths(value), parted)
    return _let(_let(_let(_let(parts, products), total), low), amount)


def _narrow(c: Column, digits: int, scale: int) -> Column:
    """The amount as a decimal of so many digits, or NULL.

    A try_cast that fails throws and catches an exception, which takes far longer than the cast; so
    amounts that are too large are told by comparison first.
    """
    bound = Decimal(10 ** (digits - scale))
    return F.when((c < F.lit(bound)) & (c > F.lit(-bound)), c).try_cast(f"decimal({digits},{scale})")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used.

    A lambda stays out of the generated code, whose methods the JVM leaves uncompiled when they grow.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Amount over amount, rounded half away from zero to nine decimals.

    Spark divides two decimal(38,9) to six decimals only. So there are four ways, each for what the
    one before leaves: long integers, for amounts of four decimals; a double, where it has the right
    ninth decimal; whole billionths divided with a remainder, for amounts below 10^17; and long
    division, of which only denominators from 10^20 on need one step a digit. NULL where the quotient needs more than 28 digits before the point, or the denominator is 0.
    """

    def slowly(p: Column) -> Column:
        ways = (way(p["n"], p["d"]) for way in (_double_ratio, _usual_ratio, _long_ratio))
        return F.when(p["n"].isNotNull() & (p["d"] != 0), F.coalesce(*ways))

    both = F.struct(numerator.alias("n"), denominator.alias("d"))
    return F.coalesce(_quick_ratio(numerator, denominator), _let(both, slowly))


def _quick_ratio(numerator: Column, denominator: Column) -> Column:
    """In long integers, three digits at a time; NULL beyond four decimals or 9 * 10^9.

    Nothing here but the rounding stands under a condition, so the generated code computes each
    part once.
    """
    n = _ten_thousandths(numerator, 18)
    # 15 digits, so that a thousand times a rest is a long
    d = F.nullif(_ten_thousandths(denominator, 15), F.lit(0).cast("bigint"))
    total, rest = F.call_function("div", n, d), n % d
    for _ in range(3):
        wide = rest * 1000
        total = F.try_add(F.try_multiply(total, F.lit(1000)), F.call_function("div", wide, d))
        rest = wide % d
    up = (F.abs(rest) * 2 >= F.abs(d)).cast("int") * (F.signum(n) * F.signum(d)).cast("int")
    return (F.try_add(total, up).cast("decimal(19,0)") * F.lit(_NINTH)).cast(NUMERIC)


def _ten_thousandths(c: Column, digits: int) -> Column:
    """The amount as a long, if it has four decimals at most and fits."""
    near = _narrow(c, digits, 4)
    return F.when(near == c, (near * 10000).cast("bigint"))


def _double_ratio(n: Column, d: Column) -> Column:
    """By a double, unless the quotient is large or next to a half."""

    def rounded(q: Column) -> Column:
        beside_half = F.abs(F.abs(q - F.floor(q)) - 0.5)
        size = F.floor(q + 0.5).try_cast("decimal(20,0)") * F.lit(_NINTH)
        return F.when((F.abs(q) < 1e12) & (beside_half > 0.001), size.cast(NUMERIC))

    return _let(F.try_divide(n.cast("double"), d.cast("double")) * 1e9, rounded)


def _usual_ratio(n: Column, d: Column) -> Column:
    """The same for amounts below 10^17 and quotients below 10^19, else NULL.

    In billionths both have 26 digits at most, so the numerator has room for nine more.
    """

    def divided(p: Column) -> Column:
        whole = F.try_divide(p["wide"] - p["rest"], p["d"]).try_cast("decimal(28,0)")
        up = F.when(p["rest"] * 2 >= p["d"], 1).otherwise(0).cast("decimal(1,0)")
        size = ((whole + up).try_cast("decimal(28,0)") * F.lit(_NINTH)).cast("decimal(28,9)")
        return F.when((n < 0) != (d < 0), -size).otherwise(size).cast(NUMERIC)

    def rest(p: Column) -> Column:
        return _let(F.struct(p["wide"].alias("wide"), p["d"].alias("d"), (p["wide"] % p["d"]).alias("rest")), divided)

    wide = (_units_of(_narrow(n, *_AMOUNT)) * F.lit(Decimal(10**9))).cast("decimal(35,0)")
    return _let(F.struct(wide.alias("wide"), _units_of(_narrow(d, *_AMOUNT)).alias("d")), rest)


def _units_of(c: Column) -> Column:
    """The size of a decimal(26,9) in billionths."""
    return F.abs((c * F.lit(Decimal(10**9))).cast("decimal(26,0)"))


def _long_ratio(n: Column, d: Column) -> Column:
    """The same by long division of whole billionths: the whole part, then nine digits."""
    negative = ((n < 0) != (d < 0)).alias("negative")
    parts = F.struct(_billionths(n).alias("n"), _billionths(d).alias("d"), negative)

    def divided(p: Column) -> Column:
        rest = (p["n"] % p["d"]).cast(_UNITS).alias("rest")
        return _let(F.struct(p["n"].alias("n"), p["d"].alias("d"), rest, p["negative"].alias("negative")), _divided)

    return _let(_let(parts, divided), _ratio_of)


def _divided(p: Column) -> Column:
    """The rest of a whole division, and with it the nine digits that follow.

    All nine at once if a billion times the rest has 38 digits at most, else one by one.
    """

    def nine_digits(wide: Column) -> Column:
        digits = F.call_function("div", wide, p["d"])
        return F.struct((wide % p["d"]).cast(_UNITS).alias("rest"), digits.alias("digits"))

    def next_digit(state: Column) -> Column:
        # the product is NULL, never wrong, if it needs more than 38 digits
        tenfold = F.try_multiply(state["rest"], F.lit(Decimal(10))).try_cast(_UNITS)
        return F.struct(tenfold.alias("tenfold"), state["digits"].alias("digits"))

    def take(state: Column) -> Column:
        rest = state["tenfold"] % p["d"]
        digit = ((state["tenfold"] - rest) / p["d"]).cast("long")
        return F.struct(rest.cast(_UNITS).alias("rest"), (state["digits"] * 10 + digit).alias("digits"))

    start = F.struct(p["rest"].alias("rest"), F.lit(0).cast("long").alias("digits"))
    one_by_one = F.aggregate(F.sequence(F.lit(1), F.lit(9)), start, lambda s, _: _let(next_digit(s), take))
    wide = F.try_multiply(p["rest"], F.lit(Decimal(10**9))).try_cast(_UNITS)
    end = F.when(p["d"] < F.lit(Decimal(10**29)), _let(wide, nine_digits)).otherwise(one_by_one)
    whole = _let(F.try_divide(p["n"] - p["rest"], p["d"]), lambda q: _narrow(q, 28, 0))
    return F.struct(whole.alias("whole"), end.alias("end"), p["d"].alias("d"), p["negative"].alias("negative"))


def _ratio_of(p: Column) -> Column:
    """The rounded quotient of what ``_divided`` gives."""
    up = F.when(p["end"]["rest"] >= p["d"] - p["end"]["rest"], 1).otherwise(0)
    digits = (p["end"]["digits"] + up).cast("decimal(10,0)")
    return _amount(p["whole"], digits, p["negative"])


def _billionths(c: Column) -> Column:
    """The size of a decimal(38,9) as a whole number of billionths, of 38 digits at most.

    Spark's abs and unary minus keep 34 digits only, so signs are turned by subtraction.
    """

    def units(p: Column) -> Column:
        whole = (p["c"] - p["part"]).cast("decimal(29,0)")
        large = (whole * F.lit(Decimal(10**9))).cast(_UNITS)
        return (large + (p["part"] * F.lit(Decimal(10**9))).cast("decimal(10,0)")).cast(_UNITS)

    def size(units: Column) -> Column:
        return F.when(units < 0, F.lit(Decimal(0)) - units).otherwise(units).cast(_UNITS)

    c = c.try_cast(NUMERIC)
    parts = F.struct(c.alias("c"), (c % Decimal(1)).alias("part"))
    return _let(_let(parts, units), size)


def _amount(whole: Column, billionths: Column, negative: Column) -> Column:
    """Whole part of 28 digits at most, billionths and sign, as decimal(38,9)."""
    part = (billionths.cast("decimal(10,0)") * F.lit(_NINTH)).cast("decimal(10,9)")
    signed = F.when(negative, F.try_add(-whole, -part)).otherwise(F.try_add(whole, part))
    return signed.try_cast(NUMERIC)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Ratio where the denominator is above zero, else 0. A NULL numerator stays NULL."""
    # not under a condition, where the generated code would compute its parts again and again
    above = F.when(denominator > 0, denominator)
    return F.coalesce(ratio(numerator, above), F.when(above.isNull(), F.lit(0).cast(NUMERIC)))


def fill_zero(c: Column) -> Column:
    """0 in place of NULL."""
    return F.coalesce(c, F.lit(0))
