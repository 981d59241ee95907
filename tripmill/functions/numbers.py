"""Number and text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.schema import COLOR_DOWN, COLOR_UP, CREDIT_PRICE_USD, RPU_HOUR_PRICE_USD


def percent_change(current: Column, base: Column) -> Column:
    """(current - base) / base in percent; NULL when the base is 0 or NULL."""
    return F.try_divide((current - base).cast("double"), base.cast("double")) * 100


def percent_text(current: Column, base: Column, digits: int = 1) -> Column:
    """``1,234.5%`` or ``N/A``."""
    change = percent_change(current, base)
    return F.coalesce(F.concat(F.format_number(change, digits), F.lit("%")), F.lit("N/A"))


def arrow_percent_text(current: Column, base: Column) -> Column:
    """An up or down mark before the change, without thousands separators; or ``N/A``."""
    change = percent_change(current, base)
    mark = F.when(change >= 0, "\U0001f53c").otherwise("\U0001f53d")
    # A number format rounds ties to even, where format_string would round them up.
    text = F.concat(mark, F.lit(" "), F.call_function("format_number", change, F.lit("0.0")), F.lit("%"))
    return F.when(change.isNull(), "N/A").otherwise(text)


def difference_color(difference: Column) -> Column:
    return F.when(difference < 0, COLOR_DOWN).otherwise(COLOR_UP)


def safe_decimal(value: Column) -> Column:
    return F.coalesce(value.try_cast("decimal(38,10)"), F.lit(0).cast("decimal(38,10)"))


def money(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(18,2)")


def credit_usd(credits: Column, price: str = CREDIT_PRICE_USD) -> Column:
    return F.round(credits * F.lit(price).cast("double"), 4)


def usage_usd(seconds: Column, price: str = RPU_HOUR_PRICE_USD) -> Column:
    """Dollars for seconds at an hourly price.

    Seconds are sums of even shares; cutting their last digits first keeps the order of
    summation from deciding a tie.
    """
    return F.round(F.round(seconds, 9) * F.lit(price).cast("double") / 3600, 4)


def match_status(left: Column, right: Column) -> Column:
    """A count missing on one side is a mismatch."""
    return F.when(left == right, "MATCH").otherwise("MISMATCH")
