"""Scalar expressions over fleet columns. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix of an id and the digits it has at least.
DRIVER_ID = ("DRV_", 4)
ORDER_ID = ("ORD_", 6)
CUSTOMER_ID = ("CUST_", 6)
AREA_ID = ("AREA_", 3)

# Alert types and their texts.
HIGH_DELAY = "high_delay"
CANCELLATION = "cancellation"
UNKNOWN = "unknown"
HIGH_DELAY_TEXT = "🚨 High Delay: Order {order_id} - {delay_minutes} min"
CANCELLATION_TEXT = "❌ Cancellation: Order {order_id}"


def prefixed_id(prefix: str, number: Column, modulus: int | None = None) -> Column:
    """``prefix`` and the number, or its remainder, as text."""
    if modulus is not None:
        number = number % modulus
    return F.concat(F.lit(prefix), number.cast("string"))


def padded_id(form: tuple[str, int], number: Column) -> Column:
    """Zero-padded id such as ``DRV_0042``. Longer numbers are never cut; null stays null.

    Padding text costs a tenth of ``format_string``, which is left to negative numbers.
    """
    prefix, digits = form
    text = number.cast("string")
    padded = F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))
    return F.when(number < 0, F.format_string(f"{prefix}%0{digits}d", number)).otherwise(
        F.concat(F.lit(prefix), padded)
    )


def status_by_remainder(number: Column) -> Column:
    """Delivery status from a running number: 0 delivered, 1 in transit, else picked up."""
    rest = number % 3
    return F.when(rest == 0, "delivered").when(rest == 1, "in_transit").otherwise("picked_up")


def rescaled(fraction: Column, base: float, span: float) -> Column:
    """``base + fraction * span``."""
    return F.lit(base) + fraction * F.lit(span)


def rescaled_around(fraction: Column, centre: float, span: float) -> Column:
    """``centre + (fraction - 0.5) * span``."""
    return F.lit(centre) + (fraction - F.lit(0.5)) * F.lit(span)


def minutes_after(time: Column, minutes: Column) -> Column:
    return time + F.make_dt_interval(mins=minutes)


def minutes_before(time: Column, minutes: Column) -> Column:
    return time - F.make_dt_interval(mins=minutes)


def point(lat: Column, lng: Column) -> Column:
    return F.struct(lat.alias("lat"), lng.alias("lng"))


def to_one_decimal(number: Column) -> Column:
    """Rounded half up to one decimal."""
    return F.round(number, 1)


def mean_or_zero(mean: Column) -> Column:
    """A mean to one decimal; no rows give 0."""
    return F.coalesce(to_one_decimal(mean), F.lit(0.0))


def alert_type(value: Column) -> Column:
    """The alert type in a JSON value, ``unknown`` when absent."""
    return F.coalesce(F.get_json_object(value, "$.anomaly_type"), F.lit(UNKNOWN))


def _filled(text: str) -> Column:
    """A text with ``{column}`` places; null when a column it names is null."""
    parts = []
    for piece in text.split("{"):
        name, closed, rest = piece.partition("}")
        parts += [F.col(name).cast("string"), F.lit(rest)] if closed else [F.lit(piece)]
    return F.concat(*parts)


def alert_message(kind: Column) -> Column:
    """The line shown for an alert. Other types, or missing fields, give null."""
    return F.when(kind == HIGH_DELAY, _filled(HIGH_DELAY_TEXT)).when(
        kind == CANCELLATION, _filled(CANCELLATION_TEXT)
    )
