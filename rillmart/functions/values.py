"""Casts, amounts and map columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(16,2)"


def amount(c: Column | str) -> Column:
    """Text to amount; null when it is no number."""
    return _col(c).try_cast(AMOUNT)


def amount_or_zero(c: Column | str) -> Column:
    return F.coalesce(amount(c), F.lit(0).cast(AMOUNT))


def whole(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def product_text(count: Column | str, price: Column | str) -> Column:
    """Count times price as text with four decimals, e.g. 3 x 19.9 = 59.7000."""
    return (amount(count) * amount(price)).cast("decimal(33,4)").cast("string")


def listed_only(data: Column | str, names_csv: Column | str) -> Column:
    """Keep the map entries whose key is in a comma separated list."""
    names = F.split(_col(names_csv), r"\s*,\s*")
    return F.map_filter(_col(data), lambda k, v: F.array_contains(names, k))


def names_of(names_csv: Column | str) -> Column:
    return F.split(F.trim(_col(names_csv)), r"\s*,\s*")


def upper_keys(data: Column | str) -> Column:
    """Map with upper-case keys, as dimension columns are named."""
    return F.transform_keys(_col(data), lambda k, v: F.upper(k))


def set_size(c: Column | str) -> Column:
    """Distinct members of an array column; null members do not count."""
    return F.size(F.array_distinct(F.array_compact(_col(c))))


def version_time(text: Column | str) -> Column:
    """Order of UTC timestamp texts whose fraction has any length, trailing Z or not."""
    return F.try_to_timestamp(F.regexp_replace(_col(text), "Z$", ""))


SEPARATOR, ESCAPE = "\x01", "\x02"


def packed(*names: str) -> Column:
    """Text columns as one text, which takes less room in a shuffle; see :func:`unpacked`."""
    def field(c: Column) -> Column:
        text = F.replace(F.replace(c, F.lit(ESCAPE), F.lit(f"{ESCAPE}a")), F.lit(SEPARATOR), F.lit(f"{ESCAPE}b"))
        return F.coalesce(text, F.lit(f"{ESCAPE}n"))

    return F.concat_ws(SEPARATOR, *(field(F.col(n)) for n in names))


def unpacked(c: Column | str, *names: str) -> list[Column]:
    """The columns of which :func:`packed` made one, as they were."""
    def field(x: Column) -> Column:
        text = F.replace(F.replace(x, F.lit(f"{ESCAPE}b"), F.lit(SEPARATOR)), F.lit(f"{ESCAPE}a"), F.lit(ESCAPE))
        return F.when(x != f"{ESCAPE}n", text)

    parts = F.split(_col(c), SEPARATOR, -1)
    return [field(parts[i]).alias(n) for i, n in enumerate(names)]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
