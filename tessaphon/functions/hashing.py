"""Random draws from a seed, a purpose and a row's key: the same at any parallelism."""

from pyspark.sql import functions as F


def digest(seed, purpose: str, *key):
    """Hex digest that orders rows at random."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), *(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key)).cast("binary"))


def draw(seed, purpose: str, low: int, count, *key):
    """An integer of ``count`` values from ``low`` on (count: number or column)."""
    number = F.conv(F.substring(digest(seed, purpose, *key), 1, 8), 16, 10).cast("long")
    return F.lit(low) + F.pmod(number, count if not isinstance(count, int) else F.lit(count))
