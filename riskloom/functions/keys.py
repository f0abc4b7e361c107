"""Key hashes: the same row gets the same bucket whatever the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PORTABLE_RANGE = 2**32
WIDE_RANGE = 2**62


def _columns(keys: str | Sequence[str]) -> list[Column]:
    return [F.col(name) for name in ([keys] if isinstance(keys, str) else keys)]


def portable_bucket(keys: str | Sequence[str], salt: str = "") -> Column:
    """First 32 bits of an MD5 over the keys: the same number in any engine."""
    parts = [column.cast("string") for column in _columns(keys)]
    text = F.concat_ws("|", F.lit(salt), *parts) if salt or len(parts) > 1 else parts[0]
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def key_bucket(keys: str | Sequence[str], salt: str = "") -> Column:
    """62-bit bucket from Spark's own hash, cheaper than MD5."""
    parts = _columns(keys)
    hashed = F.xxhash64(F.lit(salt), *parts) if salt else F.xxhash64(*parts)
    return F.pmod(hashed, F.lit(WIDE_RANGE))


def fold_id(keys: str | Sequence[str], folds: int, portable: bool = False) -> Column:
    """Fold number 0 .. folds-1."""
    if portable:
        return F.pmod(portable_bucket(keys), F.lit(folds))
    return F.pmod(F.xxhash64(*_columns(keys)), F.lit(folds))


def keep_fraction(
    keys: str | Sequence[str], fraction: Column | float, salt: str = "", portable: bool = False
) -> Column:
    """True for about ``fraction`` of the keys, always the same ones."""
    share = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    if portable:
        return portable_bucket(keys, salt) < share * F.lit(float(PORTABLE_RANGE))
    return key_bucket(keys, salt) < share * F.lit(float(WIDE_RANGE))
