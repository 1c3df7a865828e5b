"""Row-key hashes that do not depend on partitioning, row order or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _md5_word(key: Column, salt: str, word: int) -> Column:
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return F.conv(F.substring(digest, 1 + 8 * word, 8), 16, 10).cast("bigint")


def md5_bucket(key: Column, modulus: int = 100, salt: str = "") -> Column:
    """Bucket 0..modulus-1 from the first 32 bits of ``md5(salt || key)``."""
    return _md5_word(key, salt, 0) % modulus


def md5_uniform(key: Column, salt: str = "", word: int = 0) -> Column:
    """A number strictly between 0 and 1 from one 32-bit word of ``md5(salt || key)``."""
    return (_md5_word(key, salt, word) + 1) / F.lit(4294967297.0)
