"""Row hashes that depend on key values only, so that a sample or a split is the
same for any partitioning and for a task that is run again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits of an MD5: every integer of the range is exact as a double.
HASH_RANGE = 1 << 52


def split_hash(keys: Sequence[Column | str], seed: int = 42, *salt: Column) -> Column:
    """Uniform integer in [0, 2^52) from the texts of seed, salt and key columns, by MD5,
    so that any engine can repeat it. A null key is the empty text."""
    parts = [F.lit(seed), *salt, *(F.col(k) if isinstance(k, str) else k for k in keys)]
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 13), 16, 10).cast("long")


def fraction_hash(keys: Sequence[Column | str], seed: int = 42, *salt: Column) -> Column:
    """Uniform double in [0, 1) from the key columns."""
    return split_hash(keys, seed, *salt) / F.lit(float(HASH_RANGE))
