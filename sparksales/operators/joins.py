"""Equi join of a large relation with a much smaller staged one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .staging import staged_bytes

BROADCAST_BYTES = 8 * 1024 * 1024
REPEATED_BYTES = 64 * 1024**3
MOST_SALTS = 32


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    repeated_bytes: int = REPEATED_BYTES,
) -> DataFrame:
    """Join ``lookup`` (from ``stage_lookup``) onto ``big`` without moving a hot key to one task.

    * ``lookup`` is broadcast when its files hold at most ``broadcast_bytes``.
    * Beyond that it is repeated once per salt, and each row of ``big`` picks a salt
      from a hash of ``spread_by``, so one key's rows spread over that many tasks.
      The salt is a function of the row: a retried task picks the same one. The
      copies together stay within ``repeated_bytes``.
    * A lookup too large even for two copies is joined as it is; adaptive execution
      splits the partitions of hot keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    size = staged_bytes(lookup)
    if size <= broadcast_bytes:
        return big.join(F.broadcast(lookup), keys, how)
    salts = min(MOST_SALTS, repeated_bytes // max(size, 1))
    if salts < 2:
        return big.join(lookup.hint("merge"), keys, how)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    repeated = lookup.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return big.withColumn("salt", salt).join(repeated.hint("merge"), [*keys, "salt"], how).drop("salt")
