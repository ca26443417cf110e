"""Semi, anti and lookup joins against a key list that grows with the universe.

The small side is computed once: its keys are written to the shared checkpoint
folder and counted there. Up to a bound they are broadcast. Beyond it the
join shuffles, and a filter of the keys (a blocked Bloom filter made of public
bit functions: one 64-bit word per block, a few bits of it per key) is
broadcast first, so that only rows that may match are shuffled. Beyond the
filter's own bound the join is left to the planner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from equitylake.session import checkpoint_root

# A listing universe is ~10^4 symbols; a million keys of one short string
# is still a few tens of MB on every executor.
MAX_BROADCAST_KEYS = 1_000_000
#: Keys to a 64-bit word of the filter, and bits each key sets: about one row in 25 that matches nothing passes.
KEYS_PER_WORD = 4
BITS_PER_KEY = 3
#: Words of a filter that is still broadcast (16 bytes each): 16 million keys.
MAX_FILTER_WORDS = 4_000_000


def once(df: DataFrame) -> DataFrame:
    """``df`` computed now, into the shared checkpoint folder; what is read from the result does not compute it again."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``once`` with the number of rows, which the same job counts."""
    rows = Observation()
    held = once(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    return held, rows.get["rows"]


def _block(keys: Sequence[Column], words: int) -> tuple[Column, Column]:
    """(word, bits of it) of a key."""
    h = F.xxhash64(*keys)
    bits = F.lit(0).cast("bigint")
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS_PER_KEY), F.lit(words)), bits


def may_match(big: DataFrame, keys: DataFrame, on: Sequence[str], n_keys: int) -> DataFrame:
    """Rows of ``big`` whose key may be among ``keys``: all that are, and a few that are not."""
    words = max(1, -(-n_keys // KEYS_PER_WORD))
    word, bits = _block([F.col(f"`{c}`") for c in on], words)
    held = keys.groupBy(word.alias("__word")).agg(F.bit_or(bits).alias("__held"))
    probed = big.withColumn("__word", word).withColumn("__bits", bits).join(F.broadcast(held), "__word")
    return probed.where(F.col("__held").bitwiseAND(F.col("__bits")) == F.col("__bits")).drop("__word", "__bits", "__held")


def _joined(big: DataFrame, small: DataFrame, on: Sequence[str], how: str, max_rows: int, known_rows: int | None) -> DataFrame:
    if known_rows is None:
        small, known_rows = counted(small)
    if known_rows <= max_rows:
        return big.join(F.broadcast(small), on=on, how=how)
    if how != "left_anti" and known_rows <= MAX_FILTER_WORDS * KEYS_PER_WORD:
        big = may_match(big, small.select(*on), on, known_rows)
        if how == "left_semi":  # as an inner join, since Spark would push a semi join below the filter's
            small, how = small.distinct(), "inner"
    return big.join(small, on=on, how=how)


def _names(on: Sequence[str] | str) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def semi_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str = "symbol",
              max_broadcast_rows: int = MAX_BROADCAST_KEYS, known_rows: int | None = None) -> DataFrame:
    """Rows of ``big`` whose key appears in ``small`` (JN1, JN2, FLT10).

    ``known_rows``: the caller's own count, for a ``small`` that is cheap to
    read again (computed already).
    """
    on = _names(on)
    return _joined(big, small.select(*on), on, "left_semi", max_broadcast_rows, known_rows)


def anti_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str = "symbol",
              max_broadcast_rows: int = MAX_BROADCAST_KEYS, known_rows: int | None = None) -> DataFrame:
    """Rows of ``big`` whose key is absent from ``small`` (JN3)."""
    on = _names(on)
    return _joined(big, small.select(*on), on, "left_anti", max_broadcast_rows, known_rows)


def attach(big: DataFrame, small: DataFrame, on: Sequence[str] | str = "symbol",
           max_broadcast_rows: int = MAX_BROADCAST_KEYS, known_rows: int | None = None) -> DataFrame:
    """Inner join that adds ``small``'s columns to matching ``big`` rows.

    ``small`` must be unique on ``on`` (a lookup), so no row is multiplied.
    """
    return _joined(big, small, _names(on), "inner", max_broadcast_rows, known_rows)
