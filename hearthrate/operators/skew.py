"""Size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hearthrate.session import SMALL_SIDE_BYTES, SMALL_SIDE_ROWS


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS, max_bytes: int = SMALL_SIDE_BYTES) -> tuple[DataFrame, bool]:
    """``df`` computed once, and whether it is small in rows and bytes.

    A small one comes back as a local relation. Any other stays cached where it
    was computed, so that the shuffle path does not compute it again. The driver
    never holds more than ``max_rows + 1`` rows.
    """
    held = df.persist()
    rows = held.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return held, False
    held.unpersist()
    return df.sparkSession.createDataFrame(rows, df.schema), True


def sized(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was measured to be small."""
    side, small = small_side(df, max_rows)
    return F.broadcast(side) if small else side


def lookup_join(
    facts: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left", max_rows: int = SMALL_SIDE_ROWS
) -> DataFrame:
    """Join a side with unique keys to a large table.

    A side measured to be small is broadcast. Any other is joined by shuffle,
    where adaptive execution splits a partition that one hot key inflates.
    """
    return facts.join(sized(side, max_rows), list(keys), how)
