"""Reproducible splits, folds and samples from a hash of the row key.

A row's side depends on its key alone, so it survives repartitioning, retries
and added rows, and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEED = 42
# 13 hex digits are 52 bits: exact in a double.
HASH_DIGITS = 13


def key_digest(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def key_number(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 2**52) drawn from the key."""
    return F.conv(F.substring(key_digest(key, seed), 1, HASH_DIGITS), 16, 10).cast("long")


def hex_cut(share: float) -> str:
    """First eight hex digits at which the given share of the hash space ends."""
    return f"{int(share * 0x100000000):08x}"


def split_side(key: Column, test_share: float = 0.2, seed: int = SEED) -> Column:
    head = F.substring(key_digest(key, seed), 1, 8)
    return F.when(head < hex_cut(test_share), "test").otherwise("train")


def fold_of(key: Column, folds: int, seed: int = SEED) -> Column:
    """Shuffled fold number 0..folds-1 by hash range, from one digest."""
    head = F.conv(F.substring(key_digest(key, seed), 1, 8), 16, 10).cast("long")
    return F.floor(head * folds / F.lit(float(0x100000000))).cast("int")
