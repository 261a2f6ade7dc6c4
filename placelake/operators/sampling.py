"""Splitting rows into training and test sets, and looking at a few."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of training rows and seed of the split.
TRAIN_SHARE = 0.7
SEED = 24


def in_training(key: Iterable[str] | str, share: float = TRAIN_SHARE, seed: int = SEED) -> Column:
    """Whether a row falls in the training share, by a digest of its key.

    The same rows whatever the partitioning or session. The key should identify a row; all
    rows of one key go the same way, those without a key included.
    """
    if not 0 < share < 1:
        raise ValueError(f"share lies between 0 and 1, not {share}")
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, 8) < f"{int(share * 16**8):08x}"


def train_test_split(df: DataFrame, key: Iterable[str] | str, share: float = TRAIN_SHARE,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Split rows by ``in_training``."""
    training = in_training(key, share, seed)
    return df.where(training), df.where(~training)


def random_split(df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split; which rows it draws depends on how the frame is partitioned."""
    first, second = df.randomSplit([share, 1 - share], seed)
    return first, second


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
