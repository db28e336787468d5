"""Samples of a fixed size that depend on the rows alone, not on how they are dealt to tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def draw(key: Sequence[str], seed: int) -> Column:
    """Place of a row in the draw: sha256, in hex, of the seed and the key values, a null written as ``null``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in key]
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *parts), 256)


def capped_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 42, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the lowest draw, of all or of each class ``by``; fewer where there are fewer.

    ``key`` must tell rows apart, or which of equal ones are taken is open.  Every task keeps its n lowest rows of each
    class before any row is moved, so a class that holds most rows is no heavier than another.
    """
    if not key or n < 0:
        raise ValueError("a sample needs a key and a size")
    drawn = df.withColumn("_draw", draw(key, seed))
    if not by:
        return drawn.orderBy("_draw", *key).limit(n).drop("_draw")
    place = F.row_number().over(W.partitionBy(*by).orderBy("_draw", *key))
    return drawn.withColumn("_place", place).where(F.col("_place") <= n).drop("_draw", "_place")
