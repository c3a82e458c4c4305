"""A projection whose costly columns are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns (replacing equal names) that later filters do not repeat.

    A filter on a projected column is normally pushed below the projection and
    carries a copy of its expression for each mention; with chains of patterns
    that multiplies the work. The columns come out of a one-row generator
    instead, which a filter on them cannot pass.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[v.alias(k) for k, v in columns.items()])
    return df.select(*kept, F.explode(F.array(row)).alias("_step")).select(*kept, "_step.*")


def must(df: DataFrame, holds: Column, message: Column) -> DataFrame:
    """All rows; one for which ``holds`` is not true fails the job, whatever columns are read.

    The random part, which is always true, keeps the optimizer from moving the
    test below a join or evaluating it on made-up rows.
    """
    return df.where(F.when(holds, F.rand() >= 0).otherwise(F.raise_error(message).cast("boolean")))
