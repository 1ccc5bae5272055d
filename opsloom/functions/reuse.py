"""Keep a small intermediate table that one plan reads several times.

Only tables already reduced by an aggregation are kept. They spill to disk when memory is
short, and a lost executor's part is recomputed from its lineage.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_kept: list[DataFrame] = []


def shared(df: DataFrame) -> DataFrame:
    _kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return _kept[-1]


def release() -> None:
    """Free everything kept so far; call it when the results have been read."""
    while _kept:
        _kept.pop().unpersist()
