"""Materialising intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

_held: dict[str, tuple] = {}


class Shared:
    """A broadcast value and what each worker process makes of it, once."""

    def __init__(self, df: DataFrame, kind: str, value):
        self.kind, self.token = kind, uuid.uuid4().hex
        self.broadcast = df.sparkSession.sparkContext.broadcast(value)

    def get(self, make: Callable = lambda value: value):
        """``make(value)``, kept in this worker until another ``Shared`` of its kind is read."""
        if _held.get(self.kind, ("",))[0] != self.token:
            _held[self.kind] = (self.token, make(self.broadcast.value))
        return _held[self.kind][1]


def drop_held(*kinds: str) -> None:
    """Forget what this worker process made of ``Shared`` values of some kinds."""
    for kind in kinds:
        _held.pop(kind, None)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Lineage ends at the written files, so a lost executor costs re-reading them.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """A column by its exact name (names may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def partitions(df: DataFrame) -> int:
    """The session's shuffle partition count."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if a count proves it has at most ``rows`` rows, else ``df``.

    Both ways give the same join result; beyond the bound the join shuffles.
    """
    return F.broadcast(df) if df.count() <= rows else df
