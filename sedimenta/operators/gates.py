"""Checks that fail a run, and the measured size of the dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.sources.scratch import new_scratch

# A dimension up to this many counted bytes is sent whole to every executor.
BROADCAST_LIMIT = 128 << 20
# About what a row and a text cost in a hash relation beside their own bytes.
ROW_OVERHEAD, TEXT_OVERHEAD = 32, 16


class DuplicateKeyError(ValueError):
    """A dimension holds a key more than once, so a join would multiply rows."""


class JoinLossError(ValueError):
    """A join with the dimensions changed the number of rows."""


class ReconciliationError(RuntimeError):
    """Raw rows are not exactly the silver rows plus the quarantined rows."""


@dataclass(frozen=True)
class Dimension:
    """A frame to join with, whose size in memory has been counted."""

    frame: DataFrame
    rows: int
    bytes: int

    def fits(self, broadcast_limit: int) -> bool:
        return self.bytes <= broadcast_limit

    def sized_for_join(self, broadcast_limit: int) -> DataFrame:
        """The frame, marked for broadcast only if its counted bytes are within the limit.

        Beyond it Spark shuffles both sides, and AQE splits the hot keys.
        """
        return F.broadcast(self.frame) if self.fits(broadcast_limit) else self.frame


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys held by more than one row, with their counts. Nulls count as one key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("ocorrencias")).where("ocorrencias > 1")


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(ROW_OVERHEAD).cast("long")
    for column in df.schema:
        is_text = isinstance(column.dataType, T.StringType)
        size = size + (F.coalesce(F.octet_length(column.name), F.lit(0)) + TEXT_OVERHEAD if is_text else F.lit(8))
    return size


def _profile(name: str, df: DataFrame, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("tamanho"),
        F.max("n").alias("maior"),
        F.max_by(F.col(key).cast("string"), "n").alias("chave"),
    ).select(F.lit(name).alias("dimensao"), "linhas", "tamanho", "maior", "chave")


def measure_dimensions(**dimensions: tuple[DataFrame, str]) -> dict[str, Dimension]:
    """Count rows and bytes of each ``name=(frame, key)`` and raise if one repeats a key.

    One job and one result row per dimension, whatever their size.
    """
    profiles = reduce(DataFrame.unionByName, [_profile(n, df, key) for n, (df, key) in dimensions.items()])
    measured = {}
    for row in profiles.collect():
        if row.maior is not None and row.maior > 1:
            raise DuplicateKeyError(f"key {row.chave} occurs {row.maior} times in dimension {row.dimensao}: "
                                    "the join would multiply rows")
        measured[row.dimensao] = Dimension(dimensions[row.dimensao][0], row.linhas, row.tamanho)
    return measured


def key_lookups(broadcast_limit: int, distinct: bool = True, **dimensions: tuple[DataFrame, str]) -> list[DataFrame]:
    """The keys of each ``name=(frame, key)``, distinct or as they come, marked for broadcast if their counted bytes fit the limit.

    Keys that are unique already are used as they are. Repeated ones beyond
    the limit are made distinct in a table of their own: an aggregate between
    the exchange and the join would keep AQE from splitting the hot keys of the other side.
    """
    keys = {name: df.select(key) for name, (df, key) in dimensions.items()}
    profiles = [
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.lit(1)).alias("linhas"),
            F.coalesce(F.sum(_row_bytes(df) * (1 if distinct else F.col("n"))), F.lit(0)).alias("tamanho"),
            F.coalesce(F.max("n"), F.lit(0)).alias("maior")).select(F.lit(name).alias("dimensao"), "*")
        for name, df in keys.items()]
    lookups = {}
    for row in reduce(DataFrame.unionByName, profiles).collect():
        repeated = distinct and row.maior > 1
        frame = keys[row.dimensao].distinct() if repeated else keys[row.dimensao]
        if repeated and row.tamanho > broadcast_limit:
            path = new_scratch(frame.sparkSession)
            frame.write.parquet(path)
            frame = frame.sparkSession.read.schema(frame.schema).parquet(path)
        lookups[row.dimensao] = Dimension(frame, row.linhas, row.tamanho).sized_for_join(broadcast_limit)
    return [lookups[name] for name in keys]


def require_join_conserved(rows_before: int, rows_after: int) -> None:
    if rows_before != rows_after:
        raise JoinLossError(f"the dimension joins changed the row count from {rows_before} to {rows_after}")


def require_reconciled(raw: int, silver: int, rejected: int) -> None:
    if raw != silver + rejected:
        raise ReconciliationError(f"raw={raw} != silver={silver} + quarantine={rejected}")
