"""Joins with a dimension too large to broadcast, laid out by its key once.

``lay_out`` writes a dimension as a bucketed, sorted table. A join on its key
then reads the buckets where they lie: only the other side is shuffled, and every later join with that
dimension (the process, the orphan audit) saves the same shuffle again.

A bucketed side cannot be split by AQE, so hot keys are kept out of that join. A key with more than one in
``HOT_SHARE`` of the rows is hot, so there are fewer than ``HOT_SHARE`` of them whatever the size of the table; their
dimension rows are broadcast. Rows with a hot or null key go to the bucketed join under a
spread-out key instead, and take what they carry from the broadcast or stay without.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.gates import DuplicateKeyError

HOT_SHARE = 2000
BUCKET_BYTES = 128 << 20


@dataclass(frozen=True)
class LaidOut:
    """A dimension in the catalog, bucketed by its key."""

    table: str
    key: str

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


def lay_out(dimension: DataFrame, key: str, table: str, path: str, size: int = 0, buckets: int | None = None) -> LaidOut:
    """Write a dimension with unique keys as a table of buckets, sorted by key; ``size`` are its counted bytes.

    There are at least as many buckets as the session has shuffle partitions, so no join needs to deal it anew.
    """
    spark = dimension.sparkSession
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    # Shuffled by the buckets' own hash first: a task writes one file.
    rows = dimension.where(F.col(key).isNotNull()).repartition(buckets, key)
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    return LaidOut(table, key)


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys held by more than one in ``share`` of the rows: fewer than ``share`` of them, as a frame of one column.

    One pass, pre-aggregated in every task.
    """
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > F.lit(rows.count() // share)).select(key)


def join_laid_out(rows: DataFrame, dimension: LaidOut, column: str, marker: str, hot: DataFrame,
                  attributes: Mapping[str, str] | None = None) -> DataFrame:
    """The rows with ``marker``, the dimension's key or null where it does not exist, and dimension columns.

    ``attributes`` maps new names to columns of the dimension. ``hot`` comes from ``hot_keys``. Rows of hot and null keys
    are spread by a hash of all their columns, the same after a retry, so a column that tells rows apart should be among them.
    """
    clash = {marker, *(attributes or {})} & set(rows.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    carried = {marker: dimension.key, **(attributes or {})}
    held = dimension.frame(rows.sparkSession)
    keys = hot.select(F.col(hot.columns[0]).alias("__hot"))
    # The hot keys' rows of the dimension: fewer than the share, so they are broadcast.
    warm = F.broadcast(keys.join(held, F.col("__hot") == F.col(dimension.key), "left").select(
        "__hot", F.struct(*[F.col(s).alias(n) for n, s in carried.items()]).alias("__warm")))
    marked = rows.join(warm, F.col(column) == F.col("__hot"), "left")

    aside = F.col("__hot").isNotNull() | F.col(column).isNull()
    # No order of a hot or null key may meet a bucket's rows, so what it matches there by chance is not taken.
    spread = F.when(aside, F.xxhash64(*rows.columns)).otherwise(F.col(column))
    cold = held.select(F.col(dimension.key).alias("__key"), F.struct(*[F.col(s).alias(n) for n, s in carried.items()]).alias("__cold"))
    joined = marked.withColumn("__spread", spread).withColumn("__aside", aside).join(cold, F.col("__spread") == F.col("__key"), "left")

    def taken(name: str) -> Column:
        return F.when(F.col("__aside"), F.col("__warm")[name]).otherwise(F.col("__cold")[name]).alias(name)

    return joined.select(*rows.columns, *[taken(n) for n in carried])


def require_unique(dimension: DataFrame, key: str) -> None:
    """Raise if a key repeats; the rows are counted in one aggregate."""
    repeated = dimension.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"key {repeated[0][0]} occurs {repeated[0]['n']} times: the join would multiply rows")
