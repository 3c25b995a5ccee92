"""Helpers shared by the operators: reading tables, Arrow blocks, ragged arrays, written stages."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.sources.scratch import new_scratch, release_shuffles

# Bytes of text that one vectorised step works on at a time.
BLOCK_BYTES = 8 << 20


def importable(spark: SparkSession) -> None:
    """Let tasks import this package where it is not installed but lies in a folder that the executors see too."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The frame, written once to the folder all executors share and read again.

    What follows reads the files, so a lost executor costs no recomputation
    and the lineage ends here.
    """
    spark = df.sparkSession
    path = folder or new_scratch(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, longer by as many underscores as keep it apart from the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark: SparkSession, *used: DataFrame) -> None:
    """Give up ``written`` frames that are not read again, and shuffle files that nothing refers to any more."""
    for frame in used:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()[:1]}:
            spark.createDataFrame([], frame.schema).write.mode("overwrite").parquet(folder)
    release_shuffles(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@functools.cache
def _freeze() -> None:
    gc.freeze()


def give_back() -> None:
    """Return freed memory to the system: a Python worker waits for its next task with all it ever held.

    What a worker holds at its first call, mostly imported modules, is not searched for garbage again.
    """
    gc.collect()
    _freeze()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def least_hashed(df: DataFrame, hashed: Column, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes, from a column of hashes that are nearly all different.

    The rows are counted and cut to about the share wanted first, so what the tasks send for sorting grows
    with ``rows`` and not with their number.
    """
    place, count = F.pmod(hashed, F.lit(1 << 40)), df.count()
    if count > 2 * rows:
        df = df.where(place < int((1 << 40) * (1.3 * rows + 50) / count))
    return df.orderBy(place, *df.columns[:1]).limit(rows)


def within_bytes(sizes: DataFrame, key: str, size: str, most: int) -> DataFrame:
    """The keys of a bounded sample, in their order, as long as the sizes together are at most ``most``.

    A row of over a sixteenth of that is left out, so that a single one cannot take the place of all others.
    """
    fitting = sizes.where(F.coalesce(F.col(size), F.lit(0)) <= most // 16)
    before = F.sum(F.coalesce(F.col(size), F.lit(0))).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return fitting.withColumn("__sum", before).where(F.col("__sum") <= most).select(key)


def plain_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as one array with 64-bit offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES
                ) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``max_bytes`` of text, or of one row; freed memory goes back after each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + max_bytes, side="right")), first + 1)
            yield batch.slice(first, last - first)
            give_back()
            first = last


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a ``plain_text`` array, and the offsets where its rows start and end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def take_ragged(flat: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the rows ``index`` of a ragged array; returns their values and offsets."""
    starts = offsets[index]
    lengths = offsets[index + 1] - starts
    out = np.zeros(len(index) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    where = np.repeat(starts - out[:-1], lengths)
    where += np.arange(out[-1])
    return flat[where], out


def words_of(texts: pa.Array, separator: str = " ") -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Split at a separator: the code of every piece, the distinct pieces, and the offsets of the rows."""
    split = pc.split_pattern(texts, separator)
    pieces = split.flatten().dictionary_encode()
    offsets = np.asarray(split.offsets.to_numpy(zero_copy_only=False), np.int64)
    return np.asarray(pieces.indices), pieces.dictionary, offsets - offsets[0]


def ragged_rows(flat: np.ndarray, starts: np.ndarray, codes: np.ndarray, offsets: np.ndarray, step: int = 1 << 19
                ) -> Iterator[np.ndarray]:
    """The values of each row, a row being ``codes[offsets[i]:offsets[i + 1]]`` and a code a row of (flat, starts).

    Some rows, of about ``step`` codes together, are put together at a time, so the
    gathered arrays stay small.
    """
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(int(np.searchsorted(offsets, offsets[first] + step, side="right")) - 1, first + 1)
        values, ends = take_ragged(flat, starts, codes[offsets[first]:offsets[last]])
        cuts = ends[offsets[first:last + 1] - offsets[first]]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield values[a:b]
        first = last
