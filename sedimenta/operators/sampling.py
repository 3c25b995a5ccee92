"""An exact number of rows, drawn without replacement from a table of any size.

Every row has a key: the hash of its values, then the hash of its place, which
parts equal rows. The ``k`` smallest keys are drawn. They are found without a sort or row numbers: a
histogram of the first 16 bits of all keys shows in which bin the k-th lies, a histogram of the next 16 bits inside that
bin narrows it, and so on until a bin ends exactly there. Two passes do for some 10^9 rows and one more for each factor
of 65,536. The sample itself is then a filter over the scan: no row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_BITS = 16
KEY_BITS = 48


def value_hash(df: DataFrame, seed: int, *columns: str) -> Column:
    """The first 48 bits of the md5 of the seed and the columns as text; a null is an empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns or df.columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def place_hash(seed: int) -> Column:
    """48 bits that differ for the rows of a file scan and are the same whenever it is read again."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("_metadata.file_path"), F.col("_metadata.row_index")), F.lit(1 << KEY_BITS))


def exact_sample(df: DataFrame, k: int, value: Column, place: Column) -> DataFrame:
    """Exactly ``min(k, rows)`` rows of a frame that is the same whenever it is read, by the smallest (value, place).

    Both are numbers of 48 bits. What the driver sees are histograms of at most 65,536 bins.
    """
    if k <= 0:
        return df.where(F.lit(False))
    chosen, left, within = F.lit(False), k, F.lit(True)
    for part in (value, place):
        for shift in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
            step = F.shiftright(part, shift).bitwiseAND((1 << STEP_BITS) - 1)
            bins = df.where(within).groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
            cutoff, below = None, 0
            for bin_, n in sorted((b.bin, b.n) for b in bins):
                if below + n > left:
                    cutoff = bin_
                    break
                below += n
            if cutoff is None:  # the last bin ends within the sample
                return df.where(chosen | within)
            chosen, left = chosen | (within & (step < cutoff)), left - below
            if not left:
                return df.where(chosen)
            within = within & (step == cutoff)
    raise ValueError(f"over {left} rows have one value and one place, so no {k} rows can be told apart")
