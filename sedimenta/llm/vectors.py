"""Vectors that take part in comparisons, each id once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): one row for each id, without vectors that are null, empty, zero or hold null or non-finite parts.

    The parts are doubles. An id with several vectors keeps the smallest of
    them. Rows without an id are left out. Nothing else is read.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) if len(column) else np.zeros((0, 0))
