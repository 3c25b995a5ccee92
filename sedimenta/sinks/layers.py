"""Writers of one date of a layer table, and of audit reports.

Each write replaces the folder ``table/partition=value``. Dynamic partition
overwrite would leave the old rows in place when the new result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.config import PipelineConfig
from sedimenta.functions.numeric import safe_number
from sedimenta.schemas import QUARANTINE, RAW_LINE, LayerTable
from sedimenta.sinks.folders import join_parts

WRITE_OPTIONS = {
    "csv": {
        "header": "true", "lineSep": "\n", "encoding": "UTF-8", "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    },
    "json": {"ignoreNullFields": "false", "lineSep": "\n", "encoding": "UTF-8"},
    "parquet": {"compression": "snappy"},
}
RAW_TEXT_COLUMN = "quantidade_raw"


def write_partition(df: DataFrame, cfg: PipelineConfig, table: LayerTable) -> str:
    """Replace the configured date of a table; other dates stay as they are."""
    path = cfg.partition_path(table)
    if table.format == "csv" and not cfg.multi_line:
        df = df.select(*[_one_line(f) for f in df.schema])
    df.write.mode("overwrite").options(**WRITE_OPTIONS[table.format]).format(table.format).save(path)
    return path


def _one_line(field: T.StructField) -> Column:
    """The column, which fails the write if a text of it holds a line break: no reader by lines could read it back."""
    value = F.col(field.name)
    if not isinstance(field.dataType, T.StringType):
        return value
    message = F.concat(F.lit(f"line break in {field.name}: "), F.left(value, F.lit(100)))
    return F.when(F.contains(value, F.lit("\n")) | F.contains(value, F.lit("\r")), F.raise_error(message)).otherwise(value).alias(field.name)


def quarantine_projection(rejected: DataFrame, raw_text: bool = True) -> DataFrame:
    """Rejected rows in the quarantine schema. A quantity that is no whole number becomes
    one or null there; ``raw_text`` keeps it as read in a further column, and the whole
    line in another where the rows carry it."""
    quantity = safe_number("quantidade", rejected.schema["quantidade"].dataType).try_cast("long")
    columns = [quantity.alias(f.name) if f.name == "quantidade" else F.col(f.name).cast(f.dataType)
               for f in QUARANTINE]
    if raw_text:
        columns.append(F.col("quantidade").cast("string").alias(RAW_TEXT_COLUMN))
        if RAW_LINE in rejected.columns:
            columns.append(F.col(RAW_LINE))
    return rejected.select(*columns)


def write_report(report: DataFrame, base_uri: str, title: str) -> str:
    """One audit result as ``reports/<title>.csv``, and as Spark writes it under ``reports/<title>``.

    The single file is put together from the parts in their order, with one header, beside its place, and then takes it by
    a rename: a reader finds the old report or the new one. The bytes go from file to file without being parsed.
    """
    path = f"{base_uri.rstrip('/')}/reports/{title or 'resultado'}"
    report.write.mode("overwrite").options(**WRITE_OPTIONS["csv"]).csv(path)
    header = ",".join(report.columns).encode() + b"\n"
    join_parts(report.sparkSession, path, f"{path}.csv", header)
    return f"{path}.csv"
