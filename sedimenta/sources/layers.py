"""Scans of one date of a layer table, always with the declared schema."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.config import PipelineConfig
from sedimenta.functions.numeric import whole_number
from sedimenta.schemas import GOLD_SKETCHES, NA_STRINGS, PEDIDOS_TEXT, RAW_LINE, RAW_PEDIDOS, LayerTable
from sedimenta.sinks.versions import published_path

# Quotes are doubled inside quoted fields, and blanks belong to the value. A header that
# does not match the schema fails the scan instead of shifting columns.
FIELD_OPTIONS = {
    "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
CSV_OPTIONS = FIELD_OPTIONS | {"header": "true", "encoding": "UTF-8", "enforceSchema": "false"}


CORRUPT = "_corrupt_record"


class MalformedLineError(ValueError):
    """A dimension holds a line that its schema cannot take."""


def text_schema(schema: T.StructType, doubles: bool = True) -> T.StructType:
    """The columns as a scan reads them: keys as text, and doubles too unless they stay numbers."""
    kinds = (T.LongType,) if doubles else (T.LongType, T.DoubleType)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, kinds) else f.dataType)
                         for f in schema])


def _raw_column(field: T.StructField, blank_missing: bool) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.LongType):
        value = whole_number(field.name)
    elif isinstance(field.dataType, T.DoubleType):
        # NaN compares as larger than infinity.
        value = F.when(F.abs(value) < float("inf"), value)
    elif blank_missing:
        value = F.when(~value.isin(*NA_STRINGS), value)
    return value.alias(field.name)


def typed_raw(scanned: DataFrame, schema: T.StructType, blank_missing: bool = True, *extra: str | Column) -> DataFrame:
    """Scanned raw columns in their types: the one rule for jobs and audits, and whatever is ``extra``.

    Whole numbers may be written like ``7.0``. Numbers that are not finite
    become null, and so do, unless ``blank_missing`` is off, the texts that mean "missing".
    """
    return scanned.select(*[_raw_column(f, blank_missing) for f in schema], *extra)


def _csv_options(cfg: PipelineConfig) -> dict[str, str]:
    return CSV_OPTIONS | {"multiLine": str(cfg.multi_line).lower()}


def _scan(spark: SparkSession, cfg: PipelineConfig, table: LayerTable, schema: T.StructType) -> DataFrame:
    """One date of a raw table, addressed by its folder, so other dates are not even listed."""
    options = _csv_options(cfg)
    if CORRUPT in schema.fieldNames():
        # A scan that leaves columns out does not see that a line has too many.
        options |= {"columnPruning": "false", "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.schema(schema).options(**options).csv(cfg.partition_path(table))


def _does_not_fit(schema: T.StructType) -> Column:
    """Whether the line that was set aside has too many fields, a field that is no number, or an open quote.

    A line with too few fields is set aside too; its missing fields are null, as for any reader of such files.
    """
    names = ", ".join(f"c{n} string" for n in range(len(schema) + 1))
    parts = F.from_csv(F.col(CORRUPT), names, FIELD_OPTIONS | {"nullValue": "\u0001"})
    quotes = F.length(CORRUPT) - F.length(F.translate(CORRUPT, '"', ""))
    wrong = parts[f"c{len(schema)}"].isNotNull() | (quotes % 2 == 1)
    for number, field in enumerate(schema):
        if isinstance(field.dataType, T.DoubleType):
            text = parts[f"c{number}"]
            missing = text.isNull() | text.isin(*NA_STRINGS)
            wrong = wrong | (~missing & text.try_cast("double").isNull())
    return F.col(CORRUPT).isNotNull() & F.coalesce(wrong, F.lit(True))


def read_raw(spark: SparkSession, cfg: PipelineConfig, table: LayerTable, blank_missing: bool = True) -> DataFrame:
    """One date of a raw table in its types; see ``typed_raw``. Order quantities stay text, for the rules to judge."""
    schema = PEDIDOS_TEXT if table is RAW_PEDIDOS else table.schema
    return typed_raw(_scan(spark, cfg, table, text_schema(schema)), schema, blank_missing)


def read_raw_orders(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The orders of one date, each line kept: ``linha_raw`` holds the line where the typed columns lose part of it.

    That is where the line does not fit the schema, or where a key is written
    that is no whole number. An order without a readable id has a line too, and a line that does not fit has no id.
    """
    keys = [f.name for f in PEDIDOS_TEXT if isinstance(f.dataType, T.LongType)]
    with_line = T.StructType([*text_schema(PEDIDOS_TEXT), T.StructField(CORRUPT, T.StringType())])
    scanned = _scan(spark, cfg, RAW_PEDIDOS, with_line)
    # Each key is parsed once, in a projection of its own: both the typed column and the line depend on it.
    parsed = scanned.select("*", *[whole_number(key).alias(f"__{key}") for key in keys])
    lost = F.lit(False)
    for key in keys:
        written = F.col(key).isNotNull() & ~F.col(key).isin(*NA_STRINGS)
        lost = lost | (F.col(f"__{key}").isNull() & (written if key != "pedido_id" else F.lit(True)))
    misfit = _does_not_fit(PEDIDOS_TEXT)
    line = F.when(misfit, F.col(CORRUPT)).when(
        lost, F.to_csv(F.struct(*PEDIDOS_TEXT.fieldNames()), FIELD_OPTIONS))
    columns = [F.col(f"__{f.name}").alias(f.name) if f.name in keys else _raw_column(f, True) for f in PEDIDOS_TEXT]
    typed = parsed.select(*columns, line.alias(RAW_LINE), misfit.alias("__misfit"))
    return typed.withColumn("pedido_id", F.when(~F.col("__misfit"), F.col("pedido_id"))).drop("__misfit")


def require_fitting_lines(spark: SparkSession, cfg: PipelineConfig, *tables: LayerTable) -> None:
    """Raise if a line of a dimension does not fit its schema: an order could not be judged against it."""
    for table in tables:
        schema = T.StructType([*text_schema(table.schema), T.StructField(CORRUPT, T.StringType())])
        # All columns are read, or the scan would not look at the others.
        bad = _scan(spark, cfg, table, schema).where(_does_not_fit(table.schema)).limit(1).collect()
        if bad:
            raise MalformedLineError(f"{table.name} holds a line that does not fit: {bad[0][CORRUPT][:200]!r}")


def read_sketches(spark: SparkSession, cfg: PipelineConfig, *dates: str) -> DataFrame:
    """The order sketches of some dates, each with its date."""
    return reduce(DataFrame.unionAll, [
        read_layer(spark, replace(cfg, ingest_date=day), GOLD_SKETCHES).withColumn(GOLD_SKETCHES.partition, F.lit(day))
        for day in dates or (cfg.ingest_date,)])


def read_layer(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> DataFrame:
    """One date of a published JSON or Parquet layer table."""
    return spark.read.schema(table.schema).format(table.format).load(published_path(spark, cfg, table))
