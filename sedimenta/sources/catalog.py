"""Catalog tables over the layer folders."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.config import PipelineConfig
from sedimenta.operators.audit import Layers
from sedimenta.schemas import DERIVED_TABLES, LAYER_TABLES, LayerTable
from sedimenta.sinks.folders import exists, file_names
from sedimenta.sinks.versions import published_path
from sedimenta.sources.layers import CSV_OPTIONS, text_schema, typed_raw


class TableSchemaError(ValueError):
    """A catalog table has other columns than the ones declared for it."""


def table_name(cfg: PipelineConfig, table: LayerTable) -> str:
    return f"{cfg.database}.{table.name}"


def create_database(spark: SparkSession, cfg: PipelineConfig) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db) LOCATION :place",
              args={"db": cfg.database, "place": f"{cfg.base_uri.rstrip('/')}/_database"})


def as_written(table: LayerTable) -> LayerTable:
    """The raw table beside the declared one, whose keys are the text in the files, for ``typed_raw`` to read.

    A whole-number column of a CSV table is null where a file says ``7.0``, which the process takes as 7.
    """
    return replace(table, name=f"{table.name}_texto", schema=text_schema(table.schema))


def create_table(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> None:
    """External table over the folder, with the declared columns and a string partition."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    options = ""
    if table.format == "csv":
        options = "OPTIONS (" + ", ".join(f"{k} '{v}'" for k, v in {**CSV_OPTIONS, "multiLine": str(cfg.multi_line).lower()}.items()) + ")"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({columns}, {table.partition} string) "
        f"USING {table.format} {options} PARTITIONED BY ({table.partition}) LOCATION :place",
        args={"t": table_name(cfg, table), "place": cfg.table_path(table)})


def require_location(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> None:
    """Raise if the table, created earlier, lies over another lake: its audit would be of that one."""
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table_name(cfg, table)})
    location = described.where("col_name = 'Location'").first().data_type

    def place(uri: str) -> str:
        return re.sub(r"^[A-Za-z0-9+.-]+:", "", uri).strip("/")

    if place(location) != place(cfg.table_path(table)):
        raise ValueError(f"table {table_name(cfg, table)} lies in {location}, not in {cfg.table_path(table)}")


def require_columns(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> None:
    """Add declared columns that an older table lacks at its end; raise if it differs in any other way.

    The files are read by these columns, so a column of another type or place would be read wrongly or as null.
    """
    name = table_name(cfg, table)
    held = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema]
    declared = [(f.name, f.dataType.simpleString()) for f in table.schema]
    found, partition = [c for c in held if c[0] != table.partition], dict(held).get(table.partition)
    if partition != T.StringType().simpleString() or held[-1][0] != table.partition:
        raise TableSchemaError(f"table {name} is not partitioned by {table.partition} string, but holds {held}")
    if found != declared[:len(found)]:
        wrong = [f"{have[0]} {have[1]} instead of {want[0]} {want[1]}" for have, want in zip(found, declared) if have != want]
        wrong += [f"{n} {t}, which is not declared" for n, t in found[len(declared):]]
        raise TableSchemaError(f"table {name} has {'; '.join(wrong)}")
    if len(found) < len(declared):
        added = ", ".join(f"{n} {t}" for n, t in declared[len(found):])
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD COLUMNS ({added})", args={"t": name})


def register_partition(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> None:
    """Point the table at the folder of the configured date, as it is published now; no other date is listed.

    The change of a location is one update of the catalog: a reader finds the old folder or the new one.
    """
    name, place = table_name(cfg, table), published_path(spark, cfg, table)
    if not exists(spark, place):
        return
    spec = f"PARTITION ({table.partition} = '{cfg.ingest_date}')"
    args = {"t": name, "place": place}
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD IF NOT EXISTS {spec} LOCATION :place", args=args)
    if cfg.versioned and table in DERIVED_TABLES:
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) {spec} SET LOCATION :place", args=args)
    spark.catalog.refreshTable(name)


def register_all_partitions(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> None:
    """Add the partitions of all dates found on storage, and forget file lists of rewritten ones."""
    if cfg.versioned and table in DERIVED_TABLES:
        for day in file_names(spark, f"{cfg.base_uri.rstrip('/')}/_current"):
            register_partition(spark, replace(cfg, ingest_date=day), table)
    else:
        spark.sql("MSCK REPAIR TABLE IDENTIFIER(:t)", args={"t": table_name(cfg, table)})
        spark.catalog.refreshTable(table_name(cfg, table))


def create_catalog(spark: SparkSession, cfg: PipelineConfig, repair: bool = False) -> None:
    """Declare all tables and register the configured date, or with ``repair`` every date that lies on storage."""
    create_database(spark, cfg)
    for table in (*LAYER_TABLES, *(as_written(t) for t in LAYER_TABLES if t.format == "csv")):
        create_table(spark, cfg, table)
        require_location(spark, cfg, table)
        require_columns(spark, cfg, table)
        if repair:
            register_all_partitions(spark, cfg, table)
        register_partition(spark, cfg, table)


def follow_version(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Let the tables of the derived layers, where they are declared, read the current version of the date."""
    for table in DERIVED_TABLES:
        if spark.catalog.tableExists(table_name(cfg, table)):
            register_partition(spark, cfg, table)


def catalog_layers(spark: SparkSession, cfg: PipelineConfig) -> Layers:
    """The layers of the configured date, read from their tables with the partition pruned.

    Raw tables are typed by the rule of the process, so both see the same keys.
    """
    def layer(table: LayerTable):
        raw = table.format == "csv"
        rows = spark.table(table_name(cfg, as_written(table) if raw else table))
        rows = rows.where(F.col(table.partition) == cfg.ingest_date)
        return typed_raw(rows, table.schema, True, table.partition, "_metadata") if raw else rows

    return Layers(**{table.name: layer(table) for table in LAYER_TABLES}, broadcast_limit=cfg.broadcast_limit)
