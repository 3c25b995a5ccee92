"""The jobs: process, audit, and both."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.config import PipelineConfig
from sedimenta.operators import gates
from sedimenta.operators.audit import AUDITS
from sedimenta.operators.gates import Dimension
from sedimenta.operators.gold import build_gold
from sedimenta.operators.quality import (
    REASON, UNREADABLE, PresentRule, check_rows, order_rules, reason_counts,
)
from sedimenta.operators.sketches import order_sketches
from sedimenta.operators.silver import (
    CUSTOMER_ATTRIBUTES, MOST_ROWS, PRODUCT_ATTRIBUTES, join_dimensions, measure_order_dimensions, range_by_order,
    silver_projection, tasks_for,
)
from sedimenta.schemas import (
    DERIVED_TABLES, GOLD_SKETCHES, GOLD_TABLE, QUARANTINE_TABLE, RAW_CLIENTES, RAW_LINE, RAW_PEDIDOS, RAW_PRODUTOS, SILVER_TABLE,
)
from sedimenta.sinks.folders import remove_folder, replace_folder
from sedimenta.sinks.layers import quarantine_projection, write_partition, write_report
from sedimenta.sinks.versions import publish_version, version_config
from sedimenta.sources.catalog import catalog_layers, create_catalog, follow_version
from sedimenta.sources.layers import read_layer, read_raw, read_raw_orders, require_fitting_lines
from sedimenta.sources.scratch import release_shuffles

# Rows in a quarantine file.
QUARANTINE_ROWS = 4_000_000
# Rows that one task sorts for silver, beside the broadcast dimensions that it holds; of a large table see ``tasks_for``.
SORTED_ROWS = 500_000


@dataclass(frozen=True)
class ProcessReport:
    raw: int
    valid: int
    rejected: int
    silver: int
    gold: int
    reasons: dict[str, int]


def write_raw(cfg: PipelineConfig, clientes: DataFrame, produtos: DataFrame, pedidos: DataFrame) -> None:
    for table, df in ((RAW_CLIENTES, clientes), (RAW_PRODUTOS, produtos), (RAW_PEDIDOS, pedidos)):
        write_partition(df.select(*table.schema.fieldNames()), cfg, table)
    release_shuffles(pedidos.sparkSession)


def staging_path(spark: SparkSession, cfg: PipelineConfig) -> str:
    """Where runs of a lake and date keep what they have not published yet: shared storage.

    The name of the folder holds a hash of the whole URI, so lakes whose names differ in punctuation only stay apart.
    """
    root = cfg.staging_uri or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        return f"{cfg.base_uri.rstrip('/')}/_staging/{cfg.ingest_date}"
    lake = hashlib.sha256(cfg.base_uri.rstrip("/").encode()).hexdigest()[:32]
    return f"{root.rstrip('/')}/sedimenta/{lake}/{cfg.ingest_date}"


def stage_checked_orders(spark: SparkSession, cfg: PipelineConfig, customer: Dimension, product: Dimension,
                         path: str) -> tuple[DataFrame, int]:
    """Check all raw orders once and write them to ``path`` as Parquet, one file a scan task.

    Both routes read their rows from there, so the CSV is parsed and checked
    once, a lost executor costs no recomputation, and nothing is published
    before the gates have seen the counts. A dimension too large to broadcast
    brings its silver columns along in this one shuffle join; one that fits is
    only probed here and joined again, without a shuffle, when silver is
    written, which keeps the staged rows narrow. Returns the staged rows and
    the number of raw rows seen by the scan.
    """
    limit = cfg.broadcast_limit
    rules = [PresentRule(UNREADABLE, "pedido_id"), *order_rules(
        customer.sized_for_join(limit), product.sized_for_join(limit), unique_keys=True,
        customer_attributes=None if customer.fits(limit) else CUSTOMER_ATTRIBUTES,
        product_attributes=None if product.fits(limit) else PRODUCT_ATTRIBUTES)]
    seen = Observation("raw orders")
    observed = read_raw_orders(spark, cfg).observe(seen, F.count(F.lit(1)).alias("rows"))
    flagged = check_rows(observed, rules).flagged()
    flagged.write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(flagged.schema).parquet(path)
    # AQE drops an empty input from the plan, and its observation with it. Should rows have been lost, they are counted.
    return staged, 0 if staged.isEmpty() else seen.get["rows"]


def run_process(spark: SparkSession, cfg: PipelineConfig) -> ProcessReport:
    """Raw to quarantine, silver and gold.

    All three layers are written and checked in the staging folder of this run
    before the first of them replaces what is published, so a run that fails changes nothing. What is not
    atomic is the replacing: three folders, one after the other. With ``cfg.versioned`` the layers are written where they
    stay, and one marker publishes all three at once.
    """
    require_fitting_lines(spark, cfg, RAW_CLIENTES, RAW_PRODUTOS)
    customer, product = measure_order_dimensions(
        read_raw(spark, cfg, RAW_CLIENTES), read_raw(spark, cfg, RAW_PRODUTOS))

    version = uuid.uuid4().hex
    run = f"{staging_path(spark, cfg)}/{version}"
    beside = version_config(cfg, version) if cfg.versioned else replace(cfg, base_uri=f"{run}/layers")
    beside, done = replace(beside, versioned=False), False
    try:
        staged, raw_rows = stage_checked_orders(spark, cfg, customer, product, f"{run}/checked")
        # At most one row per combination of the rules.
        reasons = {r[REASON]: r["qtd"] for r in reason_counts(staged).collect()}
        valid_rows = reasons.pop("", 0)
        rejected_rows = sum(reasons.values())
        if not raw_rows or raw_rows != valid_rows + rejected_rows:
            # A recomputed scan task is observed twice; only a real count may fail the run.
            raw_rows = read_raw(spark, cfg, RAW_PEDIDOS, blank_missing=False).count()
        gates.require_join_conserved(raw_rows, valid_rows + rejected_rows)
        release_shuffles(spark)

        write_quarantine(beside, staged, rejected_rows)
        write_silver(spark, beside, staged, valid_rows, customer, product)
        release_shuffles(spark)
        gold = build_gold(read_layer(spark, beside, SILVER_TABLE), cfg.drop_null_gold_keys, valid_rows)
        write_partition(gold, beside, GOLD_TABLE)
        if cfg.order_sketches:
            write_partition(order_sketches(read_layer(spark, beside, SILVER_TABLE), cfg.drop_null_gold_keys), beside, GOLD_SKETCHES)
        written = published_rows(spark, beside)
        release_shuffles(spark)
        gates.require_reconciled(raw_rows, written[SILVER_TABLE.name], written[QUARANTINE_TABLE.name])

        if cfg.versioned:
            publish_version(spark, cfg, version)
            done = True
            follow_version(spark, cfg)
        else:
            for table in (*DERIVED_TABLES, *([GOLD_SKETCHES] if cfg.order_sketches else [])):
                replace_folder(spark, beside.partition_path(table), cfg.partition_path(table))
    finally:
        remove_folder(spark, run)
        if cfg.versioned and not done:
            remove_folder(spark, beside.base_uri)
    return ProcessReport(raw_rows, valid_rows, rejected_rows, written[SILVER_TABLE.name],
                         written[GOLD_TABLE.name], reasons)


def published_rows(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Rows of the three derived layers as they lie on storage, counted in one job."""
    tables = (SILVER_TABLE, QUARANTINE_TABLE, GOLD_TABLE)
    tagged = reduce(DataFrame.unionAll, [
        read_layer(spark, cfg, t).select(F.lit(t.name).alias("tabela")) for t in tables])
    counts = {r.tabela: r["count"] for r in tagged.groupBy("tabela").count().collect()}
    return {t.name: counts.get(t.name, 0) for t in tables}


def write_quarantine(cfg: PipelineConfig, staged: DataFrame, rejected_rows: int) -> None:
    """The few rejected rows of all staged files, dealt to as many files as their number needs."""
    rejected = staged.where(F.col(REASON) != "").repartition(max(-(-rejected_rows // QUARANTINE_ROWS), 1))
    write_partition(quarantine_projection(rejected, cfg.quarantine_raw_text), cfg, QUARANTINE_TABLE)


def write_silver(spark: SparkSession, cfg: PipelineConfig, staged: DataFrame, valid_rows: int,
                 customer: Dimension, product: Dimension) -> None:
    """Silver sorted by order id. The narrow staged rows are shuffled, before the broadcast joins widen them."""
    valid = staged.where(F.col(REASON) == "")
    if cfg.silver_order == "global":
        # A hash of the staged row's place is the same after a retry, so equal rows spread over the sorted files. Its
        # 24 bits, and no column that silver has not, are what the shuffle carries beside the rows.
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index").bitwiseAND(F.lit((1 << 24) - 1)).alias("__place")
        most = cfg.silver_rows_per_file
        files = tasks_for(valid_rows, min(most, SORTED_ROWS), min(most, MOST_ROWS))
        columns = [c for c in valid.columns if c not in (REASON, RAW_LINE)]
        valid = range_by_order(valid.select(*columns, place), files, spread="__place")
    silver = silver_projection(join_dimensions(valid, customer, product, cfg.broadcast_limit))
    write_partition(silver.sortWithinPartitions(F.asc_nulls_last("pedido_id")), cfg, SILVER_TABLE)


def run_audit(spark: SparkSession, cfg: PipelineConfig, export: bool = True, titles: Iterable[str] = AUDITS
              ) -> dict[str, DataFrame]:
    """Register the layers, run Q1 to Q8, or those named, over them and export each result as CSV."""
    create_catalog(spark, cfg)
    layers, wanted = catalog_layers(spark, cfg), set(titles)
    reports = {title: audit(layers) for title, audit in AUDITS.items() if title in wanted}
    if export:
        for title, report in reports.items():
            write_report(report, cfg.base_uri, title)
    return reports


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, skip_audit: bool = False
                 ) -> tuple[ProcessReport, dict[str, DataFrame]]:
    """Process the raw files of the date, then audit what is published."""
    processed = run_process(spark, cfg)
    return processed, {} if skip_audit else run_audit(spark, cfg)
