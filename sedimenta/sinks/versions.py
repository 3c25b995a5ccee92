"""Versions of the published layers: a run is put in place by one small file, so no reader meets half of it.

A run writes its three layers into a folder of its own,
``_versions/<date>/<version>/``, with the usual layout below it. What is published is named by an empty
marker ``_current/<date>/<number>.<version>``; the marker with the highest number counts. Creating an
empty file is atomic on every file system, so all three layers change together, nothing is moved or copied, and
a run that fails before that leaves the old version in place. The version before is kept for readers that have
begun; older ones are removed. Catalog tables follow by the location of their partition (see ``sources.catalog``).
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import SparkSession

from sedimenta.config import PipelineConfig
from sedimenta.schemas import DERIVED_TABLES, GOLD_SKETCHES, LayerTable
from sedimenta.sinks.folders import create_marker, file_names, remove_folder

MARKER = re.compile(r"(\d{9,})\.([0-9a-z]+)")


def _markers_folder(cfg: PipelineConfig) -> str:
    return f"{cfg.base_uri.rstrip('/')}/_current/{cfg.ingest_date}"


def version_config(cfg: PipelineConfig, version: str) -> PipelineConfig:
    """The configuration whose layer folders are those of one version."""
    return replace(cfg, base_uri=f"{cfg.base_uri.rstrip('/')}/_versions/{cfg.ingest_date}/{version}")


def _published(spark: SparkSession, cfg: PipelineConfig) -> list[tuple[int, str]]:
    """(number, version) of all markers of the date, oldest first."""
    found = [MARKER.fullmatch(name) for name in file_names(spark, _markers_folder(cfg))]
    return sorted((int(m.group(1)), m.group(2)) for m in found if m)


def current_version(spark: SparkSession, cfg: PipelineConfig) -> str | None:
    published = _published(spark, cfg)
    return published[-1][1] if published else None


def publish_version(spark: SparkSession, cfg: PipelineConfig, version: str) -> None:
    """Make a written version the current one, and remove all but the one before it."""
    published = _published(spark, cfg)
    number = published[-1][0] + 1 if published else 1
    create_marker(spark, f"{_markers_folder(cfg)}/{number:09d}.{version}")
    for old, name in published[:-1]:
        # The folder goes first: a marker without a folder is never the current one.
        remove_folder(spark, version_config(cfg, name).base_uri)
        remove_folder(spark, f"{_markers_folder(cfg)}/{old:09d}.{name}")


def published_path(spark: SparkSession, cfg: PipelineConfig, table: LayerTable) -> str:
    """Where the date of a table lies: in its own folder, or in that of the current version."""
    version = current_version(spark, cfg) if cfg.versioned and table in (*DERIVED_TABLES, GOLD_SKETCHES) else None
    return (version_config(cfg, version) if version else cfg).partition_path(table)
