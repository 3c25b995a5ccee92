"""Run parameters and layer locations."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date

from sedimenta.schemas import LayerTable

SILVER_ORDERS = ("global", "files")


@dataclass(frozen=True)
class PipelineConfig:
    """Parameters of one run.

    ``base_uri`` is any URI Hadoop file systems understand; on a cluster it
    must be shared storage. ``silver_order`` is ``global`` (one range shuffle of
    the narrow checked rows, the whole table sorted by order id) or ``files``
    (each file sorted, no shuffle), which is the better choice for the largest
    inputs. ``broadcast_limit`` is the largest dimension, in counted bytes,
    that is broadcast, by the process and by the audits. ``multi_line`` reads and
    writes line breaks inside quoted raw fields, at the price of one task for
    each raw file; without it they are refused. ``staging_uri`` overrides where a
    run stages its rows and layers. With ``versioned`` a run publishes its layers by
    a pointer instead of replacing folders, see ``sinks.versions``. With ``order_sketches`` it keeps mergeable
    sketches of the distinct orders beside gold, see ``operators.sketches``.
    """

    base_uri: str
    ingest_date: str = field(default_factory=lambda: date.today().isoformat())
    database: str = "medallion"
    silver_order: str = "global"
    silver_rows_per_file: int = 16_000_000
    broadcast_limit: int = 128 << 20
    drop_null_gold_keys: bool = True
    quarantine_raw_text: bool = True
    multi_line: bool = False
    staging_uri: str | None = None
    versioned: bool = False
    order_sketches: bool = False

    def __post_init__(self):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", self.ingest_date):
            raise ValueError(f"ingest_date must be YYYY-MM-DD, got {self.ingest_date!r}")
        if not re.fullmatch(r"\w+", self.database):
            raise ValueError(f"database must be a plain identifier, got {self.database!r}")
        if self.silver_order not in SILVER_ORDERS:
            raise ValueError(f"silver_order must be one of {SILVER_ORDERS}, got {self.silver_order!r}")

    def table_path(self, table: LayerTable) -> str:
        return layer_path(self.base_uri, table)

    def partition_path(self, table: LayerTable) -> str:
        return layer_path(self.base_uri, table, self.ingest_date)


def layer_path(base_uri: str, table: LayerTable, partition_value: str | None = None) -> str:
    """Folder of a table, or of one of its Hive-style partitions."""
    path = f"{base_uri.rstrip('/')}/{table.folder}"
    return path if partition_value is None else f"{path}/{table.partition}={partition_value}"
