"""Publishing by version, registering one date, and tables declared by an older release."""

import threading
from dataclasses import replace
from pathlib import Path

import pytest
from test_jobs import D, config, put_raw

from sedimenta.operators.gates import DuplicateKeyError
from sedimenta.plans import jobs
from sedimenta.plans.jobs import run_audit, run_process
from sedimenta.schemas import GOLD_TABLE, LAYER_TABLES, QUARANTINE_TABLE, RAW_PEDIDOS, SILVER_TABLE
from sedimenta.sinks.versions import current_version, published_path
from sedimenta.sources.catalog import TableSchemaError, catalog_layers, create_catalog, create_database, table_name
from sedimenta.sources.layers import read_layer

ORDERS = "1,1,10,1,2026-01-01\n2,2,10,1,2026-01-01\n3,9,10,1,2026-01-01\n"


@pytest.fixture
def versioned(lake):
    cfg = config(lake, versioned=True)
    put_raw(cfg, ORDERS)
    return cfg


def counts(spark, cfg):
    return [read_layer(spark, cfg, t).count() for t in (QUARANTINE_TABLE, SILVER_TABLE, GOLD_TABLE)]


def versions(cfg):
    return {p.name for p in Path(cfg.base_uri, "_versions", cfg.ingest_date).iterdir()}


def test_versions_follow_each_other_and_one_is_kept(spark, versioned):
    seen = []
    for orders in (ORDERS, "4,1,10,1,2026-01-01\n", ""):
        put_raw(versioned, orders)
        run_process(spark, versioned)
        seen.append(current_version(spark, versioned))
    assert counts(spark, versioned) == [0, 0, 0]
    assert versions(versioned) == set(seen[-2:]) and len(set(seen)) == 3
    assert not Path(versioned.partition_path(SILVER_TABLE)).exists()
    assert run_audit(spark, versioned)["Q2"].first().status == "OK - INTEGRIDADE CONFIRMADA"


def test_a_reader_never_meets_an_empty_table(spark, versioned):
    run_process(spark, versioned)
    create_catalog(spark, versioned)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                layers = catalog_layers(spark, versioned)
                seen.append((layers.silver_fato_vendas.count(), len(read_layer(spark, versioned, SILVER_TABLE).collect())))
            except Exception as e:  # noqa: BLE001
                seen.append(repr(e))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        put_raw(versioned, ORDERS + "5,1,10,2,2026-01-01\n")
        run_process(spark, versioned)
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 3 and {n for pair in seen for n in pair} <= {2, 3}, seen
    assert catalog_layers(spark, versioned).silver_fato_vendas.count() == 3


def test_what_fails_before_the_swap_keeps_the_old_version(spark, versioned, monkeypatch):
    run_process(spark, versioned)
    create_catalog(spark, versioned)
    before = current_version(spark, versioned)

    def fail(*_):
        raise OSError("no marker today")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "publish_version", fail)
        put_raw(versioned, "")
        with pytest.raises(OSError, match="no marker"):
            run_process(spark, versioned)
    put_raw(versioned, ORDERS, customers="1,a,b,c,d,e\n1,a,b,c,d,e\n")
    with pytest.raises(DuplicateKeyError):
        run_process(spark, versioned)
    assert current_version(spark, versioned) == before and versions(versioned) == {before}
    assert counts(spark, versioned) == [1, 2, 2]
    assert catalog_layers(spark, versioned).silver_fato_vendas.count() == 2


def test_a_swap_that_ends_before_the_catalog_follows_is_caught_up(spark, versioned, monkeypatch):
    run_process(spark, versioned)
    create_catalog(spark, versioned)
    put_raw(versioned, "4,1,10,1,2026-01-01\n")
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "follow_version", lambda *_: (_ for _ in ()).throw(OSError("catalog away")))
        with pytest.raises(OSError, match="catalog away"):
            run_process(spark, versioned)
    assert counts(spark, versioned)[1] == 1
    assert catalog_layers(spark, versioned).silver_fato_vendas.count() == 2
    create_catalog(spark, versioned)
    assert catalog_layers(spark, versioned).silver_fato_vendas.count() == 1


def test_dates_have_versions_of_their_own(spark, versioned):
    later = replace(versioned, ingest_date="2026-09-21")
    put_raw(later, "7,1,10,1,2026-01-01\n")
    for cfg in (versioned, later):
        run_process(spark, cfg)
    create_catalog(spark, versioned, repair=True)
    rows = spark.table(table_name(versioned, SILVER_TABLE)).groupBy("ingest_date").count().collect()
    assert {r.ingest_date: r["count"] for r in rows} == {D: 2, "2026-09-21": 1}
    assert published_path(spark, versioned, RAW_PEDIDOS) == versioned.partition_path(RAW_PEDIDOS)


def test_one_date_is_registered_without_the_others(spark, lake):
    cfg = config(lake)
    put_raw(cfg, ORDERS)
    run_process(spark, cfg)
    for n in range(1000):
        Path(cfg.table_path(SILVER_TABLE), f"ingest_date=2020-{n:04d}").mkdir()
    create_catalog(spark, cfg)
    partitions = spark.sql(f"SHOW PARTITIONS {table_name(cfg, SILVER_TABLE)}").collect()
    assert [r.partition for r in partitions] == [f"ingest_date={D}"]
    create_catalog(spark, cfg, repair=True)
    assert spark.sql(f"SHOW PARTITIONS {table_name(cfg, SILVER_TABLE)}").count() == 1001


def old_table(spark, cfg, columns, partition="ingest_date string", table=SILVER_TABLE):
    create_database(spark, cfg)
    spark.sql(f"CREATE TABLE {table_name(cfg, table)} ({columns}, {partition}) USING {table.format} "
              f"PARTITIONED BY ({partition.split()[0]}) LOCATION '{cfg.table_path(table)}'")


def declared(table, last=None):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields[:last])


def test_columns_added_since_are_added_to_the_table(spark, lake):
    cfg = config(lake)
    put_raw(cfg, ORDERS)
    run_process(spark, cfg)
    old_table(spark, cfg, declared(SILVER_TABLE, 10))
    create_catalog(spark, cfg)
    assert spark.table(table_name(cfg, SILVER_TABLE)).columns == [*SILVER_TABLE.schema.fieldNames(), "ingest_date"]
    assert run_audit(spark, cfg)["Q5"].first().receita_total == 5.0


@pytest.mark.parametrize("columns, partition, says", [
    (declared(SILVER_TABLE).replace("quantidade bigint", "quantidade string"), "ingest_date string", "quantidade string instead of quantidade bigint"),
    (declared(SILVER_TABLE) + ", extra string", "ingest_date string", "extra string, which is not declared"),
    (declared(SILVER_TABLE).replace("uf string, cidade", "cidade string, uf"), "ingest_date string", "cidade string instead of uf string"),
    (declared(SILVER_TABLE), "ingest_date date", "not partitioned by ingest_date string")])
def test_a_table_with_other_columns_fails_the_audit_by_name(spark, lake, columns, partition, says):
    cfg = config(lake)
    put_raw(cfg, ORDERS)
    run_process(spark, cfg)
    old_table(spark, cfg, columns, partition)
    with pytest.raises(TableSchemaError, match=f"silver_fato_vendas.*{says}"):
        run_audit(spark, cfg)


def test_every_table_is_compared(spark, lake):
    cfg = config(lake)
    put_raw(cfg, ORDERS)
    for table in LAYER_TABLES:
        create_catalog(spark, cfg)
        spark.sql(f"DROP TABLE {table_name(cfg, table)}")
        old_table(spark, cfg, "other string", f"{table.partition} string", table)
        with pytest.raises(TableSchemaError, match=table.name):
            create_catalog(spark, cfg)
        spark.sql(f"DROP TABLE {table_name(cfg, table)}")
