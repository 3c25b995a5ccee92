"""The jobs on real folders: files, reruns, gates, catalog, reports."""

import json
from dataclasses import replace
from pathlib import Path

import pytest
from frames import C, P, Q
from generator import generate_customers, generate_orders, generate_products
from pyspark.sql import functions as F

from sedimenta.config import PipelineConfig, layer_path
from sedimenta.operators.gates import DuplicateKeyError, JoinLossError, ReconciliationError
from sedimenta.plans import jobs
from sedimenta.plans.jobs import run_audit, run_pipeline, run_process, staging_path, write_raw
from sedimenta.schemas import (
    GOLD_TABLE, LAYER_TABLES, QUARANTINE_TABLE, RAW_CLIENTES, RAW_PEDIDOS, RAW_PRODUTOS, SILVER_COLUMNS, SILVER_TABLE,
)
from sedimenta.sinks.layers import write_partition
from sedimenta.sources.catalog import catalog_layers, create_catalog, table_name
from sedimenta.sources.layers import MalformedLineError, read_layer, read_raw

D = "2026-09-20"


def config(lake, **changes):
    tag = "".join(c for c in lake if c.isalnum())
    return PipelineConfig(lake, D, database=f"db_{tag}", **changes)


def put(cfg, table, name, text):
    folder = Path(cfg.partition_path(table))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")


def put_raw(cfg, orders, customers="1,Ana,a@x,SP,Campinas,2020-01-01\n2,Rui,r@x,RJ,Niteroi,2020-01-01\n",
            products="10,Mouse Pro,Informatica,2.5\n11,Sem Preco,Casa,\n"):
    put(cfg, RAW_CLIENTES, "clientes.csv", "cliente_id,nome,email,uf,cidade,data_cadastro\n" + customers)
    put(cfg, RAW_PRODUTOS, "produtos.csv", "product_id,nome_produto,categoria,preco\n" + products)
    put(cfg, RAW_PEDIDOS, "pedidos.csv", "pedido_id,cliente_id,product_id,quantidade,data_pedido\n" + orders)


def published(cfg):
    return [t.name for t in (QUARANTINE_TABLE, SILVER_TABLE, GOLD_TABLE) if Path(cfg.partition_path(t)).exists()]


def json_lines(cfg):
    files = Path(cfg.partition_path(QUARANTINE_TABLE)).glob("*.json")
    return [json.loads(line) for f in files for line in f.read_text(encoding="utf-8").splitlines()]


def generated(spark, cfg, orders=5000):
    """Raw files with a known number of anomalies of each kind."""
    made = generate_orders(spark, orders, 200, 50, D, 0.03, 42)
    write_raw(cfg, generate_customers(spark, 200, D, 42), generate_products(spark, 50, 42), made.orders)
    return made.injected


# --- the whole run ------------------------------------------------------------------------

def test_full_run_with_default_sizes(spark, lake):
    cfg = config(lake)
    assert generated(spark, cfg) == {Q: 150, C: 150, P: 150}
    processed, reports = run_pipeline(spark, cfg)
    assert processed.raw == 5000 == processed.silver + processed.rejected
    assert processed.gold == 30
    for rule in (Q, C, P):
        assert sum(n for reason, n in processed.reasons.items() if rule in reason) == 150

    q2 = reports["Q2"].first()
    assert (q2.total_raw, q2.diferenca, q2.status) == (5000, 0, "OK - INTEGRIDADE CONFIRMADA")
    assert sum(r.qtd for r in reports["Q3"].collect()) == processed.rejected
    sample = [r.pedido_id for r in reports["Q4"].collect()]
    assert len(sample) == 10 and sample == sorted(sample)
    q5 = reports["Q5"].first()
    assert tuple(q5)[:3] == (processed.silver, 0, 0)
    assert reports["Q6"].first()[0] == 0
    q7 = reports["Q7"].first()
    assert q7.diferenca == 0.0 and q7.receita_silver == q7.receita_gold == q5.receita_total
    top = [r.receita_total for r in reports["Q8"].collect()]
    assert len(top) == 10 and top == sorted(top, reverse=True)
    rows = {r.tabela: r.n for r in reports["Q1"].groupBy("tabela").agg(F.sum("linhas").alias("n")).collect()}
    assert rows == {"raw_clientes": 200, "raw_produtos": 50, "raw_pedidos": 5000, "gold_vendas_uf_categoria": 30,
                    "silver_fato_vendas": processed.silver, "quarantine_pedidos_rejeitados": processed.rejected}

    for title in reports:
        files = list(Path(f"{lake}/reports/{title}").glob("*.csv"))
        assert len(files) == 1, title
        assert files[0].read_text().splitlines()[0] == ",".join(reports[title].columns)


def test_audit_can_be_skipped(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n")
    _, reports = run_pipeline(spark, cfg, skip_audit=True)
    assert reports == {} and not Path(f"{lake}/reports").exists()


# --- text edge cases ----------------------------------------------------------------------

def test_raw_text_reaches_the_right_layer(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "\n".join([
        "1,1,10,3,2026-01-01", "2,1,10,0.5,2026-01-01", "3,1,10,NA,2026-01-01", "4,1,10,abc,2026-01-01",
        "5,,10,1,2026-01-01", "6,1,9001,1,", "7,1,11,2,2026-01-01", "8,9001,9001,-1,2026-01-01",
        "9,x,10,1,2026-01-01", '10,2,10,"4",2026-01-01', "11,1,9001,2.5,2026-01-01"]) + "\n")
    report = run_process(spark, cfg)
    assert (report.raw, report.silver, report.rejected) == (11, 4, 7)
    silver = {r.pedido_id: (r.quantidade, r.valor_total, r.nome_cliente) for r in
              read_layer(spark, cfg, SILVER_TABLE).collect()}
    assert silver == {1: (3, 7.5, "Ana"), 2: (0, 1.25, "Ana"), 7: (2, None, "Ana"), 10: (4, 10.0, "Rui")}
    lines = {r["pedido_id"]: r for r in json_lines(cfg)}
    assert {k: r["motivo_rejeicao"] for k, r in lines.items()} == {
        3: Q, 4: Q, 5: C, 6: P, 8: f"{Q}; {C}; {P}", 9: C, 11: P}
    assert lines[4]["quantidade"] is None and lines[4]["quantidade_raw"] == "abc"
    assert lines[11]["quantidade"] == 2 and lines[11]["quantidade_raw"] == "2.5"
    assert lines[6]["data_pedido"] is None and "data_pedido" in lines[6]


def test_quarantine_can_leave_out_the_raw_text(spark, lake):
    cfg = config(lake, quarantine_raw_text=False)
    put_raw(cfg, "1,9,10,3,2026-01-01\n")
    run_process(spark, cfg)
    assert json_lines(cfg) == [{"pedido_id": 1, "cliente_id": 9, "product_id": 10, "quantidade": 3,
                                "data_pedido": "2026-01-01", "motivo_rejeicao": C}]


def test_missing_markers_become_null(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n", customers='1,NA,n/a,"",null, SP \n', products="10,None,NaN,NaN\n")
    assert tuple(read_raw(spark, cfg, RAW_CLIENTES).first()) == (1, None, None, None, None, " SP ")
    assert tuple(read_raw(spark, cfg, RAW_PRODUTOS).first()) == (10, None, None, None)
    assert read_raw(spark, cfg, RAW_CLIENTES, blank_missing=False).first().nome == "NA"


def test_whole_numbers_may_be_written_as_fractions(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1.0,1.0,10.0,2.0,2026-01-01\n2,,10,1,2026-01-01\n3,1.5,10,1,2026-01-01\n4,1d,10,1,2026-01-01\n"
                 "5,inf,10,1,2026-01-01\n9007199254740993,1,10,1,2026-01-01\n",
            customers="1.0,Ana,a@x,SP,Campinas,2020-01-01\n")
    assert run_process(spark, cfg).reasons == {C: 4}
    rows = {(r.pedido_id, r.cliente_id, r.quantidade) for r in read_layer(spark, cfg, SILVER_TABLE).collect()}
    assert rows == {(1, 1, 2), (9007199254740993, 1, 1)}


def test_extreme_values_do_not_stop_a_run(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1e300,2026-01-01\n2,1,11,3,2026-01-01\n3,1,12,9000000000000000000,2026-01-01\n4,1,13,1,\n",
            products="10,a,Casa,2.5\n11,b,Casa,Infinity\n12,c,Som,1000000\n13,d,Som,-Inf\n")
    assert run_process(spark, cfg).reasons == {Q: 1}
    rows = {r.pedido_id: (r.quantidade, r.valor_total) for r in read_layer(spark, cfg, SILVER_TABLE).collect()}
    assert rows == {2: (3, None), 3: (9 * 10**18, pytest.approx(9e24)), 4: (1, None)}
    gold = {r.categoria: r.receita_total for r in read_layer(spark, cfg, GOLD_TABLE).collect()}
    assert gold == {"Casa": 0.0, "Som": pytest.approx(9e24)}


def test_csv_keeps_quotes_commas_blanks_and_accents(spark, lake):
    cfg = config(lake)
    names = ['plain', 'with, comma', 'say "hi"', ' blanks ', 'João Ávila', 'back\\slash']
    rows = spark.createDataFrame([(i, n, "e", "SP", "c", "d") for i, n in enumerate(names)], RAW_CLIENTES.schema)
    write_partition(rows, cfg, RAW_CLIENTES)
    assert [r.nome for r in read_raw(spark, cfg, RAW_CLIENTES).orderBy("cliente_id").collect()] == names
    text = "".join(p.read_bytes().decode("utf-8") for p in Path(cfg.partition_path(RAW_CLIENTES)).glob("*.csv"))
    assert "João Ávila" in text and "\r" not in text and "cliente_id,nome,email,uf,cidade,data_cadastro\n" in text


def test_json_keeps_accents(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,9,10,1,São João\n")
    run_process(spark, cfg)
    text = next(Path(cfg.partition_path(QUARANTINE_TABLE)).glob("*.json")).read_text(encoding="utf-8")
    assert "São João" in text and text.endswith("\n")


def test_a_foreign_header_fails_the_scan(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n")
    swapped = "pedido_id,product_id,cliente_id,quantidade,data_pedido\n1,1,10,1,2026-01-01\n"
    put(cfg, RAW_PEDIDOS, "pedidos.csv", swapped)
    with pytest.raises(Exception, match="header does not conform"):
        run_process(spark, cfg)
    assert published(cfg) == []


# --- reruns -------------------------------------------------------------------------------

def test_rerun_replaces_every_layer_even_with_nothing(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,9,10,1,2026-01-01\n")
    assert run_process(spark, cfg).rejected == 1
    put_raw(cfg, "3,1,10,1,2026-01-01\n")
    assert run_process(spark, cfg).rejected == 0
    assert read_layer(spark, cfg, QUARANTINE_TABLE).count() == 0 and json_lines(cfg) == []
    assert [r.pedido_id for r in read_layer(spark, cfg, SILVER_TABLE).collect()] == [3]
    put_raw(cfg, "4,1,10,0,2026-01-01\n")
    report = run_process(spark, cfg)
    assert (report.silver, report.gold, report.rejected) == (0, 0, 1)
    assert read_layer(spark, cfg, SILVER_TABLE).count() == read_layer(spark, cfg, GOLD_TABLE).count() == 0


def test_no_orders_at_all(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "")
    report = run_process(spark, cfg)
    assert (report.raw, report.silver, report.rejected, report.gold, report.reasons) == (0, 0, 0, 0, {})
    reports = run_audit(spark, cfg)
    assert reports["Q2"].first().status == "OK - INTEGRIDADE CONFIRMADA"
    assert tuple(reports["Q5"].first()) == (0, None, None, None)
    assert tuple(reports["Q7"].first()) == (None, None, None)
    assert {r.tabela for r in reports["Q1"].collect()} == {"raw_clientes", "raw_produtos"}


@pytest.mark.parametrize("limit", [128 << 20, -1])
@pytest.mark.parametrize("orders, changes, expected", [
    ("", {}, (0, 0, 0)),
    ("", {"customers": "", "products": ""}, (0, 0, 0)),
    ("1,1,10,1,2026-01-01\n", {"customers": ""}, (1, 0, 1)),
    ("1,1,10,1,2026-01-01\n", {"customers": "", "products": ""}, (1, 0, 1)),
])
def test_empty_tables_with_and_without_broadcast(spark, lake, limit, orders, changes, expected):
    cfg = config(lake, broadcast_limit=limit)
    put_raw(cfg, orders, **changes)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit < 0:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = run_process(spark, cfg)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert (report.raw, report.silver, report.rejected) == expected


def test_another_date_adds_a_partition_and_changes_nothing_else(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n")
    run_process(spark, cfg)
    run_audit(spark, cfg)
    later = replace(cfg, ingest_date="2026-09-21")
    put_raw(later, "2,1,10,1,2026-01-02\n3,1,10,0,2026-01-02\n")
    run_process(spark, later)
    run_audit(spark, later)
    silver = spark.table(table_name(cfg, SILVER_TABLE))
    assert dict(silver.dtypes)["ingest_date"] == "string"
    assert sorted((r.pedido_id, r.ingest_date) for r in silver.collect()) == [(1, D), (2, "2026-09-21")]
    assert catalog_layers(spark, cfg).quarantine_pedidos_rejeitados.count() == 0
    assert [r.data for r in catalog_layers(spark, later).quarantine_pedidos_rejeitados.collect()] == ["2026-09-21"]


def test_catalog_sees_rewritten_partitions(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n")
    run_process(spark, cfg)
    create_catalog(spark, cfg)
    assert catalog_layers(spark, cfg).silver_fato_vendas.count() == 1
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,1,10,1,2026-01-01\n")
    run_process(spark, cfg)
    create_catalog(spark, cfg)
    assert catalog_layers(spark, cfg).silver_fato_vendas.count() == 2


def test_catalog_declares_every_table(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,9,10,1,2026-01-01\n")
    run_process(spark, cfg)
    create_catalog(spark, cfg)
    for table in LAYER_TABLES:
        columns = [(f.name, f.dataType.simpleString()) for f in table.schema] + [(table.partition, "string")]
        assert spark.table(table_name(cfg, table)).dtypes == columns
    assert spark.table(table_name(cfg, SILVER_TABLE)).columns[:-1] == SILVER_COLUMNS


def test_a_database_of_another_lake_is_refused(spark, lake, tmp_path):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n")
    run_process(spark, cfg)
    create_catalog(spark, cfg)
    create_catalog(spark, replace(cfg, base_uri=f"file://{lake}/"))
    with pytest.raises(ValueError, match="lies in"):
        create_catalog(spark, replace(cfg, base_uri=str(tmp_path)))


def test_a_failed_run_leaves_nothing_in_the_next_ones_layers(spark, lake, monkeypatch):
    """Also where the session overwrites partitions dynamically."""
    cfg = config(lake)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        put_raw(cfg, "1,9,10,1,2026-01-01\n")
        with monkeypatch.context() as patch:
            patch.setattr(jobs, "write_quarantine", lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                run_process(spark, cfg)
        put_raw(cfg, "2,1,10,1,2026-01-01\n")
        report = run_process(spark, cfg)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert (report.raw, report.silver, report.rejected) == (1, 1, 0)
    assert read_layer(spark, cfg, QUARANTINE_TABLE).count() == 0


# --- gates --------------------------------------------------------------------------------

@pytest.mark.parametrize("changes", [
    {"customers": "1,a,,,,\n1,b,,,,\n"}, {"products": "10,a,b,1\n10,a,b,1\n"}, {"customers": ",a,,,,\n,b,,,,\n"},
])
def test_duplicate_dimension_keys_stop_the_run_before_publishing(spark, lake, changes):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n", **changes)
    with pytest.raises(DuplicateKeyError):
        run_process(spark, cfg)
    assert published(cfg) == []


def _observing(monkeypatch, wrong):
    real = jobs.stage_checked_orders

    def staged(*args):
        rows, seen = real(*args)
        return rows, seen + wrong

    monkeypatch.setattr(jobs, "stage_checked_orders", staged)


def test_a_scan_observed_twice_does_not_fail_the_run(spark, lake, monkeypatch):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,1,10,1,2026-01-01\n")
    _observing(monkeypatch, 1)
    assert run_process(spark, cfg).raw == 2


def test_rows_lost_while_checking_stop_the_run_before_publishing(spark, lake, monkeypatch):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,1,10,1,2026-01-01\n")
    real = jobs.stage_checked_orders

    def losing(*args):
        rows, seen = real(*args)
        return rows.where("pedido_id <> 2"), seen

    monkeypatch.setattr(jobs, "stage_checked_orders", losing)
    with pytest.raises(JoinLossError):
        run_process(spark, cfg)
    assert published(cfg) == []


def test_rows_lost_while_publishing_are_found(spark, lake, monkeypatch):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,1,10,1,2026-01-01\n")
    real = jobs.silver_projection
    monkeypatch.setattr(jobs, "silver_projection", lambda rows: real(rows).where("pedido_id <> 2"))
    with pytest.raises(ReconciliationError):
        run_process(spark, cfg)
    assert published(cfg) == []


def layer_rows(spark, cfg):
    return {t.name: sorted(map(str, read_layer(spark, cfg, t).collect()))
            for t in (QUARANTINE_TABLE, SILVER_TABLE, GOLD_TABLE)}


@pytest.mark.parametrize("failure, error", [
    ("duplicate", DuplicateKeyError), ("loss", JoinLossError), ("reconciliation", ReconciliationError),
    ("overflow", Exception), ("dimension line", MalformedLineError),
])
def test_a_failing_run_leaves_the_last_one_as_it_was(spark, lake, monkeypatch, failure, error):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,9,10,1,2026-01-01\n")
    run_process(spark, cfg)
    before = layer_rows(spark, cfg)
    changes = {"duplicate": {"customers": "1,a,,,,\n1,b,,,,\n"},
               "dimension line": {"products": "10,a,b,1,9\n"}}.get(failure, {})
    amount = "9000000000000000000" if failure == "overflow" else "1"
    put_raw(cfg, f"3,1,10,{amount},2026-01-01\n4,1,10,{amount},2026-01-01\n", **changes)
    if failure == "loss":
        real = jobs.stage_checked_orders

        def losing(*args):
            rows, seen = real(*args)
            return rows.where("pedido_id <> 3"), seen

        monkeypatch.setattr(jobs, "stage_checked_orders", losing)
    if failure == "reconciliation":
        project = jobs.silver_projection
        monkeypatch.setattr(jobs, "silver_projection", lambda rows: project(rows).where("pedido_id <> 3"))
    with pytest.raises(error):
        run_process(spark, cfg)
    assert layer_rows(spark, cfg) == before
    assert not any(Path(staging_path(spark, cfg)).iterdir())


# --- nothing of a raw line is lost ---------------------------------------------------------

def test_lines_and_ids_that_cannot_be_read_are_quarantined_whole(spark, lake):
    cfg = config(lake)
    lines = ["5,1,10,2,2026-01-01,extra,extra2", "X2,1,10,1,2026-01-01", "7.5,1,10,1,2026-01-01",
             "9,1abc,10,1,2026-01-01", ",1,10,1,2026-01-01", "10,1,10"]
    put_raw(cfg, "\n".join([*lines, "6,1,10,2,2026-01-01"]) + "\n")
    report = run_process(spark, cfg)
    assert (report.raw, report.silver) == (7, 1)
    assert report.reasons == {"LINHA_ILEGIVEL": 4, C: 1, Q: 1}
    held = {row["linha_raw"] for row in json_lines(cfg)}
    assert held == {*lines[:5], None}  # the short line is held whole by the typed columns


def test_large_keys_written_as_fractions_keep_their_digits(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,9007199254740993.0,10,1,2026-01-01\n",
            customers="9007199254740992,a,,SP,,\n9007199254740993,b,,SP,,\n")
    run_process(spark, cfg)
    assert [r.nome_cliente for r in read_layer(spark, cfg, SILVER_TABLE).collect()] == ["b"]


def test_line_breaks_are_refused_or_read_by_an_option(spark, lake):
    rows = spark.createDataFrame([(1, "Ana\nMaria", "e", "SP", "c", "d"), (2, "Rui", "e", "RJ", "c", "d")],
                                 RAW_CLIENTES.schema)
    cfg = config(lake)
    with pytest.raises(Exception, match="line break in nome"):
        write_partition(rows, cfg, RAW_CLIENTES)
    wide = replace(cfg, multi_line=True)
    write_partition(rows, wide, RAW_CLIENTES)
    assert sorted(tuple(r) for r in read_raw(spark, wide, RAW_CLIENTES).collect()) == sorted(map(tuple, rows.collect()))
    put_raw(cfg, "1,1,10,1,2026-01-01\n", customers='1,"Ana\nMaria",e,SP,c,d\n2,Rui,e,RJ,c,d\n')
    with pytest.raises(MalformedLineError):
        run_process(spark, cfg)
    assert published(cfg) == []


def test_the_audit_reads_keys_as_the_process_does(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,2.0,10,1,2026-01-01\n",
            customers="1.0,Ana,a@x,SP,Campinas,2020-01-01\n2.0,Rui,r@x,RJ,Niteroi,2020-01-01\n")
    assert run_process(spark, cfg).valid == 2
    reports = run_audit(spark, replace(cfg, broadcast_limit=-1), export=False)
    assert (reports["Q2"].first().status, reports["Q6"].first()[0]) == ("OK - INTEGRIDADE CONFIRMADA", 0)
    assert catalog_layers(spark, replace(cfg, broadcast_limit=5)).broadcast_limit == 5


# --- places and parameters ----------------------------------------------------------------

def test_layer_paths():
    assert layer_path("s3a://b/lake/", RAW_PEDIDOS, D) == f"s3a://b/lake/raw/pedidos/ingest_date={D}"
    assert layer_path("/x", QUARANTINE_TABLE, D) == f"/x/quarantine/pedidos_rejeitados/data={D}"
    assert layer_path("/x", SILVER_TABLE) == "/x/processed/fato_vendas"


def test_staging_follows_the_session_setting(spark, lake):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert staging_path(spark, config(lake)).startswith(f"{shared}/sedimenta/")
    assert staging_path(spark, config(lake, staging_uri="/elsewhere")).startswith("/elsewhere/")
    lakes = ["s3a://lake/a_b", "s3a://lake/a/b", "s3a://lake/a-b"]
    assert len({staging_path(spark, PipelineConfig(uri, D)) for uri in lakes}) == 3


def test_defaults_and_bad_parameters():
    cfg = PipelineConfig("/x")
    assert (cfg.broadcast_limit, cfg.silver_order, cfg.multi_line) == (128 << 20, "global", False)
    for bad in ({"ingest_date": "20260920"}, {"database": "a.b"}, {"silver_order": "none"}):
        with pytest.raises(ValueError):
            PipelineConfig("/x", **bad)
