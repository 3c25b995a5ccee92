"""Plans and skew: what must hold when the data no longer fits one machine."""

import contextlib
import io
import time
from pathlib import Path

import pytest
from compare import MEDIUM, SMALL, assert_same
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sedimenta.config import PipelineConfig
from sedimenta.operators.audit import silver_orphans
from sedimenta.operators.quality import REASON, check_and_enrich, check_orders
from sedimenta.operators import gold
from sedimenta.operators.gold import build_gold
from sedimenta.operators.silver import measure_order_dimensions, tasks_for
from sedimenta.plans import jobs
from sedimenta.plans.jobs import run_process, staging_path, write_raw
from sedimenta.plans.queries import _out_of_order
from sedimenta.schemas import GOLD_TABLE, PEDIDOS_TEXT, QUARANTINE_TABLE, SILVER_TABLE
from sedimenta.session import recommended_conf
from sedimenta.sources.adapters import raw_frames
from sedimenta.sources.catalog import catalog_layers, create_catalog
from sedimenta.sources.layers import read_layer

D = "2026-09-20"
ACTION_FREE = ["dq_flagged", "dq_valid", "dq_rejected", "dq_rule_totals", "silver_fato_vendas", "gold_uf_categoria",
               "gate_reconciliation", "audit_silver_orphans", "audit_orphans_tampered", "orphan_detail_left_anti",
               "audit_silver_vs_gold"]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k: k.replace("__", ".") for k in values}
    old = {n: spark.conf.get(n, None) for n in names.values()}
    for k, n in names.items():
        spark.conf.set(n, values[k])
    try:
        yield
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("name", ACTION_FREE)
def test_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_valid_route_uses_inner_joins_and_reads_only_its_columns(spark):
    text = plan(contract.queries()["gold_uf_categoria"](spark, SMALL))
    assert "LeftOuter" not in "".join(line for line in text.splitlines() if "__key" in line)
    assert "l_extendedprice" not in text and "c_acctbal" not in text and "p_brand" not in text


@pytest.mark.parametrize("name", ["dq_flagged", "dq_rejected", "silver_fato_vendas", "gold_uf_categoria",
                                  "audit_silver_orphans", "orphan_detail_left_anti"])
def test_results_without_any_broadcast(spark, name, monkeypatch):
    """The same rows when every dimension is too large to broadcast."""
    import sedimenta.operators.gates as gates
    monkeypatch.setattr(gates.Dimension, "fits", lambda self, limit: False)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        df = contract.queries()[name](spark, MEDIUM)
        assert "Broadcast" not in plan(df)
        assert_same(df, contract.oracle_sql()[name], MEDIUM)


@pytest.mark.parametrize("name", ["dq_rejected", "gold_uf_categoria", "audit_silver_vs_gold", "dq_reason_counts"])
@pytest.mark.parametrize("partitions", ["1", "13"])
def test_results_do_not_depend_on_partitions(spark, name, partitions):
    with settings(spark, spark__sql__shuffle__partitions=partitions, spark__sql__files__maxPartitionBytes="200000"):
        assert_same(contract.queries()[name](spark, SMALL), contract.oracle_sql()[name], SMALL)


def hot_orders(spark, rows=300_000):
    """A third of the rows has one customer, a sixth has none; the order id of a third is the same."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 4000)
    return spark.range(0, rows, 1, 16).select(
        F.when(F.col("id") % 3 == 1, 5).otherwise(F.col("id")).alias("pedido_id"),
        key.cast("long").alias("cliente_id"), (F.col("id") % 3000).alias("product_id"),
        (F.col("id") % 9).alias("quantidade"), F.lit("2026-01-01").alias("data_pedido"))


def dimensions(spark):
    ids = spark.range(0, 4000, 1, 4)
    return (
        ids.select(F.col("id").alias("cliente_id"), F.lit("n").alias("nome"), F.lit("e").alias("email"),
                   F.concat(F.lit("U"), F.col("id") % 5).alias("uf"), F.lit("c").alias("cidade"),
                   F.lit("2020-01-01").alias("data_cadastro")),
        ids.select(F.col("id").alias("product_id"), F.lit("p").alias("nome_produto"),
                   F.concat(F.lit("C"), F.col("id") % 4).alias("categoria"), (F.col("id") / 4).alias("preco")))


SPLITTING = dict(
    spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__shuffle__partitions="16", spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2")


@pytest.mark.parametrize("build", [
    lambda o, c, p: check_orders(o, c, p, broadcast_limit=-1).flagged(),
    lambda o, c, p: check_orders(o, c, p, broadcast_limit=-1).rejected(),
    lambda o, c, p: check_and_enrich(o, c, p, broadcast_limit=-1).flagged(),
    lambda o, c, p: check_and_enrich(o, c, p, broadcast_limit=-1).valid(True),
], ids=["flagged", "rejected", "enriched", "valid"])
def test_hot_and_null_keys_are_split_when_the_join_shuffles(spark, build):
    orders, (clientes, produtos) = hot_orders(spark), dimensions(spark)
    expected = build(orders, clientes, produtos)
    expected = (expected.count(), expected.agg(F.sum(F.xxhash64(*expected.columns).cast("decimal(38,0)"))).first()[0])
    with settings(spark, **SPLITTING):
        df = build(orders, clientes, produtos)
        rows = df.collect()
        assert "skew=true" in plan(df)
    assert len(rows) == expected[0]
    again = spark.createDataFrame(rows, df.schema)
    assert again.agg(F.sum(F.xxhash64(*again.columns).cast("decimal(38,0)"))).first()[0] == expected[1]


@pytest.mark.parametrize("copies", [1, 2])
@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_hot_keys_are_split_with_dimensions_from_files(spark, lake, form, copies):
    """Also where the keys of a dimension repeat."""
    orders, (clientes, produtos) = hot_orders(spark), dimensions(spark)
    expected = check_orders(orders, clientes, produtos).rule_totals().collect()
    held = []
    for name, df in (("c", clientes), ("p", produtos)):
        for _ in range(copies):
            df.write.mode("append").format(form).save(f"{lake}/{name}")
        held.append(spark.read.schema(df.schema).format(form).load(f"{lake}/{name}"))
    with settings(spark, **SPLITTING):
        checked = check_orders(orders, *held, broadcast_limit=-1)
        df = checked.flagged()
        df.collect()
        text = plan(df)
        joins = [line for line in text.split("Initial Plan")[0].splitlines() if "SortMergeJoin" in line]
        assert any("skew=true" in line and "cliente_id" in line for line in joins)
        assert checked.rule_totals().collect() == expected


def test_orphan_audit_splits_hot_keys(spark, monkeypatch):
    import sedimenta.operators.gates as gates
    monkeypatch.setattr(gates.Dimension, "fits", lambda self, limit: False)
    orders, (clientes, produtos) = hot_orders(spark), dimensions(spark)
    with settings(spark, **SPLITTING):
        df = silver_orphans(orders, clientes, produtos)
        assert df.collect()[0][0] == 50_000
        assert "skew=true" in plan(df)


def run(spark, lake, order="global", limit=128 << 20, **more):
    cfg = PipelineConfig(lake, D, silver_order=order, broadcast_limit=limit,
                         database="db_" + "".join(c for c in lake if c.isalnum()), **more)
    clientes, produtos = dimensions(spark)
    write_raw(cfg, clientes, produtos, hot_orders(spark, 60_000))
    return cfg, run_process(spark, cfg)


@pytest.fixture(scope="module")
def reference_layers(spark, tmp_path_factory):
    cfg, report = run(spark, str(tmp_path_factory.mktemp("lake")))
    tables = (SILVER_TABLE, GOLD_TABLE, QUARANTINE_TABLE)
    return {t: sorted(map(str, read_layer(spark, cfg, t).collect())) for t in tables}, report


@pytest.mark.parametrize("order, limit", [("files", 128 << 20), ("global", -1), ("files", -1), ("global", 200_000)])
def test_layers_are_the_same_however_they_are_joined_and_ordered(spark, lake, reference_layers, order, limit):
    cfg, report = run(spark, lake, order, limit)
    layers, expected = reference_layers
    assert report == expected
    for table, rows in layers.items():
        assert sorted(map(str, read_layer(spark, cfg, table).collect())) == rows


def test_silver_files_are_sorted_and_a_hot_order_id_spans_several(spark, lake):
    with settings(spark, spark__sql__shuffle__partitions="8",
                  spark__sql__adaptive__coalescePartitions__enabled="false"):
        cfg, report = run(spark, lake)
    files = sorted(Path(cfg.partition_path(SILVER_TABLE)).glob("*.parquet"))
    pieces = [[r.pedido_id for r in spark.read.parquet(str(f)).select("pedido_id").collect()] for f in files]
    pieces = [p for p in pieces if p]
    assert sum(map(len, pieces)) == report.silver
    assert all(p == sorted(p) for p in pieces)
    assert all(a[-1] <= b[0] for a, b in zip(pieces, pieces[1:]))
    assert max(map(len, pieces)) < report.silver / 4
    assert sum(5 in p for p in pieces) > 1


def test_more_rows_make_more_silver_files(spark, lake):
    with settings(spark, spark__sql__shuffle__partitions="2"):
        cfg, report = run(spark, lake, silver_rows_per_file=5_000)
    assert len(list(Path(cfg.partition_path(SILVER_TABLE)).glob("*.parquet"))) == -(-report.silver // 5_000)


def test_rows_of_a_task_are_bounded_whatever_their_bytes(spark, lake, monkeypatch):
    """One task neither sorts more rows of silver than set, nor counts the orders of more, although AQE would merge them."""
    monkeypatch.setattr(jobs, "SORTED_ROWS", 500)
    monkeypatch.setattr(gold, "DISTINCT_ROWS", 500)
    whole = build_gold(read_layer(spark, run(spark, lake)[0], SILVER_TABLE)).collect()
    cfg, report = run(spark, lake)
    files = list(Path(cfg.partition_path(SILVER_TABLE)).glob("*.parquet"))
    assert report.silver > 8 * 500 and len(files) == -(-report.silver // 500)
    silver = read_layer(spark, cfg, SILVER_TABLE)
    dealt = build_gold(silver, rows=report.silver)
    assert dealt.collect() == whole == read_layer(spark, cfg, GOLD_TABLE).orderBy(
        F.desc("receita_total"), "uf", "categoria").collect()
    assert f", {-(-report.silver // 500)})" in plan(dealt) and "REPARTITION_BY_NUM" in plan(dealt)


def test_a_run_of_millions_is_cut_in_small_tasks(spark, lake, monkeypatch):
    """What the audits of a run share: silver sorts half a million rows a task, gold counts the orders of a quarter."""
    cfg, _ = run(spark, lake)
    cut = []
    monkeypatch.setattr(jobs, "range_by_order", lambda rows, files, spread: cut.append(files) or rows)
    staged = spark.createDataFrame([], f"{PEDIDOS_TEXT.simpleString()[7:-1]},{REASON}:string".replace(":", " "))
    staged.write.parquet(f"{lake}/staged")
    dims = measure_order_dimensions(*dimensions(spark))
    jobs.write_silver(spark, cfg, spark.read.parquet(f"{lake}/staged"), 3_000_000, *dims)
    assert cut == [6]
    silver = read_layer(spark, cfg, SILVER_TABLE)
    assert ", 12), REPARTITION_BY_NUM" in plan(build_gold(silver, rows=3_000_000))
    assert "REPARTITION_BY_NUM" not in plan(build_gold(silver, rows=1_000_000))


def test_a_shuffle_to_more_tasks_does_not_make_its_writers_hold_rows():
    """Up to 200 partitions are written as the rows come, so up to 200 million rows make no more; a task never has over a million."""
    assert [tasks_for(n, 250_000) for n in (0, 1, 1_000_000, 36_000_000, 72_000_000, 200_000_000, 200_000_001)] == [
        0, 1, 4, 144, 200, 200, 201]
    assert tasks_for(10 ** 11, 250_000) == 10 ** 5 and tasks_for(36_000_000, 5_000, 5_000) == 7_200


def test_order_of_files_is_seen_across_blocks(spark, lake):
    """Rows before a smaller one are found inside blocks and where blocks meet, however the rows are dealt."""
    ids = [1, 5, 5, 4, 9, 3, 3, 8, None, 2, 7, 6]
    spark.createDataFrame([(i,) for i in ids], "pedido_id long").coalesce(1).write.parquet(f"{lake}/one")
    spark.createDataFrame([(i,) for i in (0, 9, 8)], "pedido_id long").coalesce(1).write.mode("append").parquet(f"{lake}/one")
    rows = spark.read.parquet(f"{lake}/one")
    expected = sum(a is not None and b is not None and a > b for a, b in zip(ids, ids[1:])) + 1
    for block in (1, 2, 3, 5, 12, 100):
        for task_rows in (2, 1000):
            assert tuple(_out_of_order(rows, block, task_rows).first()) == (15, expected)


def test_audit_scans_are_pruned_to_the_date(spark, lake):
    cfg, _ = run(spark, lake)
    create_catalog(spark, cfg)
    layers = catalog_layers(spark, cfg)
    for name, df in layers.tables().items():
        text = plan(df)
        assert f"= {D})" in text.split("PartitionFilters")[1].split("]")[0], name
    gold_input = plan(read_layer(spark, cfg, SILVER_TABLE).groupBy("uf").agg(F.sum("valor_total")))
    assert "ReadSchema: struct<uf:string,valor_total:double>" in gold_input


def test_dimension_join_is_broadcast_only_within_the_limit(spark, lake):
    orders, (clientes, produtos) = hot_orders(spark), dimensions(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        within = plan(check_and_enrich(orders, clientes, produtos, broadcast_limit=1 << 20).flagged())
        beyond = plan(check_and_enrich(orders, clientes, produtos, broadcast_limit=1000).flagged())
        keys = plan(check_orders(orders, clientes, produtos).flagged())
    assert within.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in within
    assert keys.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in keys
    assert "BroadcastHashJoin" not in beyond and beyond.count("SortMergeJoin") == 2


def test_staging_is_emptied_after_a_good_run(spark, lake):
    cfg, _ = run(spark, lake)
    assert not any(Path(staging_path(spark, cfg)).iterdir())


def test_settings_follow_the_input():
    small, large = recommended_conf(), recommended_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "40000"
    assert (100 << 40) // int(large["spark.sql.files.maxPartitionBytes"]) <= 200_000
    assert recommended_conf(10 << 30)["spark.sql.shuffle.partitions"] == "80"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = {files.apply(n).getName(): files.apply(n).length() for n in range(files.size())}
    return {n: size for n, size in found.items() if n.startswith("shuffle_") and n.endswith(".data")}


def test_a_run_leaves_no_shuffle_files_behind(spark, lake):
    """The next step, or the run of the next date, has the room that finished ones took."""
    cfg, raw = PipelineConfig(lake, D, broadcast_limit=1), raw_frames(spark, SMALL)
    before = shuffle_files(spark)

    def left(most):
        until = time.time() + 15
        while True:
            size = sum(size for name, size in shuffle_files(spark).items() if name not in before)
            if size <= most or time.time() > until:
                return size
            time.sleep(0.2)

    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        write_raw(cfg, raw.clientes, raw.produtos, raw.pedidos)
        assert left(0) == 0
        run_process(spark, cfg)
        assert left(5000) <= 5000  # the counts of the last query


def test_the_silver_shuffle_carries_what_silver_has(spark, lake, monkeypatch):
    carried = []
    ranged = jobs.range_by_order

    def spy(rows, *args, **named):
        carried.append(set(rows.columns))
        return ranged(rows, *args, **named)

    monkeypatch.setattr(jobs, "range_by_order", spy)
    cfg, raw = PipelineConfig(lake, D), raw_frames(spark, SMALL)
    write_raw(cfg, raw.clientes, raw.produtos, raw.pedidos)
    run_process(spark, cfg)
    assert carried == [{"pedido_id", "cliente_id", "product_id", "quantidade", "data_pedido", "__place"}]
