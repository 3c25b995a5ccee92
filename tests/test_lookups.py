"""Joins with dimensions laid out by key, and reports as single files."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_jobs import config, put_raw

from sedimenta.operators.gates import DuplicateKeyError
from sedimenta.operators.lookups import hot_keys, join_laid_out, lay_out, require_unique
from sedimenta.plans.jobs import run_pipeline
from sedimenta.plans.queries import _looked_up
from sedimenta.sinks.layers import write_report


@pytest.fixture
def customers(spark, lake):
    rows = spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), F.lit("x").alias("city"))
    name = "dim_" + "".join(c for c in lake if c.isalnum())
    return lay_out(rows.unionAll(spark.createDataFrame([(None, "nobody", "x")], "k long, name string, city string")), "k", name, f"{lake}/dim", buckets=8)


@pytest.fixture
def facts(spark):
    """A third with one key, a sixth with none, a sixth with one that does not exist, the rest spread over 400 keys."""
    i = F.col("id")
    return spark.range(12_000).select(i.alias("id"), F.when(i % 6 < 2, 3).when(i % 6 == 3, F.lit(None)).when(
        i % 6 == 4, 9999).otherwise(i % 400).cast("long").alias("k"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def expected(facts):
    return Counter((r.id, r.k if r.k is not None and r.k < 500 else None, f"n{r.k}" if r.k is not None and r.k < 500 else None)
                   for r in facts.collect())


def test_every_row_finds_what_an_outer_join_finds(spark, facts, customers):
    hot = hot_keys(facts, "k", 100)
    assert sorted(r.k for r in hot.collect()) == [3, 9999]
    for keys in (hot, hot.where("false"), spark.range(0, 500).select(F.col("id").alias("k"))):
        joined = join_laid_out(facts, customers, "k", "found", keys, {"nome": "name"})
        assert joined.columns == ["id", "k", "found", "nome"]
        assert Counter((r.id, r.found, r.nome) for r in joined.collect()) == expected(facts)


def test_the_laid_out_side_is_not_shuffled(spark, facts, customers):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = spark.createDataFrame([(3,), (9999,)], "k long")
        joined = join_laid_out(facts, customers, "k", "found", hot, {"nome": "name"})
        plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # One exchange, of the facts: what lies between it and the scan of the facts. The hot keys are broadcast.
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") >= 1
    assert plan.count("Bucketed: true") >= 1
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("__spread" in line for line in shuffles) == 1 and not any("__key" in line for line in shuffles), plan


def test_hot_and_null_keys_do_not_meet_in_one_task(spark, facts, customers):
    hot = spark.createDataFrame([(3,), (9999,)], "k long")
    joined = join_laid_out(facts, customers, "k", "found", hot).withColumn("part", F.spark_partition_id())
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        sizes = [r["count"] for r in joined.groupBy("part").count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 12_000 and len(sizes) == 8 and max(sizes) < 2 * 12_000 / 8


def test_edges(spark, customers, facts):
    none = facts.where("false")
    assert join_laid_out(none, customers, "k", "found", hot_keys(none, "k")).count() == 0
    with pytest.raises(ValueError, match="there already"):
        join_laid_out(facts, customers, "k", "id", none.select("k"))
    with pytest.raises(DuplicateKeyError, match="occurs 2000 times"):
        require_unique(facts.where("k = 9999"), "k")
    require_unique(customers.frame(spark), "k")


def test_orders_are_made_once_for_all_passes(spark, customers, facts, lake):
    """Counting, hot keys and joins of both dimensions read the kept orders, not what the orders were made of."""
    name = "other_" + "".join(c for c in lake if c.isalnum())
    products = lay_out(spark.range(100).select(F.col("id").alias("p"), F.lit("z").alias("kind")), "p", name, f"{lake}/other", buckets=8)
    calls = spark.sparkContext.accumulator(0)

    def seen(rows):
        for batch in rows:
            calls.add(batch.num_rows)
            yield batch

    orders = facts.withColumn("p", F.col("id") % 120).mapInArrow(seen, "id long, k long, p long")
    joined = _looked_up(orders, customers, products, False)
    assert joined.where("__p is null").count() == 12_000 // 6
    assert joined.where("__k is null").count() == facts.where("k is null or k >= 500").count()
    assert calls.value == 12_000


# --- reports --------------------------------------------------------------------------------

def test_reports_are_single_named_files(spark, lake):
    cfg = config(lake)
    put_raw(cfg, "1,1,10,1,2026-01-01\n2,2,10,1,2026-01-01\n3,9,10,1,2026-01-01\n")
    _, reports = run_pipeline(spark, cfg)
    assert {p.name for p in Path(lake, "reports").glob("*.csv") if p.is_file()} == {f"Q{n}.csv" for n in range(1, 9)}
    for title, report in reports.items():
        lines = Path(lake, "reports", f"{title}.csv").read_text(encoding="utf-8").splitlines()
        assert lines[0] == ",".join(report.columns) and len(lines) == 1 + report.count()


def test_a_report_of_many_parts_is_one_file_in_order(spark, lake):
    rows = spark.range(5000).repartitionByRange(7, "id").sortWithinPartitions("id").withColumn("t", F.lit('a,"b"'))
    path = write_report(rows, lake, "")
    assert path.endswith("/reports/resultado.csv")
    assert len(list(Path(lake, "reports/resultado").glob("part-*"))) > 1
    lines = Path(path).read_text().splitlines()
    assert lines[0] == "id,t" and lines[1:] == [f'{n},"a,""b"""' for n in range(5000)]
    write_report(rows.where("id < 3"), lake, "")
    assert len(Path(path).read_text().splitlines()) == 4
    # Nothing stays but the file, what Spark wrote, and the checksum that a local file system keeps.
    assert {p.name for p in Path(lake, "reports").iterdir()} <= {"resultado", "resultado.csv", ".resultado.csv.crc"}
    assert spark.read.option("header", True).csv(path).count() == 3


def test_an_empty_report_has_its_header(spark, lake):
    assert Path(write_report(spark.createDataFrame([], "a long, b string"), lake, "Q9")).read_text() == "a,b\n"
