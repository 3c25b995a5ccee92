"""Every operator as a query over the driver's tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.config import PipelineConfig
from sedimenta.functions.numeric import money_sum, round2, safe_number
from sedimenta.operators import audit, gates
from sedimenta.operators.audit_sql import AUDIT_SQL, audit_by_sql
from sedimenta.operators.gold import build_gold, gold_top
from sedimenta.operators.quality import (
    BAD_QUANTITY, REASON, UNKNOWN_CUSTOMER, UNKNOWN_PRODUCT, CheckedRows, ExistsRule, PositiveRule, PresentRule,
    apply_quality, check_and_enrich, check_orders, check_rows, reason_counts,
)
from sedimenta.operators.lookups import LaidOut, hot_keys, join_laid_out, lay_out, require_unique
from sedimenta.operators.sampling import exact_sample, place_hash, value_hash
from sedimenta.operators.sketches import distinct_orders, relative_error
from sedimenta.operators.silver import (
    CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES, build_silver, measure_order_dimensions, silver_projection,
)
from sedimenta.plans.jobs import SORTED_ROWS, run_audit, run_process, write_raw
from sedimenta.schemas import (
    GOLD_TABLE, PEDIDOS, QUARANTINE_TABLE, RAW_CLIENTES, RAW_LINE, RAW_PEDIDOS, RAW_PRODUTOS, SILVER_COLUMNS, SILVER_TABLE,
)
from sedimenta.sinks.layers import quarantine_projection, write_partition
from sedimenta.sources.adapters import RawFrames, orders, raw_frames, read_table
from sedimenta.sources.catalog import catalog_layers, create_catalog, table_name
from sedimenta.sources.layers import read_layer, read_raw, read_sketches
from sedimenta.sources.scratch import new_scratch

INGEST_DATE = "2026-09-20"
NEXT_DATE = "2026-09-21"
SAMPLE_SEED, SAMPLE_RATE = 42, 0.03
# Rows of a file whose order is looked at together.
ORDER_BLOCK = 1 << 16

Query = Callable[[SparkSession, str], DataFrame]


# --- frames shared by the queries ---------------------------------------------------------

def _checked(raw: RawFrames) -> CheckedRows:
    return check_orders(raw.pedidos, raw.clientes, raw.produtos)


def _enriched(raw: RawFrames) -> DataFrame:
    return check_and_enrich(raw.pedidos, raw.clientes, raw.produtos).valid(with_attributes=True)


def _silver(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return silver_projection(_enriched(raw_frames(spark, sf_dir)), *extra)


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(raw_frames(spark, sf_dir)).rejected()


def _scratch_config(spark: SparkSession) -> PipelineConfig:
    base = new_scratch(spark)
    tag = "".join(c for c in base.rsplit("/", 1)[-1] if c.isalnum())
    return PipelineConfig(base, INGEST_DATE, database=f"medallion_{tag}")


def _written_raw(spark: SparkSession, sf_dir: str, anomalies: bool = True) -> PipelineConfig:
    cfg = _scratch_config(spark)
    raw = raw_frames(spark, sf_dir, anomalies)
    write_raw(cfg, raw.clientes, raw.produtos, raw.pedidos)
    return cfg


def _published(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    cfg = _written_raw(spark, sf_dir)
    run_process(spark, cfg)
    return cfg


# --- quality ------------------------------------------------------------------------------

def dq_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(raw_frames(spark, sf_dir)).flagged()


def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frames(spark, sf_dir)
    return apply_quality(raw.pedidos, raw.clientes, raw.produtos)[0]


def dq_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frames(spark, sf_dir)
    return apply_quality(raw.pedidos, raw.clientes, raw.produtos)[1]


def dq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_counts(_rejected(spark, sf_dir))


def dq_rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(raw_frames(spark, sf_dir)).rule_totals()


def dq_customer_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule engine on another table, with its own rules."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").where("n_regionkey <> 2")
    rules = [
        PositiveRule("SALDO_INVALIDO", "c_acctbal"),
        ExistsRule("NACAO_INEXISTENTE", "c_nationkey", nation, "n_nationkey"),
    ]
    return check_rows(customer, rules).flagged()


def dq_text_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities as text: numbers, fractions, words, markers and nulls."""
    raw = raw_frames(spark, sf_dir, anomalies=False)
    number = F.col("quantidade").cast("string")
    forms = [number, F.concat(number, F.lit(".5")), F.lit("0.5"), F.lit("abc"), F.lit("NaN"), F.lit("inf"),
             F.concat(number, F.lit("d")), F.concat(F.lit("-"), number), F.lit(""), F.lit(None).cast("string")]
    text = F.element_at(F.array(*forms), (F.col("pedido_id") % len(forms) + 1).cast("int"))
    raw = replace(raw, pedidos=raw.pedidos.withColumn("quantidade", text))
    return _judged(check_and_enrich(raw.pedidos, raw.clientes, raw.produtos).flagged())


def _judged(flagged: DataFrame) -> DataFrame:
    """Valid and rejected rows from one pass: line and total where valid, the quantity as both layers hold it."""
    good = F.col(REASON) == ""
    quantity = safe_number("quantidade", flagged.schema["quantidade"].dataType)
    return flagged.select(
        "pedido_id", F.when(good, F.col("linha")).alias("linha"), quantity.try_cast("long").alias("quantidade"),
        F.when(good, round2(quantity * F.col("preco"))).alias("valor_total"), REASON)


# --- silver and gold ----------------------------------------------------------------------

def silver_fato_vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "linha")


def silver_from_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The separate operators: split, gates, inner joins."""
    raw = raw_frames(spark, sf_dir)
    valid, _ = apply_quality(raw.pedidos, raw.clientes, raw.produtos)
    return build_silver(valid, raw.clientes, raw.produtos, "linha")


def _order_lines(spark: SparkSession, sf_dir: str) -> int:
    """About as many rows as silver has, from the footers of the files."""
    return read_table(spark, sf_dir, "lineitem").count()


def gold_uf_categoria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold(_silver(spark, sf_dir), rows=_order_lines(spark, sf_dir))


def gold_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_top(gold_uf_categoria(spark, sf_dir))


def gold_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold that keeps the groups without a state."""
    return build_gold(_without_some_states(spark, sf_dir), drop_null_keys=False, rows=_order_lines(spark, sf_dir))


def _without_some_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).withColumn("uf", F.when(F.col("cliente_id") % 7 != 0, F.col("uf")))


# --- gates and audits ---------------------------------------------------------------------

def gate_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    return gates.duplicate_keys(lines, "l_orderkey", "l_linenumber")


def gate_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reconciliation_of_flagged(_checked(raw_frames(spark, sf_dir)).flagged())


def audit_quarantine_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.quarantine_sample(_rejected(spark, sf_dir), "linha")


def audit_silver_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.silver_validity(_silver(spark, sf_dir))


def audit_validity_tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 over a silver fact with spoiled quantities and totals."""
    silver = _silver(spark, sf_dir)
    key = F.col("pedido_id")
    return audit.silver_validity(
        silver.withColumn("quantidade", F.when(key % 50 == 0, F.lit(0)).otherwise(F.col("quantidade")))
        .withColumn("valor_total", F.when(key % 40 == 0, F.col("valor_total") + 1).otherwise(F.col("valor_total"))))


def audit_silver_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frames(spark, sf_dir)
    # Measured once, for the rules and for the audit.
    customer, product = measure_order_dimensions(raw.clientes, raw.produtos)
    silver = silver_projection(check_and_enrich(raw.pedidos, customer, product).valid(with_attributes=True))
    return audit.silver_orphans(silver, customer, product)


def audit_orphans_tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 over the unchecked orders."""
    raw = raw_frames(spark, sf_dir)
    return audit.silver_orphans(raw.pedidos, raw.clientes, raw.produtos)


def orphan_detail_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_frames(spark, sf_dir)
    return audit.orphan_detail(raw.pedidos, raw.clientes, raw.produtos)


def audit_silver_vs_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.silver_against_its_gold(_silver(spark, sf_dir))


def audit_gold_lost_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 where the gold layer left out the rows without a state."""
    return audit.silver_against_its_gold(_without_some_states(spark, sf_dir))


# --- dimensions laid out by key -------------------------------------------------------------

def _laid_out(spark: SparkSession, raw: RawFrames) -> tuple[LaidOut, LaidOut]:
    base = new_scratch(spark)
    tag = "".join(c for c in base.rsplit("/", 1)[-1] if c.isalnum())
    made = []
    for name, frame, key in (("clientes", raw.clientes, "cliente_id"), ("produtos", raw.produtos, "product_id")):
        require_unique(frame, key)
        made.append(lay_out(frame, key, f"{name}_{tag}", f"{base}/{name}"))
    return made[0], made[1]


def _looked_up(orders: DataFrame, customers: LaidOut, products: LaidOut, with_attributes: bool) -> DataFrame:
    """The orders with the keys, and columns, of both dimensions. The orders are made once and kept, as they are counted,
    searched for the hot keys of both dimensions, and joined; a join with unique keys changes none of these."""
    path = f"{new_scratch(orders.sparkSession)}/pedidos"
    orders.write.parquet(path)
    orders = rows = orders.sparkSession.read.schema(orders.schema).parquet(path)
    for dimension, attributes in ((customers, CUSTOMER_ATTRIBUTES), (products, PRODUCT_ATTRIBUTES)):
        rows = join_laid_out(rows, dimension, dimension.key, f"__{dimension.key}", hot_keys(orders, dimension.key),
                             attributes if with_attributes else None)
    return rows


def silver_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver fact by joins with bucketed dimensions."""
    raw = raw_frames(spark, sf_dir)
    joined = _looked_up(raw.pedidos, *_laid_out(spark, raw), True)
    rules = [PositiveRule(BAD_QUANTITY, "quantidade"), PresentRule(UNKNOWN_CUSTOMER, "__cliente_id"),
             PresentRule(UNKNOWN_PRODUCT, "__product_id")]
    return silver_projection(check_rows(joined, rules).valid(), "linha")


def orphans_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 over the unchecked orders, by the same layout."""
    raw = raw_frames(spark, sf_dir)
    # The audit looks at the keys alone; the line tells the rows of a hot key apart.
    keys = raw.pedidos.select("pedido_id", "linha", "cliente_id", "product_id")
    joined = _looked_up(keys, *_laid_out(spark, raw), False)
    missing = F.col("__cliente_id").isNull() | F.col("__product_id").isNull()
    return joined.where(missing).agg(F.count(F.lit(1)).alias("silver_sem_cliente_ou_produto"))


# --- samples and sketches -----------------------------------------------------------------

SAMPLED = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def sample_exact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly three of a hundred order lines, the whole number below."""
    lines = read_table(spark, sf_dir, "lineitem")
    # The amounts are told apart as whole cents, which any engine writes alike.
    keyed = lines.withColumn("centavos", F.rint(F.col("l_extendedprice") * 100).cast("long")).withColumn(
        "qtd", F.col("l_quantity").cast("long"))
    value = value_hash(keyed, SAMPLE_SEED, *SAMPLED, "qtd", "centavos")
    return exact_sample(keyed, int(lines.count() * SAMPLE_RATE), value, place_hash(SAMPLE_SEED)).select(*SAMPLED, "qtd", "centavos")


def sketch_distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders per state and category of a published run, and whether its stored sketch comes near enough."""
    cfg = replace(_written_raw(spark, sf_dir), order_sketches=True)
    run_process(spark, cfg)
    return _near(read_layer(spark, cfg, GOLD_TABLE).select("uf", "categoria", "qtd_pedidos"),
                 distinct_orders(read_sketches(spark, cfg)), "uf", "categoria")


def sketch_orders_of_two_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders per state of two dates, whose orders overlap, from the stored sketches alone."""
    first = replace(_written_raw(spark, sf_dir), order_sketches=True)
    second = replace(first, ingest_date=NEXT_DATE)
    raw = raw_frames(spark, sf_dir, anomalies=False)
    write_raw(second, raw.clientes, raw.produtos, raw.pedidos)
    for cfg in (first, second):
        run_process(spark, cfg)
    rows = read_layer(spark, first, SILVER_TABLE).unionAll(read_layer(spark, second, SILVER_TABLE))
    exact = rows.groupBy("uf").agg(F.count_distinct("pedido_id").alias("qtd_pedidos"))
    return _near(exact, distinct_orders(read_sketches(spark, first, INGEST_DATE, NEXT_DATE), "uf"), "uf")


def _near(exact: DataFrame, estimated: DataFrame, *keys: str) -> DataFrame:
    off = F.abs(F.col("qtd_pedidos_estimada") - F.col("qtd_pedidos"))
    return exact.join(estimated, list(keys), "full").select(
        *keys, "qtd_pedidos", (off <= F.ceil(4 * relative_error() * F.col("qtd_pedidos"))).alias("dentro_do_erro"))


# --- files and catalog --------------------------------------------------------------------

def audit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 as far as it is the same in every run: folders of the tables, whether all files have bytes, and rows."""
    cfg = _published(spark, sf_dir)
    create_catalog(spark, cfg)
    files = audit.physical_files(catalog_layers(spark, cfg))
    folder = F.regexp_extract("arquivo_s3", "/([^/]+/[^/]+/[^/]+=[^/]+)/[^/]+$", 1)
    return files.groupBy("tabela", folder.alias("pasta")).agg(
        F.bool_and(F.col("tamanho_bytes") > 0).alias("com_bytes"), F.sum("linhas").alias("linhas"))


def audit_files_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 without the run-dependent path and size."""
    return audit_files(spark, sf_dir).groupBy("tabela").agg(F.sum("linhas").alias("linhas"))


def _exported(title: str) -> Query:
    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _published(spark, sf_dir)
        schema = run_audit(spark, cfg, titles=[title])[title].schema
        return spark.read.schema(schema).option("header", True).csv(f"{cfg.base_uri}/reports/{title}.csv")

    read_back.__name__ = "audit_reports_exported" if title == "Q2" else f"audit_report_{title.lower()}"
    read_back.__doc__ = f"{title} of a run, read back from its exported CSV."
    return read_back


def _by_sql(title: str) -> Query:
    def of_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _published(spark, sf_dir)
        create_catalog(spark, cfg)
        return audit_by_sql(spark, cfg, title)

    of_catalog.__name__ = f"audit_sql_{title.lower()}"
    of_catalog.__doc__ = f"{title} by its SQL text, over the catalog of a published run."
    return of_catalog


def audit_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 over catalog tables whose raw keys are written like ``7.0``: nothing is missing."""
    cfg = _scratch_config(spark)
    raw = raw_frames(spark, sf_dir)
    for table, df in ((RAW_CLIENTES, raw.clientes), (RAW_PRODUTOS, raw.produtos), (RAW_PEDIDOS, raw.pedidos)):
        text = [F.concat(F.col(f.name).cast("string"), F.lit(".0")).alias(f.name) if f.name.endswith("_id")
                else F.col(f.name) for f in table.schema]
        write_partition(df.select(*text), cfg, table)
    run_process(spark, cfg)
    return run_audit(spark, cfg, export=False, titles=["Q6"])["Q6"]


def dq_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with spoiled keys and extra fields, through the whole job: what is published of them, and the lines
    of those that are not."""
    cfg = _scratch_config(spark)
    raw = raw_frames(spark, sf_dir, anomalies=False)
    write_raw(cfg, raw.clientes, raw.produtos, raw.pedidos)
    order, line = F.col("pedido_id").cast("string"), F.col("linha").cast("string")
    customer, product = F.col("cliente_id").cast("string"), F.col("product_id").cast("string")
    kind = F.col("pedido_id") % 8
    ids = F.when(kind == 1, F.concat(F.lit("X"), order)).when(kind == 2, F.concat(order, F.lit(".5"))).when(
        kind == 3, F.concat(order, F.lit(".0"))).otherwise(order)
    customers = F.when(kind == 4, F.concat(customer, F.lit("abc"))).when(
        kind == 5, F.concat(customer, F.lit(".0"))).otherwise(customer)
    extra = F.when(kind == 6, F.lit(",extra")).otherwise(F.lit(""))
    text = F.concat_ws(",", ids, customers, product, line, F.col("data_pedido"))
    lines = raw.pedidos.select(F.concat(text, extra).alias("value"))
    header = ",".join(PEDIDOS.fieldNames())
    folder = cfg.partition_path(RAW_PEDIDOS)
    # Every file starts with the header, as a CSV writer would have it.
    lines.select(F.col("value").alias(header)).write.mode("overwrite").options(
        header=True, quote="", escapeQuotes=False, sep="\u0001").csv(folder)
    run_process(spark, cfg)
    silver = read_layer(spark, cfg, SILVER_TABLE).select(
        "pedido_id", "cliente_id", "product_id", "quantidade", F.lit("").alias(REASON),
        F.lit(None).cast("string").alias(RAW_LINE))
    schema = f"{QUARANTINE_TABLE.schema.simpleString()[7:-1]},{RAW_LINE}:string"
    bad = spark.read.schema(schema.replace(":", " ")).json(cfg.partition_path(QUARANTINE_TABLE))
    return silver.unionByName(bad.select("pedido_id", "cliente_id", "product_id", "quantidade", REASON, RAW_LINE))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run reports of itself, one row a count."""
    cfg = _written_raw(spark, sf_dir)
    report = run_process(spark, cfg)
    counts = {"raw": report.raw, "valid": report.valid, "rejected": report.rejected, "silver": report.silver,
              "gold": report.gold, **report.reasons}
    return spark.createDataFrame(list(counts.items()), "contagem string, linhas long")


def silver_files_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the published silver layer, and how many come after a larger order id in their own file."""
    return _out_of_order(read_layer(spark, _published(spark, sf_dir), SILVER_TABLE))


def _out_of_order(silver: DataFrame, block: int = ORDER_BLOCK, task_rows: int = SORTED_ROWS) -> DataFrame:
    """Files are looked at in blocks of rows. The last row of a block also opens the next one, where it is not counted."""
    place = F.col("_metadata.row_index")
    opens = F.when((place + 1) % block == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = silver.select("pedido_id", F.col("_metadata.file_name").alias("arquivo"), place.alias("lugar"),
                         F.explode(opens).alias("seguinte"))
    rows = rows.withColumn("bloco", F.floor(F.col("lugar") / block) + F.col("seguinte"))
    rows = rows.repartition(-(-silver.count() // task_rows) or 1, "arquivo", "bloco")
    before = F.lag("pedido_id").over(Window.partitionBy("arquivo", "bloco").orderBy("lugar"))
    own = F.col("seguinte") == 0
    return rows.withColumn("antes", before).agg(
        F.count(F.when(own, 1)).alias("linhas"),
        F.count(F.when(own & (F.col("antes") > F.col("pedido_id")), 1)).alias("fora_de_ordem"))


def roundtrip_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _scratch_config(spark)
    write_partition(orders(spark, sf_dir).select(*PEDIDOS.fieldNames()), cfg, RAW_PEDIDOS)
    return read_raw(spark, cfg, RAW_PEDIDOS).withColumn("quantidade", F.col("quantidade").cast("long"))


def roundtrip_quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _scratch_config(spark)
    write_partition(quarantine_projection(_rejected(spark, sf_dir)), cfg, QUARANTINE_TABLE)
    return read_layer(spark, cfg, QUARANTINE_TABLE)


def roundtrip_silver_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _scratch_config(spark)
    write_partition(_silver(spark, sf_dir), cfg, SILVER_TABLE)
    return read_layer(spark, cfg, SILVER_TABLE).select(*SILVER_COLUMNS)


def published_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole process job over written raw files, read back from its gold layer."""
    return read_layer(spark, _published(spark, sf_dir), GOLD_TABLE)


def published_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, _published(spark, sf_dir), SILVER_TABLE)


def idempotent_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one date: the second, over clean orders, replaces every layer and empties the quarantine."""
    cfg = _published(spark, sf_dir)
    raw = raw_frames(spark, sf_dir, anomalies=False)
    write_raw(cfg, raw.clientes, raw.produtos, raw.pedidos)
    run_process(spark, cfg)
    return audit.reconciliation(
        read_raw(spark, cfg, RAW_PEDIDOS, blank_missing=False),
        read_layer(spark, cfg, SILVER_TABLE), read_layer(spark, cfg, QUARANTINE_TABLE))


def partition_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second date adds a partition; the catalog table sees both as strings."""
    first = _published(spark, sf_dir)
    second = replace(first, ingest_date=NEXT_DATE)
    raw = raw_frames(spark, sf_dir, anomalies=False)
    write_raw(second, raw.clientes, raw.produtos, raw.pedidos)
    run_process(spark, second)
    create_catalog(spark, second, repair=True)
    return spark.table(table_name(second, SILVER_TABLE)).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("linhas"))


def versioned_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the silver table, read by its name, before and after a rerun over clean orders swaps its version."""
    cfg = replace(_written_raw(spark, sf_dir), versioned=True)
    run_process(spark, cfg)
    create_catalog(spark, cfg)

    def seen(moment: str) -> DataFrame:
        rows = catalog_layers(spark, cfg).silver_fato_vendas
        return rows.agg(F.lit(moment).alias("momento"), F.count(F.lit(1)).alias("linhas"),
                        money_sum(F.col("valor_total")).alias("receita"))

    # One row, kept as it was: a table read by its name follows the version.
    before = seen("antes")
    before = spark.createDataFrame(before.collect(), before.schema)
    raw = raw_frames(spark, sf_dir, anomalies=False)
    write_raw(cfg, raw.clientes, raw.produtos, raw.pedidos)
    run_process(spark, cfg)
    return before.unionAll(seen("depois"))


def catalog_quarantine_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON catalog table, pruned to one date."""
    cfg = _published(spark, sf_dir)
    create_catalog(spark, cfg)
    return catalog_layers(spark, cfg).quarantine_pedidos_rejeitados


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    dq_flagged, dq_valid, dq_rejected, dq_reason_counts, dq_rule_totals, dq_customer_quality, dq_text_quantities,
    silver_fato_vendas, silver_from_valid, gold_uf_categoria, gold_top10, gold_null_keys,
    gate_duplicate_keys, gate_reconciliation,
    audit_quarantine_sample, audit_silver_validity, audit_validity_tampered, audit_silver_orphans,
    audit_orphans_tampered, orphan_detail_left_anti, audit_silver_vs_gold, audit_gold_lost_revenue,
    audit_files, audit_files_rows, *(_exported(f"Q{n}") for n in range(2, 9)),
    *(_by_sql(title) for title in AUDIT_SQL),
    dq_text_keys, audit_text_keys, run_counts, silver_files_sorted,
    roundtrip_raw_csv, roundtrip_quarantine_json, roundtrip_silver_parquet,
    published_gold, published_silver, idempotent_overwrite, partition_append, catalog_quarantine_scan, versioned_rerun,
    silver_bucketed, orphans_bucketed, sample_exact_lines, sketch_distinct_orders, sketch_orders_of_two_dates,
)}
