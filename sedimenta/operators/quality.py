"""Row-level quality rules that name every reason a row is rejected for.

Rules are data. Each rule adds one boolean to the plan and the order of the
rules is the order of the reasons. An existence rule is a left outer join with
the reference keys: Spark broadcasts a small reference, and AQE splits the hot
keys of a large one, which it cannot do for an ``EXISTS`` (existence) join.
The same join can bring the reference's attributes along, so a checked row
needs no second join to be enriched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.numeric import safe_number
from sedimenta.operators.gates import BROADCAST_LIMIT, Dimension, key_lookups
from sedimenta.operators.silver import CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES, measure_order_dimensions

REASON = "motivo_rejeicao"
REASON_SEPARATOR = "; "
TOO_LARGE = 2.0**63
BAD_QUANTITY = "QUANTIDADE_INVALIDA"
UNKNOWN_CUSTOMER = "CLIENTE_INEXISTENTE"
UNKNOWN_PRODUCT = "PRODUTO_INEXISTENTE"
UNREADABLE = "LINHA_ILEGIVEL"


@dataclass(frozen=True)
class PositiveRule:
    """Violated unless the column holds a number above zero that fits a long; null and text violate it."""

    name: str
    column: str


@dataclass(frozen=True)
class PresentRule:
    """Violated where the column is null."""

    name: str
    column: str


@dataclass(frozen=True)
class ExistsRule:
    """Violated unless the column's value is a key of ``reference``; a null violates it.

    ``attributes`` maps output names to reference columns carried to the row;
    that needs ``unique_keys``, as ``gates`` checks them. Keys that may repeat
    are made distinct here.
    """

    name: str
    column: str
    reference: DataFrame
    key: str
    unique_keys: bool = False
    attributes: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.attributes and not self.unique_keys:
            raise ValueError(f"rule {self.name} carries attributes, so its reference needs unique keys")


Rule = PositiveRule | PresentRule | ExistsRule


@dataclass(frozen=True)
class CheckedRows:
    """Rows joined with their references, and one never-null boolean column per rule."""

    frame: DataFrame
    columns: tuple[str, ...]
    attributes: tuple[str, ...]
    violated: Mapping[str, Column]

    @property
    def reason(self) -> Column:
        parts = [F.when(broken, F.lit(name)) for name, broken in self.violated.items()]
        return F.concat_ws(REASON_SEPARATOR, *parts).alias(REASON)

    @property
    def any_violated(self) -> Column:
        return reduce(lambda a, b: a | b, self.violated.values())

    def flagged(self) -> DataFrame:
        """Every row, with attributes and its reasons (empty for a valid row)."""
        return self.frame.select(*self.columns, *self.attributes, self.reason)

    def valid(self, with_attributes: bool = False) -> DataFrame:
        # One filter per rule, so Catalyst turns the outer joins into inner joins and
        # pushes the row-level rules below them.
        kept = reduce(lambda df, broken: df.where(~broken), self.violated.values(), self.frame)
        return kept.select(*self.columns, *(self.attributes if with_attributes else ()))

    def rejected(self) -> DataFrame:
        return self.frame.where(self.any_violated).select(*self.columns, self.reason)

    def rule_totals(self) -> DataFrame:
        """Violations per rule in one pass; a row counts for each rule it breaks."""
        sums = [F.coalesce(F.sum(broken.cast("long")), F.lit(0)).alias(name)
                for name, broken in self.violated.items()]
        return self.frame.agg(*sums).unpivot([], list(self.violated), "regra", "violacoes")


def check_rows(rows: DataFrame, rules: Sequence[Rule]) -> CheckedRows:
    """Evaluate the rules over the rows as one plan."""
    frame, violated, attributes = rows, {}, []
    for number, rule in enumerate(rules):
        if isinstance(rule, PositiveRule):
            value = safe_number(rule.column, rows.schema[rule.column].dataType)
            # NaN sorts above infinity in Spark, so the upper bound removes both.
            good = (value > 0) & (value < TOO_LARGE)
            violated[rule.name] = ~F.coalesce(good, F.lit(False))
        elif isinstance(rule, PresentRule):
            violated[rule.name] = F.col(rule.column).isNull()
        else:
            key = f"__key_{number}"
            clash = set(rule.attributes) & {*rows.columns, *attributes}
            if clash:
                raise ValueError(f"attributes of rule {rule.name} clash with other columns: {sorted(clash)}")
            carried = [F.col(source).alias(name) for name, source in rule.attributes.items()]
            reference = rule.reference.select(F.col(rule.key).alias(key), *carried)
            if not rule.unique_keys:
                reference = reference.distinct()
            frame = frame.join(reference, F.col(rule.column) == F.col(key), "left")
            violated[rule.name] = F.col(key).isNull()
            attributes += rule.attributes
    return CheckedRows(frame, tuple(rows.columns), tuple(attributes), violated)


def order_rules(clientes: DataFrame, produtos: DataFrame, unique_keys: bool = False,
                customer_attributes: Mapping[str, str] | None = None,
                product_attributes: Mapping[str, str] | None = None) -> list[Rule]:
    """The three order rules; the existence rules can bring dimension columns of the silver fact."""
    return [
        PositiveRule(BAD_QUANTITY, "quantidade"),
        ExistsRule(UNKNOWN_CUSTOMER, "cliente_id", clientes, "cliente_id", unique_keys, customer_attributes or {}),
        ExistsRule(UNKNOWN_PRODUCT, "product_id", produtos, "product_id", unique_keys, product_attributes or {}),
    ]


def check_orders(pedidos: DataFrame, clientes: DataFrame, produtos: DataFrame,
                 broadcast_limit: int = BROADCAST_LIMIT) -> CheckedRows:
    """The order rules against the keys of the dimensions, which may repeat."""
    customers, products = key_lookups(
        broadcast_limit, clientes=(clientes, "cliente_id"), produtos=(produtos, "product_id"))
    return check_rows(pedidos, order_rules(customers, products, unique_keys=True))


def check_and_enrich(pedidos: DataFrame, clientes: DataFrame | Dimension, produtos: DataFrame | Dimension,
                     broadcast_limit: int = BROADCAST_LIMIT) -> CheckedRows:
    """The order rules, with all dimension columns brought along by the same two joins.

    Dimensions that come from ``measure_order_dimensions`` are not measured again.
    """
    measured = clientes, produtos
    if not all(isinstance(d, Dimension) for d in measured):
        measured = measure_order_dimensions(clientes, produtos)
    customer, product = (d.sized_for_join(broadcast_limit) for d in measured)
    return check_rows(pedidos, order_rules(customer, product, True, CUSTOMER_ATTRIBUTES, PRODUCT_ATTRIBUTES))


def apply_quality(pedidos: DataFrame, clientes: DataFrame, produtos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split orders into (valid, rejected); a rejected row carries all its reasons."""
    checked = check_orders(pedidos, clientes, produtos)
    return checked.valid(), checked.rejected()


def reason_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per combination of reasons, most frequent first."""
    return (
        rejected.groupBy(REASON).agg(F.count(F.lit(1)).alias("qtd"))
        .orderBy(F.desc("qtd"), F.asc_nulls_last(REASON))
    )
