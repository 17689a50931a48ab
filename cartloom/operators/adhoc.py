"""Guarded read-only SQL and ready-made questions over the daily fact table."""

from __future__ import annotations

import datetime as dt
import re
import threading
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from cartloom.domains import FORBIDDEN_WORDS, NON_SALES_STATUSES
from cartloom.functions import last_complete_month, ratio_percent

_FORBIDDEN = re.compile(rf"\b(?:{'|'.join(FORBIDDEN_WORDS)})\b", re.IGNORECASE)

# Classes of parsed trees that only read. Everything else is refused, also what Spark may add later.
READ_NODES = frozenset(
    "Aggregate Distinct Except Filter GlobalLimit Intersect Join LocalLimit LocalRelation Offset OneRowRelation Project Sort SubqueryAlias Union "
    "UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedWith".split()
)
SUBQUERIES = frozenset("Exists ListQuery ScalarSubquery".split())
READ_EXPRESSIONS = SUBQUERIES | frozenset(
    "Add Alias And AttributeReference Between BitwiseAnd BitwiseNot BitwiseOr BitwiseXor CaseWhen Cast Concat CreateStruct CreateNamedStruct Cube "
    "CurrentRow Divide EqualNullSafe EqualTo GreaterThan GreaterThanOrEqual GroupingSets If ILike In InSubquery IntegralDivide IsNotNull "
    "IsNull LambdaFunction LessThan LessThanOrEqual Like LikeAll LikeAny Literal Multiply NamedParameter Not NotLikeAll NotLikeAny Or "
    "RLike Remainder Rollup SortOrder SpecifiedWindowFrame Subtract UnaryMinus UnaryPositive UnboundedFollowing UnboundedPreceding "
    "UnresolvedAlias UnresolvedAttribute UnresolvedExtractValue UnresolvedFunction UnresolvedNamedLambdaVariable UnresolvedStar "
    "UnspecifiedFrame WindowExpression WindowSpecDefinition".split()
)
JVM_FUNCTIONS = frozenset({"reflect", "java_method", "try_reflect"})


class ReadOnlyError(ValueError):
    """The text is not a plain SELECT on allowed views."""


class QueryTimeout(RuntimeError):
    """The result was not complete within the given time."""


def check_read_only(text: str) -> None:
    """Refuse texts that do not start with SELECT or contain a forbidden word anywhere."""
    words = text.split(maxsplit=1)
    if not words or words[0].upper() != "SELECT":
        raise ReadOnlyError("only SELECT statements are allowed")
    if _FORBIDDEN.search(text):
        raise ReadOnlyError("the statement contains a forbidden word")


def _all(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _class(thing) -> str:
    return thing.getClass().getSimpleName().rstrip("$")


def _refuse(what: str) -> None:
    raise ReadOnlyError(f"not allowed in a read-only query: {what}")


@dataclass(frozen=True)
class _Guard:
    """Walks the tree of a parsed statement; whatever is not listed is refused."""

    functions: frozenset[str]

    def plan(self, node, names: frozenset[str]) -> None:
        kind = _class(node)
        if kind not in READ_NODES:
            _refuse(kind)
        if kind == "UnresolvedRelation":
            parts = list(_all(node.multipartIdentifier()))
            if len(parts) != 1 or parts[0].lower() not in names or not node.options().isEmpty() or node.isStreaming():
                _refuse(".".join(parts))
        if kind == "UnresolvedWith":
            if node.allowRecursion():
                _refuse("a recursive query")
            for relation in _all(node.cteRelations()):  # each one sees those before it
                self.plan(relation._2(), names)
                names = names | {relation._1().lower()}
        for expression in _all(node.expressions()):
            self.expression(expression, names)
        for child in _all(node.children()):
            self.plan(child, names)

    def expression(self, node, names: frozenset[str]) -> None:
        kind = _class(node)
        if kind not in READ_EXPRESSIONS:
            _refuse(kind)
        if kind == "UnresolvedFunction":
            parts = list(_all(node.nameParts()))
            if len(parts) != 1 or parts[0].lower() not in self.functions:
                _refuse(f"function {'.'.join(parts)}")
        if kind in SUBQUERIES:
            self.plan(node.plan(), names)
        for child in _all(node.children()):
            self.expression(child, names)


def check_sources(spark: SparkSession, text: str, views: Iterable[str]) -> None:
    """Refuse parsed texts that read anything but ``views`` or do anything but plain querying.

    Nodes, expressions and functions of the parsed tree must be listed ones, subqueries and CTEs
    included. Files, other tables, table functions, scripts, computed names (``IDENTIFIER``) and functions
    that are not Spark's own, or that call JVM methods, never reach the analyzer.
    """
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    registry = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin()
    own = frozenset(f.funcName().lower() for f in _all(registry.listFunction()))
    _Guard(own - JVM_FUNCTIONS).plan(parsed, frozenset(v.lower() for v in views))


def check_leaves(result: DataFrame, views: Iterable[str]) -> None:
    """Refuse an analysed query with a leaf that is neither below an allowed view nor without rows of its own."""
    allowed = {v.lower() for v in views}

    def walk(node, above: str) -> None:
        kind = _class(node)
        if kind == "View" and above in allowed:
            return
        name = node.alias().lower() if kind == "SubqueryAlias" else ""
        children = list(_all(node.children()))
        if not children and kind not in ("OneRowRelation", "LocalRelation", "CTERelationRef"):
            _refuse(kind)
        for child in [*children, *_subplans(node)]:
            walk(child, name)

    def _subplans(node) -> list:
        plans, todo = [], list(_all(node.expressions()))
        while todo:
            expression = todo.pop()
            if _class(expression) in SUBQUERIES:
                plans.append(expression.plan())
            todo += _all(expression.children())
        return plans

    walk(result._jdf.queryExecution().analyzed(), "")


def read_only_sql(
    spark: SparkSession, text: str, args: dict[str, Any] | None = None, max_rows: int | None = None,
    views: Iterable[str] | None = None,
) -> DataFrame:
    """Run a SELECT over ``views`` (default: the session's temporary views).

    ``args`` bind named parameters (``:name``) as values, never as text. The result is whole unless
    the caller bounds it by ``max_rows``.
    """
    check_read_only(text)
    if views is None:
        views = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    check_sources(spark, text, views)
    result = spark.sql(text, args=args)
    check_leaves(result, views)
    return result if max_rows is None else result.limit(max_rows)


def fetch_within(result: DataFrame, seconds: float) -> list[Row]:
    """All rows of a result, or :class:`QueryTimeout`: never fewer rows."""
    context = result.sparkSession.sparkContext
    group, late = f"ad-hoc-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        context.cancelJobGroup(group)

    timer = threading.Timer(seconds, cancel)
    context.setJobGroup(group, "ad-hoc query", interruptOnCancel=True)
    timer.start()
    try:
        rows = result.collect()
    except Exception as error:
        if late.is_set():
            raise QueryTimeout(f"no complete result within {seconds} seconds") from error
        raise
    finally:
        timer.cancel()
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)
    if late.is_set():
        raise QueryTimeout(f"no complete result within {seconds} seconds")
    return rows


def preview(result: DataFrame, rows: int | None = None) -> DataFrame:
    """All rows, or the first ``rows``, with fractions rounded to two decimals."""
    fractional = (DecimalType, DoubleType, FloatType)
    shown = result.select(*[
        F.round(f.name, 2).alias(f.name) if isinstance(f.dataType, fractional) else F.col(f.name)
        for f in result.schema
    ])
    return shown if rows is None else shown.limit(rows)


def preview_text(result: DataFrame, rows: int) -> str:
    """The first ``rows`` rows as a text table with the true row count beside them."""
    count = result.count()
    if not count:
        return "Query returned no results."
    lines = [result.columns, ["---"] * len(result.columns)]
    lines += [["" if v is None else str(v) for v in row] for row in preview(result, rows).collect()]
    table = "\n".join(f"| {' | '.join(line)} |" for line in lines)
    more = f"; showing first {rows}." if count > rows else "."
    return f"{table}\n\n{count} row(s) returned{more}"


def sales_only(mart: DataFrame) -> DataFrame:
    """Without returned and cancelled orders; a status of NULL counts as neither."""
    status = F.col("shipping_status")
    return mart.where(status.isNull() | ~status.isin(NON_SALES_STATUSES))


def _totals() -> list[Column]:
    """Orders, units and amounts can be added up; distinct customers cannot."""
    return [
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_discounts_given").alias("total_discounts_given"),
    ]


def last_month_performance(mart: DataFrame, as_of: dt.date) -> DataFrame:
    """How did we do in the last complete month? One row, NULL sums for a month without sales."""
    year, month = last_complete_month(as_of)
    rows = sales_only(mart).where((F.col("order_year") == year) & (F.col("order_month") == month))
    return rows.agg(*_totals()).select(
        F.lit(f"{year}-{month:02d}").alias("order_year_month"), "*",
        ratio_percent(F.col("total_discounts_given"), F.col("total_revenue")).alias("discount_rate_pct"),
    )


def _ranked(rows: DataFrame, by: str, measure: str) -> DataFrame:
    return rows.groupBy(by).agg(*_totals()).orderBy(F.col(measure).desc(), by)


def best_selling_products(mart: DataFrame) -> DataFrame:
    """Which product sells the most? All products by units, then by name."""
    return _ranked(sales_only(mart), "product_name", "total_units_sold")


def best_stores(mart: DataFrame) -> DataFrame:
    """Which store performs best? All stores by revenue, then by name."""
    return _ranked(sales_only(mart), "store_name", "total_revenue")


def store_revenue_this_year(mart: DataFrame, as_of: dt.date) -> DataFrame:
    """Revenue by store in the year of ``as_of``."""
    return _ranked(sales_only(mart).where(F.col("order_year") == as_of.year), "store_name", "total_revenue")


def monthly_revenue(mart: DataFrame) -> DataFrame:
    """The time series by ``order_year_month``."""
    return sales_only(mart).groupBy("order_year_month").agg(*_totals()).orderBy("order_year_month")
