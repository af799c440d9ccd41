"""Ad-hoc SQL that can only read: a text is parsed, and its plan inspected, before anything of it runs.

Plans are made of relational nodes alone (no command, write, script or path), their tables are the named views and the
query's own WITH names, and their functions are built-in ones without reach beyond the row.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from typing import Any

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_CATALYST = "org.apache.spark.sql.catalyst"

# Names of parser nodes that only combine rows.
RELATIONAL = frozenset(
    {
        "Aggregate",
        "Deduplicate",
        "Distinct",
        "Except",
        "Filter",
        "Generate",
        "GlobalLimit",
        "Intersect",
        "Join",
        "LateralJoin",
        "LocalLimit",
        "LocalRelation",
        "Offset",
        "OneRowRelation",
        "Pivot",
        "Project",
        "Sample",
        "Sort",
        "SubqueryAlias",
        "Tail",
        "Union",
        "UnionLoop",
        "Unpivot",
        "UnresolvedHaving",
        "UnresolvedInlineTable",
        "UnresolvedRelation",
        "UnresolvedSubqueryColumnAliases",
        "UnresolvedTVFAliases",
        "UnresolvedTableValuedFunction",
        "UnresolvedWith",
        "Window",
        "WithWindowDefinition",
    }
)

# Table functions that turn their arguments into rows.
TABLE_FUNCTIONS = frozenset(
    {
        "explode",
        "explode_outer",
        "inline",
        "inline_outer",
        "json_tuple",
        "posexplode",
        "posexplode_outer",
        "range",
        "stack",
        "variant_explode",
        "variant_explode_outer",
    }
)

# Functions that call into the JVM or tell about files, and expressions whose function is not known yet.
REFUSED_FUNCTIONS = frozenset(
    {"input_file_block_length", "input_file_block_start", "input_file_name", "java_method", "reflect", "try_reflect"}
)
REFUSED_EXPRESSIONS = frozenset(
    {
        "CallMethodViaReflection",
        "ExpressionWithUnresolvedIdentifier",
        "HiveGenericUDF",
        "HiveSimpleUDF",
        "PythonUDAF",
        "PythonUDF",
        "ScalaAggregator",
        "ScalaUDF",
        "TryReflect",
    }
)


class ReadOnlyError(AnalysisException):
    """The text would do more than read the views."""

    def __init__(self, message: str):
        super().__init__(message=message)


def query(spark: SparkSession, text: str, views: Collection[str]) -> DataFrame:
    """The result of one query over the named temporary views; anything else raises ``ReadOnlyError``.

    A text that is no SQL raises Spark's ``ParseException``.
    """
    text = text.strip().rstrip(";")
    _Inspection(spark, views).parsed(spark._jsparkSession.sessionState().sqlParser().parsePlan(text))
    frame = spark.sql(text)
    _Inspection(spark, views).analyzed(frame._jdf.queryExecution().analyzed())
    return frame


class _Inspection:
    def __init__(self, spark: SparkSession, views: Collection[str]):
        self._gateway = spark.sparkContext._gateway
        self._views = frozenset(name.lower() for name in views)
        functions = getattr(spark._jvm, f"{_CATALYST}.analysis.FunctionRegistry").functionSet()
        self._functions = {f.funcName().lower() for f in _items(functions)} - REFUSED_FUNCTIONS

    def _is(self, node: JavaObject, kind: str) -> bool:
        return is_instance_of(self._gateway, node, f"{_CATALYST}.{kind}")

    def parsed(self, plan: JavaObject, names: frozenset[str] = frozenset()) -> None:
        """Refuse what a parsed plan must not hold; ``names`` are the WITH names in scope."""
        kind = _name(plan)
        if kind not in RELATIONAL:
            raise ReadOnlyError(f"{kind} is not part of a read-only query")
        if kind == "UnresolvedRelation":
            parts = [str(p) for p in _items(plan.multipartIdentifier())]
            if len(parts) != 1 or parts[0].lower() not in self._views | names:
                raise ReadOnlyError(f"{'.'.join(parts)} is not one of the tables of this console")
        if kind == "UnresolvedTableValuedFunction":
            self._function(plan.name(), TABLE_FUNCTIONS)
        if kind == "UnresolvedWith":
            for relation in _items(plan.cteRelations()):
                own = frozenset({str(relation._1()).lower()})
                self.parsed(relation._2(), names | own if plan.allowRecursion() else names)
                names |= own
        for child in _items(plan.children()):
            self.parsed(child, names)
        for expression in _items(plan.expressions()):
            self._expression(expression, names)

    def _expression(self, expression: JavaObject, names: frozenset[str]) -> None:
        if _name(expression) in REFUSED_EXPRESSIONS:
            raise ReadOnlyError(f"{_name(expression)} is not part of a read-only query")
        if _name(expression) == "UnresolvedFunction":
            self._function(expression.nameParts(), self._functions)
        if self._is(expression, "expressions.PlanExpression"):
            self.parsed(expression.plan(), names)
        for child in _items(expression.children()):
            self._expression(child, names)

    def _function(self, name: JavaObject, allowed: Collection[str]) -> None:
        parts = [str(p) for p in _items(name)]
        if len(parts) != 1 or parts[0].lower() not in allowed:
            raise ReadOnlyError(f"function {'.'.join(parts)} is not allowed in a read-only query")

    def analyzed(self, plan: JavaObject) -> None:
        """Refuse user functions that go by a built-in name; what lies below the views is not the query's."""
        if _name(plan) == "View":
            return
        for expression in _items(plan.expressions()):
            self._resolved(expression)
        for child in _items(plan.children()):
            self.analyzed(child)
        for relation in _items(plan.innerChildren()):
            if self._is(relation, "plans.logical.LogicalPlan"):
                self.analyzed(relation)

    def _resolved(self, expression: JavaObject) -> None:
        if _name(expression) in REFUSED_EXPRESSIONS:
            raise ReadOnlyError(f"{_name(expression)} is not part of a read-only query")
        if self._is(expression, "expressions.PlanExpression"):
            self.analyzed(expression.plan())
        for child in _items(expression.children()):
            self._resolved(child)


def _name(node: JavaObject) -> str:
    return str(node.getClass().getSimpleName())


def _items(sequence: JavaObject) -> Iterator[Any]:
    iterator = sequence.iterator()
    while iterator.hasNext():
        yield iterator.next()
