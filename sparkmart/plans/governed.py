"""SQL text that may read given frames and nothing else, judged by its resolved plan.

The text is parsed and resolved, but not run. Its statement must be a query: every command,
script, dynamic statement and program call is refused before anything is resolved. Then the leaves of
the resolved plan must be those of the given frames or hold no stored data (literals, ranges). So it
does not matter how a text spells a name: a table that it reaches by any way is a leaf.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical"
_STATEMENTS = (f"{_LOGICAL}.Command", f"{_LOGICAL}.ParsedStatement", f"{_LOGICAL}.CompoundPlanStatement")
# Plan nodes without a common kind that run more than a query, by the node's name.
_PROGRAMS = {"UnresolvedExecuteImmediate", "ScriptTransformation"}
_CALLS = {"CallMethodViaReflection"}
_WITHOUT_DATA = {
    "OneRowRelation", "LocalRelation", "Range", "EmptyRelation", "CTERelationRef", "UnionLoopRef"
}


def _items(scala: JavaObject) -> Iterator[JavaObject]:
    for place in range(scala.size()):
        yield scala.apply(place)


def _below(node: JavaObject) -> Iterator[JavaObject]:
    """Children, subqueries in expressions, and the definitions of a WITH clause."""
    yield from _items(node.children())
    yield from _items(node.subqueries())
    if node.nodeName() == "UnresolvedWith":
        yield from _items(node.innerChildren())


def _expressions(node: JavaObject) -> Iterator[JavaObject]:
    waiting = list(_items(node.expressions()))
    while waiting:
        expression = waiting.pop()
        yield expression
        waiting += _items(expression.children())


def _refuse_statements(spark: SparkSession, parsed: JavaObject) -> None:
    kinds = [spark._jvm.java.lang.Class.forName(name) for name in _STATEMENTS]
    waiting = [parsed]
    while waiting:
        node = waiting.pop()
        if node.nodeName() in _PROGRAMS or any(kind.isInstance(node) for kind in kinds):
            raise PermissionError(f"query text must be a query, not {node.nodeName()}")
        if node.nodeName() == "PlanWithUnresolvedIdentifier":
            raise PermissionError("query text must name relations in braces, not by identifier()")
        if node.nodeName() == "UnresolvedRelation" and node.multipartIdentifier().size() > 1:
            # A table by its full name, or files: to resolve a path would open them.
            raise PermissionError(f"query text must name in braces what it reads: {node.tableName()}")
        waiting += _below(node)


def _refuse_other_leaves(resolved: JavaObject, granted: set[str]) -> None:
    waiting = [resolved]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name == "View":
            view = node.desc().identifier().table()
            if node.isTempView() and view in granted:
                continue
            raise PermissionError(f"query text must name {view!r} in braces")
        below = list(_below(node))
        if not below and name not in _WITHOUT_DATA:
            raise PermissionError(f"query text must name in braces what it reads: {node.toString()}")
        for expression in _expressions(node):
            if type_name(expression) in _CALLS:
                raise PermissionError("query text must not call programs")
        waiting += below


def type_name(node: JavaObject) -> str:
    return node.getClass().getSimpleName()


def governed_query(spark: SparkSession, text: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The query ``text``, whose names in braces stand for ``frames``.

    ``PermissionError`` if the text is anything but a query, or reads what is not in ``frames``;
    nothing has run or changed then.
    """
    views = {name: f"governed_{uuid.uuid4().hex}" for name in frames}
    plain = text.format_map({name: f"`{view}`" for name, view in views.items()})
    state = spark._jsparkSession.sessionState()
    parsed = state.sqlParser().parsePlan(plain)
    _refuse_statements(spark, parsed)
    try:
        for name, frame in frames.items():
            frame.createOrReplaceTempView(views[name])
        unrun = spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
        _refuse_other_leaves(state.executePlan(parsed, unrun).analyzed(), set(views.values()))
        return spark.sql(plain)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
