"""Policies of the relations that rows were made of, applied to the rows by their lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.policy import ColumnMask, PolicyConflictError, RowFilter
from sparkmart.plans.lineage import UNKNOWN, Lineage

Policy = RowFilter | ColumnMask


class CannotCarry(Exception):
    """A filter of a relation below cannot be told from the rows above it."""


def carry(rows: DataFrame, made: Lineage, policies: Mapping[str, Sequence[Policy]]) -> DataFrame:
    """``rows`` under the policies of the relations that they were made of.

    A filter applies where each row stands for one row of the filtered relation and still has the
    columns that the filter reads; else ``CannotCarry`` is raised, and the rows must be made anew.
    A column taken from a masked one is masked the same way, if the columns that the mask reads are
    left; what is made of a masked column, or of something unknown, is NULL. Filters and masks
    see unmasked values.
    """
    below = {relation: own for relation, own in policies.items() if relation in made.reads}
    if not below:
        return rows
    masks: dict[str, str] = {}
    given: dict[str, str] = {}
    work = rows.select(F.struct("*").alias("_row"))
    for relation, own in below.items():
        scope = {here: source for source, here in made.taken(relation).items()}
        named = [F.col(f"_row.`{here}`").alias(source) for here, source in scope.items()]
        filters = [policy.expression for policy in own if isinstance(policy, RowFilter)]
        hidden = {p.column.lower(): p.expression for p in own if isinstance(p, ColumnMask)}
        scoped = work.select("_row", *masks.values(), *named)
        for condition in filters:
            if relation not in made.rows or not _reads_only(scoped, condition):
                raise CannotCarry(condition)
            scoped = scoped.where(F.expr(condition))
        shown = []
        for column, origins in made.columns.items():
            for (source, name), taken in origins.items():
                if source == UNKNOWN and hidden and column not in masks:
                    shown.append(F.lit(None).alias(f"_mask_{column}"))
                    masks[column] = f"`_mask_{column}`"
                if source != relation or name.lower() not in hidden:
                    continue
                expression = hidden[name.lower()]
                if not taken or not _reads_only(scoped, expression):
                    expression = "NULL"
                if given.setdefault(column, expression) != expression:
                    if "NULL" not in (given[column], expression):
                        raise PolicyConflictError(f"several masks for column {column!r}")
                    given[column] = "NULL"
                if column not in masks:
                    shown.append(F.expr(expression).alias(f"_mask_{column}"))
                    masks[column] = f"`_mask_{column}`"
        kept = [name for name in masks.values() if name.strip("`") in work.columns]
        work = scoped.select("_row", *kept, *shown)
    return work.select(
        *[
            (
                F.lit(None)
                if given.get(field.name) == "NULL"
                else F.col(masks.get(field.name, f"_row.`{field.name}`"))
            )
            .cast(field.dataType)
            .alias(field.name)
            for field in rows.schema.fields
        ]
    )


def _reads_only(scoped: DataFrame, expression: str) -> bool:
    """Whether all columns that the expression reads are there."""
    try:
        scoped.drop("_row").select(F.expr(expression))
    except AnalysisException:
        return False
    return True
