"""Row filters and column masks, applied to a table for one identity.

``secure`` adds a ``where`` and a ``select`` to the plan, so filters still reach
the scan. It guards reads made through this library; who can open the files
directly is for the storage to decide.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXEMPT = frozenset({"admin"})


class PolicyConflictError(ValueError):
    """Two masks claim one column."""


@dataclass(frozen=True)
class TableName:
    catalog: str
    schema: str
    table: str


@dataclass(frozen=True)
class Identity:
    """Who reads. Without a user nobody is exempt."""

    user: str | None = None


@dataclass(frozen=True)
class RowFilter:
    """Keep rows for which the SQL expression is true (NULL is not)."""

    table: TableName
    expression: str
    exempt: frozenset[str] = EXEMPT


@dataclass(frozen=True)
class ColumnMask:
    """Show the SQL expression in place of a column, cast to the column's type."""

    table: TableName
    column: str
    expression: str
    exempt: frozenset[str] = EXEMPT


def tail_mask(column: str, visible: int = 3) -> str:
    """Mask expression that shows the last characters; a shorter text shows none."""
    return (
        f"case when length({column}) >= {visible} "
        f"then '****' || substring({column}, -{visible}) "
        f"when {column} is not null then '****' end"
    )


def _applies(policy: RowFilter | ColumnMask, table: TableName, user: str | None) -> bool:
    return policy.table == table and (user is None or user not in policy.exempt)


def secure(
    df: DataFrame,
    table: TableName,
    identity: Identity | None,
    policies: Iterable[RowFilter | ColumnMask],
) -> DataFrame:
    """What ``identity`` may see of ``df``, read from ``table``.

    All filters must hold, and they see unmasked values; the masks follow in one
    projection that keeps column order and types. A table that no policy names
    passes unchanged, and so does any table for an exempt user.
    """
    user = identity.user if identity else None
    active = [policy for policy in policies if _applies(policy, table, user)]

    masks: dict[str, str] = {}
    for policy in active:
        if isinstance(policy, ColumnMask):
            if masks.setdefault(policy.column, policy.expression) != policy.expression:
                raise PolicyConflictError(f"several masks for column {policy.column!r}")
    unknown = sorted(set(masks) - set(df.columns))
    if unknown:
        raise ValueError(f"masked columns not in the table: {unknown}")

    for policy in active:
        if isinstance(policy, RowFilter):
            df = df.where(F.expr(policy.expression))
    if not masks:
        return df
    return df.select(
        *[
            F.expr(masks[field.name]).cast(field.dataType).alias(field.name)
            if field.name in masks
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
