"""Schema contracts: the columns and types a published model must have."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract type names that mean another Spark type of that name.
CONTRACT_TYPES: dict[str, T.DataType] = {
    "float": T.DoubleType(),
    "integer": T.IntegerType(),
    "varchar": T.StringType(),
}


class ContractError(ValueError):
    """A model's columns differ from its contract."""


@dataclass(frozen=True)
class ContractColumn:
    name: str
    data_type: str
    description: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        known = CONTRACT_TYPES.get(self.data_type.lower())
        return known if known is not None else T.DataType.fromDDL(self.data_type)


@dataclass(frozen=True)
class Contract:
    columns: tuple[ContractColumn, ...]

    @staticmethod
    def of(*columns: ContractColumn) -> Contract:
        return Contract(tuple(columns))

    def inherit(
        self,
        include: str | Iterable[str] = "all",
        exclude: Iterable[str] = (),
        extra: Iterable[ContractColumn] = (),
    ) -> Contract:
        """The contract of a version: base columns, less some, with others replaced or added."""
        wanted = None if include == "all" else set(include)
        dropped = set(exclude)
        named = {column.name for column in self.columns}
        unknown = sorted(((wanted or set()) | dropped) - named)
        if unknown:
            raise ContractError(f"no such columns to inherit: {unknown}")
        columns = {
            column.name: column
            for column in self.columns
            if (wanted is None or column.name in wanted) and column.name not in dropped
        }
        columns.update({column.name: column for column in extra})
        return Contract(tuple(columns.values()))


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise unless names and types agree; else the columns in contract order.

    Descriptions become column comments. The check reads the plan's schema only
    and runs no job.
    """
    actual = {field.name: field.dataType for field in df.schema.fields}
    declared = {column.name: column.spark_type for column in contract.columns}
    faults = [f"missing column {name!r}" for name in declared if name not in actual]
    faults += [f"extra column {name!r}" for name in actual if name not in declared]
    faults += [
        f"column {name!r} is {actual[name].simpleString()}, not {kind.simpleString()}"
        for name, kind in declared.items()
        if name in actual and actual[name] != kind
    ]
    if len(actual) != len(df.columns):
        faults.append("a column name occurs twice")
    if faults:
        raise ContractError("; ".join(faults))
    return df.select(
        *[
            F.col(f"`{column.name}`").alias(
                column.name,
                metadata={"comment": column.description} if column.description else {},
            )
            for column in contract.columns
        ]
    )
