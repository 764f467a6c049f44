"""Table operators: lookups, cross rates, policies, contracts, registries."""

from sparkmart.operators.contract import Contract, ContractColumn, ContractError, enforce
from sparkmart.operators.lookups import DuplicateKeyError, lookup
from sparkmart.operators.policy import (
    ColumnMask,
    Identity,
    PolicyConflictError,
    RowFilter,
    TableName,
    secure,
    tail_mask,
)
from sparkmart.operators.rates import cross_rates, inverse_rates, pivot_rates
from sparkmart.operators.registry import (
    insert_absent,
    list_keys,
    new_records,
    record_rules,
    update_columns,
    validate,
    with_reasons,
)
from sparkmart.operators.registry_store import ConflictError, RegistryStore

__all__ = [
    "ColumnMask",
    "ConflictError",
    "Contract",
    "ContractColumn",
    "ContractError",
    "DuplicateKeyError",
    "Identity",
    "PolicyConflictError",
    "RegistryStore",
    "RowFilter",
    "TableName",
    "cross_rates",
    "enforce",
    "insert_absent",
    "inverse_rates",
    "list_keys",
    "lookup",
    "new_records",
    "pivot_rates",
    "record_rules",
    "secure",
    "tail_mask",
    "update_columns",
    "validate",
    "with_reasons",
]
