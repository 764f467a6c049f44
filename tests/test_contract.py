import pytest

from sparkmart.operators import Contract, ContractColumn, ContractError, enforce

RATES = Contract.of(
    ContractColumn("from_currency", "string", "Code of the money given"),
    ContractColumn("to_currency", "string"),
    ContractColumn("rate", "float", "Units received for one unit given"),
)


def test_columns_come_in_contract_order_with_descriptions(spark):
    df = spark.sql("SELECT 1.5D AS rate, 'b' AS to_currency, 'a' AS from_currency")
    checked = enforce(df, RATES)
    assert checked.dtypes == [
        ("from_currency", "string"),
        ("to_currency", "string"),
        ("rate", "double"),
    ]
    assert checked.schema["rate"].metadata == {"comment": "Units received for one unit given"}
    assert tuple(checked.first()) == ("a", "b", 1.5)


@pytest.mark.parametrize(
    "select, fault",
    [
        ("'a' AS from_currency, 'b' AS to_currency", "missing column 'rate'"),
        ("'a' AS from_currency, 'b' AS to_currency, 1D AS rate, 2 AS x", "extra column 'x'"),
        ("'a' AS from_currency, 'b' AS to_currency, 1.0F AS rate", "'rate' is float, not double"),
        ("1 AS from_currency, 'b' AS to_currency, 1D AS rate", "'from_currency' is int"),
        ("'a' AS from_currency, 'b' AS to_currency, 1D AS rate, 2D AS rate", "twice"),
    ],
)
def test_violations(spark, select, fault):
    with pytest.raises(ContractError, match=fault):
        enforce(spark.sql(f"SELECT {select}"), RATES)


def test_all_faults_are_listed(spark):
    with pytest.raises(ContractError) as error:
        enforce(spark.sql("SELECT 1 AS x, 2 AS rate"), RATES)
    assert all(part in str(error.value) for part in ("from_currency", "to_currency", "x", "rate"))


def test_inheritance():
    assert RATES.inherit("all") == RATES
    fewer = RATES.inherit("all", exclude=["rate"])
    assert [c.name for c in fewer.columns] == ["from_currency", "to_currency"]
    changed = RATES.inherit(
        ["rate"], extra=[ContractColumn("rate", "decimal(18,6)"), ContractColumn("day", "date")]
    )
    assert [(c.name, c.spark_type.simpleString()) for c in changed.columns] == [
        ("rate", "decimal(18,6)"),
        ("day", "date"),
    ]
    with pytest.raises(ContractError, match="nope"):
        RATES.inherit("all", exclude=["nope"])
