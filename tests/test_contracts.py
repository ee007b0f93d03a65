"""Every registered output with a contract satisfies it."""
import pytest

import __spark_entry__ as E
from cumulus.operators.reports import assert_contract
from cumulus.plans.catalog import QUERIES
from cumulus.plans.contracts import CONTRACTS


def test_every_output_has_a_contract():
    assert set(CONTRACTS) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_output_meets_contract(spark, sf_small, name):
    c = CONTRACTS[name]
    assert_contract(E.queries()[name](spark, sf_small), c["keys"], c["not_null"], c["domains"])


def test_violation_is_reported(spark):
    df = spark.createDataFrame([(1, "star"), (1, "meh"), (None, "bad")], "k long, cls string")
    with pytest.raises(ValueError) as e:
        assert_contract(df, ["k"], ["k"], {"cls": ["star", "good", "average", "bad"]})
    assert "unique:k" in str(e.value) and "domain:cls" in str(e.value) and "not_null:k" in str(e.value)
