import pytest

from checks.compare import compare, duck
from holdfast.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equals_sql(spark, sf, key):
    assert compare(QUERIES[key](spark, sf), duck(sf), ORACLE[key]) == []


def test_a_query_of_each():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
