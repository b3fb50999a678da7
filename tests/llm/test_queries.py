"""Every query of the subpackage that SQL can say, against its SQL; the others must give one row per row."""

import pytest

import __spark_entry__ as entry
from fogline.llm import queries
from tests.conftest import SF
from workload.run_check import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF), duck, queries.ORACLES[name]) is None


def test_all_are_registered():
    found = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert "pipeline" in found
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("op4_language", "documents", ["doc_id", "held_out", "lang_pred", "score"]),
        ("op6_url_filter", "pages", ["page_id", "host", "path", "rule", "verdict"]),
        ("op8_toxicity", "documents", ["doc_id", "held_out", "score", "predicted"]),
    ],
)
def test_one_row_for_each_row(spark, name, table, columns):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == columns
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
