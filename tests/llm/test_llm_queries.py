"""Every registered query of the subpackage: against its SQL, or for rows and types."""

import pytest

from compare import connect, difference
from statlake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    text, _ = difference(QUERIES[name](spark, FOLDER), duck, ORACLES[name])
    assert text == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_a_document(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert "void" not in dict(df.dtypes).values()
    ids = sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())


def test_registered():
    import __spark_entry__ as e

    assert set(QUERIES) | {"pipeline"} <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
