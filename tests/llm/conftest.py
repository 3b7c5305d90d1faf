import duckdb
import pytest

from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def texts():
    """doc_id -> text of the test documents."""
    query = f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id"
    return dict(duckdb.sql(query).fetchall())
