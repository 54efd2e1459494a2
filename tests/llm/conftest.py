import duckdb
import pytest
from pyspark import cloudpickle

import tidemark

cloudpickle.register_pickle_by_value(tidemark)


@pytest.fixture(scope="session")
def documents(data_dir):
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{data_dir}/documents.parquet' ORDER BY doc_id")
    return rows.fetchall()


@pytest.fixture()
def edges(spark):
    """The edge texts, with columns that have names the operators use themselves."""
    from tests.llm.plain import EDGES

    rows = [(i, t, None, None, 1, "x", "y", "z", "w") for i, t in EDGES]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, id string, hits string, label string, n string",
    )
