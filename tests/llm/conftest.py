import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from noteflow.llm.util import prepare
    from noteflow.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="noteflow-llm-tests", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    prepare(s)
    return s


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest table, with nulls, empty and odd texts added."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    n = len(rows)
    extra = [None, "", " \n\t ", "one", "!!!", "a" * 49, "é" * 60, "x y " * 3000, "\x00 nul   　 wide", rows[3][1], rows[3][1].upper(),
             rows[4][1] + " tail words", "two\nlines\n\n", "trailing space ", " leading", "a  b   c"]
    return rows + [(n + i, t) for i, t in enumerate(extra)]


@pytest.fixture(scope="session")
def frame(spark, documents):
    """The documents with columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "s", "l", 1, 2, 3) for i, t in documents],
                                 "doc_id long, text string, source string, lang string, _id int, _text int, kept int").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")
