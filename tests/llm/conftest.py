import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# Columns whose names the operators use inside, to be left alone or not read.
CLASHING = {"__row": 1, "fp": 2, "score": 3.0, "block": "b", "spans": "s", "label": 7, "N": 5}


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as a table of documents, with more columns if asked for."""
    def make(rows, clashing=False, partitions=3):
        extra = CLASHING if clashing else {}
        kinds = {int: "long", float: "double", str: "string"}
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(
            f", `{k}` {kinds[type(v)]}" for k, v in extra.items())
        data = [(i, t, "en", "s", None if t is None else len(t), *extra.values()) for i, t in rows]
        return spark.createDataFrame(data, schema).repartition(partitions)
    return make


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
