import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"
#: Extra columns whose names the operators use inside.
CLASHES = ["name", "block", "key", "root", "row", "pos", "_id", "mix", "size", "words", "rank", "score", "bits", "left"]


@pytest.fixture(scope="session")
def table():
    def read(name, sf=SF):
        return pq.read_table(f"{sf}/{name}.parquet").to_pylist()

    return read


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of clashing names."""

    def build(rows):
        full = [(*r, None, None)[:4] if len(r) < 4 else r for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
        return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * len(CLASHES)) for r in full], schema)

    return build
