"""The queries of the training-data operators: against SQL where there is some, else they must run and keep their form."""

import pytest
from helpers import DATA

from kbforge.llm import queries as q

QUERIES, SQL = q.queries(), q.oracle_sql()
FORMS = {
    "p1_found": ["source_id", "chunk_index", "boundary"], "p2_found": ["origin_hash", "size_id", "caption_id"], "p4_found": ["group_id", "id"], "p5_found": ["collection", "id_a", "id_b"],
    "p6_found": ["query_id", "field", "defect"], "p7_found": ["doc_id", "n_pieces"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "kind"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(name, QUERIES, SQL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark):
    df = QUERIES[name](spark, DATA)
    assert df.columns == FORMS.get(name, df.columns)
    found = df.collect()
    if name.endswith("_found"):
        assert len(found) == len(set(found))
