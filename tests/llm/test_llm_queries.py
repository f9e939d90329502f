import pytest
from oracle_util import duck, same

from wardflow.llm.oracles import ORACLES
from wardflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    ok, a, b = same(QUERIES[name](spark, SF), duck(SF), ORACLES[name])
    assert ok, (name, a[0], b[0], sorted(set(a[1]) ^ set(b[1]))[:3])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_over_its_whole_table(spark, name):
    table = {"op6": "conversations", "op8": "pages", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name != "op12_phrases":  # its rows are phrases, not documents
        assert QUERIES[name](spark, SF).count() >= n
