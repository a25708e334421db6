import compare
import corpus_pipeline
import pytest

from txnwatch.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with compare.connect(SF) as con:
        yield con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = compare.both(spark, duck, catalog.registry()[name], catalog.SQL[name], SF)
    assert ours == theirs


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in catalog.registry()) == list(range(1, 14))


def test_stages_in_order(spark):
    """Running the stages one by one gives the rows of the whole run."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    whole = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(last) == key(whole)
