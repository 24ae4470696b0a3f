import pytest

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    corpus = pytest.importorskip("corpus_pipeline")
    from sievewright.llm.common import materialize, read_table

    docs = read_table(spark, SF, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes == sorted(sizes, reverse=True)
    packed = corpus.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_queries_are_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert {f"op{i}_" for i in range(1, 11)} <= {n[: n.index("_") + 1] for n in names if n.startswith("op")} and "pipeline" in names
