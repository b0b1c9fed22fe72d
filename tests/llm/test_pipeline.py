"""The pipeline over planted cases, and the registered SQL."""

import pytest

import __spark_entry__
import corpus_pipeline
from costmart.llm import decontam, simhash
from costmart.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.rows import EDGE_TEXTS, prose
from tests.oracle_check import compare, duck

ITEM = prose(7777, 40)


def planted():
    """(doc_id, text, why it goes or None)."""
    rows = [(i, prose(i, 150), None) for i in range(100)]
    rows += [(200 + i, prose(i, 150), "copy") for i in range(10)]
    rows += [(300 + i, prose(400 + i, 100) + " " + ITEM, "contaminated") for i in range(5)]
    rows += [(500 + i, prose(500 + i, 120) + " snarl sneer " * 4, "toxic") for i in range(30)]
    rows += [(600, prose(600, 100) + " password = hunter2hunter2 " + prose(601, 20), None)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("planted")
    rows = [(i, t, "en", f"s{(i or 0) % 4}", len(t or "")) for i, t, *_ in planted() + [(None if i is None else 900 + i, t) for i, t in EDGE_TEXTS]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(why == "toxic")) for i, _, why in planted()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_in_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before = ids(docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scan",
                                                      "best_fit_packing"]
    gone = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        gone[name] = ids(docs) - ids(out)
        docs = out
    why = {w: {i for i, _, x in planted() if x == w} for w in ("copy", "contaminated", "toxic")}
    assert gone["toxicity"] == why["toxic"]
    assert why["copy"] <= gone["simhash_near_dedup"]
    assert gone["simhash_near_dedup"] - why["copy"] <= {902, 903}  # the other texts without a word
    assert gone["benchmark_decontamination"] == why["contaminated"] and gone["secret_scan"] == set()
    assert "hunter2" not in docs.where("doc_id = 600").first().text
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert ids(packed) == ids(docs) == before - set().union(*gone.values())


def test_run_equals_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} >= set(range(100)) and 600 in {r.doc_id for r in rows}


def test_empty_documents(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                         ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int"),
                         ("embeddings", "vec_id long, embedding array<float>, label int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for name, query in QUERIES.items():
        if name != "op2_warc":
            assert query(spark, str(tmp_path)).collect() == [], name


def test_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, len(QUERIES))] + ["pipeline"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    result = compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLES[name])
    assert result["ok"], result


def test_stages_use_their_operators():
    assert corpus_pipeline.decontam is decontam and corpus_pipeline.simhash is simhash
