"""Every registered query against its SQL, its plan, and the pipeline stage by stage."""

import re

import pytest
from cases import ODD, workers  # noqa: F401
from oracle_check import TESTDATA, normalized, oracle_rows

import __spark_entry__ as entry_point
import corpus_pipeline
from tidemark.llm import decontaminate, ngram_join, rule_ensemble, secret_scan
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import REGISTRY

SF = f"{TESTDATA}/sf0.001"
COLUMNS = {
    "op1": "doc_id n_shingles component_id", "op2": "doc_id start n_tokens ids_crc32",
    "op3": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5": "doc_id held_out score predicted", "op6": "page_id host path rule verdict",
    "op7": "page_id payload_bytes payload_digest record_type refers_to",
    "op8": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op10": "doc_id piece start length ids_crc32 sequence_id offset",
    "op11": "item_id rank doc_id score",
    "op12": "doc_id size source_size target taken",
    "op13": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_all_are_registered():
    assert [name.split("_")[0] for name in REGISTRY] == [
        "op1", *sorted((n for n in COLUMNS if n != "op1"), key=lambda n: int(n[2:]))
    ]
    assert set(REGISTRY) | {"pipeline"} <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = REGISTRY[name](spark, SF)
    names, rows = oracle_rows(SF, ORACLES[name])
    assert sorted(names) == sorted(df.columns)
    assert normalized(df.columns, df.collect()) == normalized(names, rows)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLES)))
def test_query_gives_every_document(spark, name):
    df = REGISTRY[name](spark, SF)
    assert df.columns[: len(COLUMNS[name.split("_")[0]].split())] == COLUMNS[
        name.split("_")[0]].split()
    ids = {r.doc_id for r in df.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", ["op3_secret_scan", "op8_quality_cascade"])
def test_native_queries_run_no_python(spark, name):
    plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    quality, near, clean, redacted = (stage for _, stage in corpus_pipeline.STAGES[:4])

    first = quality(spark, docs, SF).cache()
    assert first.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in first.collect()}
    assert all((labels[i] == 1) == (i in kept) for i in labels)

    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(first).collect()}
    second = near(spark, first, SF).cache()
    assert {r.doc_id for r in second.collect()} == {i for i, c in found.items() if i == c}

    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    hits = decontaminate.benchmark_passages(second, benchmark).where("size(spans) > 0")
    third = clean(spark, second, SF).cache()
    assert {r.doc_id for r in third.collect()} == {r.doc_id for r in second.collect()} - {
        r.doc_id for r in hits.collect()
    }

    fourth = redacted(spark, third, SF)
    assert fourth.columns == docs.columns
    changed = {r.doc_id for r in secret_scan.find_secrets(third).collect() if r.spans}
    for row in fourth.collect():
        assert (row.text != texts[row.doc_id]) == (row.doc_id in changed)
        assert row.n_chars == len(row.text)

    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in third.collect()}


@pytest.fixture
def odd_folder(spark, tmp_path):
    """Labels that are all null, and a benchmark of one short item and two without words."""
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    items = spark.createDataFrame([("a", "ONE"), ("b", None), (None, " ")], "item_id string, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def _odd(spark, *rows):
    """Documents with nulls in every column and columns named like those that stages add."""
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    more = ", row string, spans string, label int, statistics string, row_key string"
    filled = [(i, text, None, "s", None, None, "x", 1, None, "k") for i, text in rows]
    return spark.createDataFrame(filled, schema + more)


def test_pipeline_stages_take_odd_rows(spark, odd_folder):
    """Every stage on what the one before kept; decisions as the docstrings state them."""
    docs = _odd(spark, *ODD, (None, "no id at all here"), (8, "token=abcdefgh12345678"))
    ids = ["0", "1", "2", "3", "4", "5", "6", "7", "8", "None"]
    expected = [[*ids, "7", "None"], ids, [i for i in ids if i != "3"], [i for i in ids if i != "3"]]
    columns = docs.columns
    for (name, stage), kept in zip(corpus_pipeline.STAGES, expected, strict=False):
        docs = stage(spark, docs, odd_folder).cache()
        assert docs.columns == columns, name
        assert sorted(str(r.doc_id) for r in docs.collect()) == sorted(kept), name
    texts = {r.doc_id: (r.text, r.row_key) for r in docs.collect()}
    assert texts[0] == (None, "k") and "abcdefgh" not in texts[8][0]
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, odd_folder)
    assert {str(r.doc_id) for r in pieces.collect()} == set(expected[3])


def test_pipeline_stages_take_empty_tables(spark, odd_folder):
    docs = _odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, odd_folder).collect() == [], name


def test_rules_are_spark_columns(spark):
    model = rule_ensemble.Ensemble(0.0, (rule_ensemble.Rule((("n_words", ">", 3.0),), 2.0),))
    df = spark.createDataFrame([(5.0,), (1.0,)], "n_words double")
    scores = sorted(r[0] for r in df.select(model.score()).collect())
    assert scores[0] == 0.5 and 0.88 < scores[1] < 0.89
