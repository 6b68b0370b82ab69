"""The registered queries of this folder; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    batches,
    bitslices,
    cascade,
    context_tree,
    curriculum,
    decontaminate,
    merkle,
    ngram_join,
    packing,
    rule_ensemble,
    secret_scan,
    token_store,
    url_rules,
    vocabulary,
    warc,
)
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.llm.store import prepare_workers
from tidemark.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}



def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_workers(spark)
            return build(spark, sf_dir.rstrip("/"))

        REGISTRY[name] = run
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_ngram_jaccard_join")
def _ngram_jaccard_join(spark, d):
    """Every document with its number of shingles and the least id it is linked with."""
    return ngram_join.near_duplicates(table(spark, d, "documents"))


@query("op2_token_store")
def _token_store(spark, d):
    """Every document's ids as found on disk through the perfect hash index."""
    documents = table(spark, d, "documents")
    store = token_store.write_store(
        documents, work_dir(spark, "tokens"), vocabulary.default_path()
    )
    return token_store.lookup(store, documents, with_ids=False)


@query("op3_secret_scan")
def _secret_scan(spark, d):
    """Secrets by fixed patterns and by character models, as counts, a digest and spans."""
    return secret_scan.summary(secret_scan.find_secrets(table(spark, d, "documents")))


@query("op4_context_tree_scores")
def _context_tree_scores(spark, d):
    """Scores of every document by the context tree and by smoothed word counts."""
    return context_tree.score_texts(table(spark, d, "documents"))


@query("op5_quality_rules")
def _quality_rules(spark, d):
    """The rule ensemble's score of every document; labels of fold 0 of 5 are held out."""
    documents = table(spark, d, "documents")
    model = rule_ensemble.train(documents, table(spark, d, "labels"))
    scored = rule_ensemble.score_quality(documents, model)
    held_out = (batches.fold("doc_id", 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


# Fixed by the contract of the query: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query("op6_url_rules")
def _url_rules(spark, d):
    """The rule and verdict for every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, d, "pages"), rules)


@query("op7_warc_archives")
def _warc_archives(spark, d):
    """Every page's record as read back from the archives."""
    archives = warc.write_archives(table(spark, d, "pages"), work_dir(spark, "warc"))
    return warc.read_archives(archives).drop("url")


@query("op8_quality_cascade")
def _quality_cascade(spark, d):
    """Fixed measures of every document, and whether the cascade keeps it."""
    return cascade.judge_quality(table(spark, d, "documents"))


@query("op9_benchmark_decontamination")
def _benchmark_decontamination(spark, d):
    """How many words of every document are in passages of the benchmark, and of which items."""
    found = decontaminate.benchmark_passages(
        table(spark, d, "documents"), table(spark, d, "benchmark")
    )
    return decontaminate.contamination(found)


@query("op10_best_fit_packing")
def _best_fit_packing(spark, d):
    """Every piece of every document with its sequence and its place there."""
    return packing.pack_documents(table(spark, d, "documents"), vocabulary.default_path())


@query("op11_bitslice_search")
def _bitslice_search(spark, d):
    """Each benchmark item's ten best documents."""
    documents = table(spark, d, "documents")
    index = bitslices.build_index(documents)
    return bitslices.search(index, documents, table(spark, d, "benchmark"))


@query("op12_curriculum_mix")
def _curriculum_mix(spark, d):
    """The words of every document that the training stream takes, all copies together."""
    return curriculum.taken_words(curriculum.mix_sources(table(spark, d, "documents")))


@query("op13_merkle_manifest")
def _merkle_manifest(spark, d):
    """The proof of every document, folded again after some character counts were raised by one."""
    return merkle.prove(merkle.build_manifest(table(spark, d, "documents"), tamper="n_chars"))
