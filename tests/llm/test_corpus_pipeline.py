import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from test_queries import canonical
import corpus_pipeline
from helpers import FOLDER, near_copies
from opsledger.llm.queries import ORACLE, QUERIES
from test_pii import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score int, base string"


def test_every_operator_has_one_query():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_dedup", "privacy", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found, expected = entry.queries()[name](spark, FOLDER).toPandas(), duck.execute(ORACLE[name]).fetchdf()
    assert sorted(found.columns) == sorted(expected.columns)
    assert canonical(found) == canonical(expected)


@pytest.mark.parametrize("name", ["op3_lm_scoring", "op4_language_id", "op5_quality_classifier", "op6_token_counts", "op7_sentencepiece", "op8_pii"])
def test_query_returns_every_document(spark, name):
    found = entry.queries()[name](spark, FOLDER).select("doc_id").toPandas().doc_id
    wanted = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").toPandas().doc_id
    assert sorted(found) == sorted(wanted)


def through(spark, docs, tmp_path):
    """Each stage's output, written and read again as the pipeline does."""
    made = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        made.append(docs)
    return made


def test_stages_on_the_test_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    language, quality, distinct, private, packed = through(spark, docs, tmp_path)
    assert all(d.columns == docs.columns for d in (language, quality, distinct, private))
    assert language.count() == docs.count()  # every test document is in one of the four languages
    duck = duckdb.connect()
    language.toPandas().to_parquet(str(tmp_path / "documents.parquet"))
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    verdict = duck.execute(ORACLE["op2_quality_rules"]).fetchdf()
    assert sorted(quality.toPandas().doc_id) == sorted(verdict[verdict.kept].doc_id)
    texts = {r.doc_id: r.text for r in quality.collect()}
    component, _ = near_copies(texts, 5)
    assert sorted(distinct.toPandas().doc_id) == sorted(i for i in texts if component[i] == i)
    kept = {r.doc_id: r for r in distinct.collect()}
    for r in private.collect():
        assert plain(r.text) == "" or "[" in r.text
        assert (r.text != kept[r.doc_id].text) or plain(r.text) == ""
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (kept[r.doc_id].lang, kept[r.doc_id].source)
    assert packed.select("doc_id").distinct().count() == private.count()
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert whole.filter("n <> m").count() == 0


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls everywhere, repeated rows, a very long text, and columns named like results."""
    fine = " ".join(f"the word{k} and of" for k in range(30))
    rows = [(1, fine, "en", "a"), (1, fine, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (None, fine + " more", None, None), (4, "der die das und nicht mit " + " ".join(f"schw{k}" for k in range(200)), "de", None), (5, "123 456", "en", "b"), (6, " ".join(f"long{k} of the" for k in range(30_000)), "en", "b")]
    docs = spark.createDataFrame([(i, t, lang, s, None, "own", 7, None) for i, t, lang, s in rows], SCHEMA)
    language, quality, distinct, private, packed = through(spark, docs, tmp_path)
    assert all(d.columns == docs.columns for d in (language, quality, distinct, private))
    ids = lambda d: sorted(r.doc_id or 0 for r in d.select("doc_id").collect())
    assert 2 not in ids(language) and 3 not in ids(language) and 5 not in ids(language)
    assert ids(distinct) == [0, 1, 4, 6]
    assert {(r.kept, r.score, r.base) for r in private.collect()} == {("own", 7, None)}
    assert ids(packed.select("doc_id").distinct()) == [0, 1, 4, 6]


def test_an_empty_table_passes_through(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    assert [d.count() for d in through(spark, docs, tmp_path)] == [0] * 5


def test_run_applies_the_stages_in_order(spark, monkeypatch):
    seen = []
    stage = lambda name, f: (name, lambda s, docs, folder: seen.append((name, docs.columns)) or f(docs))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("one", lambda d: d.filter("doc_id < 50")), stage("two", lambda d: d.select("doc_id"))])
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == ["doc_id"] and 0 < found.count() <= 50
    assert [n for n, _ in seen] == ["one", "two"] and seen[1][1] == seen[0][1]
