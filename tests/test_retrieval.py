import hashlib
import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsledger.functions.text import excerpt, extract_first, tokenize, word_overlap
from opsledger.operators import bm25, fusion, knn, segments
from opsledger.operators.answer import build_context, fetch_chunks, lookup_extracted_key
from opsledger.operators.chunks import chunk_of, chunk_sections, corpus_order
from opsledger.operators.slices import slices
from opsledger.operators.slices import slices
from opsledger.operators.topk import best_of, rank_top

DOCS = [
    "Delay of a flight delay", "a gate change", "the weather a delay", "a a a a", "", "refund policy for a cancelled flight",
    "weather policy a", "gate", "a delay code ATC", "crew a b c d e f g",
]
ASKED = ["delay weather weather", "a gate", "nothing known", "", "ATC Flight policy"]


def brute_force(query: str, k1=1.5, b=0.75, eps=0.25) -> list[float]:
    docs = [d.lower().split() for d in DOCS]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = eps * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    return [
        sum(
            idf.get(w, 0) * d.count(w) * (k1 + 1) / (d.count(w) + k1 * (1 - b + b * len(d) / mean))
            for w in query.lower().split()
        )
        for d in docs
    ]


def frames(spark):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "doc_id bigint, text string").repartition(3)
    return spark.createDataFrame(list(enumerate(ASKED)), "query_id bigint, query string"), docs


def ranking(df, item="doc_id"):
    return [(r["query_id"], r["rank"], r[item], round(r["score"], 6)) for r in df.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("max_words,stored", [(200_000, False), (3, False), (200_000, True)])
def test_bm25_equals_brute_force(spark, max_words, stored, tmp_path, monkeypatch):
    """All queries at once, in blocks, and over an index written and read again; small steps in the tasks."""
    asked, docs = frames(spark)
    index = bm25.build(docs, "doc_id", "text")
    if stored:
        bm25.write(index, str(tmp_path / "index"))
        index = bm25.read(spark, str(tmp_path / "index"))
    found = bm25.search(asked, index, 6, max_words=max_words)
    expected = []
    for q, text in enumerate(ASKED):
        scores = brute_force(text)
        best = sorted(range(len(DOCS)), key=lambda i: -round(scores[i], 9))[:6]
        expected += [(q, rank, i, round(scores[i], 6)) for rank, i in enumerate(best)]
    assert ranking(found) == [(q, r, i, pytest.approx(s, abs=2e-6)) for q, r, i, s in expected]


def test_tokens(spark):
    texts = ["  A b\tC d\x1ce\n", "", " \n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(tokenize(F.col("t"))).collect()] == [["a", "b", "c", "d", "e"], [], [], None]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(400, 16))
    data[7] = data[11] = data[5]
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    data = data.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(f"q{i}", data[i * 5].tolist()) for i in range(9)], "query_id string, embedding array<float>")
    return data.astype(np.float64), queries, df


def test_a_stored_index_opens_only_the_folders_of_its_words(spark, tmp_path):
    asked, docs = frames(spark)
    bm25.write(bm25.build(docs, "doc_id", "text"), str(tmp_path / "index"))
    index = bm25.read(spark, str(tmp_path / "index"))
    stats = index.stats.first()
    assert (stats["documents"], round(stats["mean_length"], 3)) == (len(DOCS), round(sum(len(d.split()) for d in DOCS) / len(DOCS), 3))
    found = bm25.search(asked.where("query_id = 1"), index, 3)
    assert "PartitionFilters: [bucket" in found._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")


def test_bm25_ties_and_odd_rows(spark):
    """Equal scores go by number, not by text; a null text counts as one without words; an empty corpus has no answer."""
    asked = spark.createDataFrame([(1, "same"), (2, None)], "query_id int, query string")
    docs = spark.createDataFrame([(10, "same"), (2, "same"), (3, None), (4, "other words"), (5, "x"), (6, "y")], "doc_id bigint, text string")
    found = ranking(bm25.bm25_topk(asked, docs, 3))
    assert [r[2] for r in found if r[0] == 1] == [2, 10, 3] and [r[2] for r in found if r[0] == 2] == [2, 3, 4]
    assert bm25.bm25_topk(asked, docs.limit(0), 3).collect() == [] and bm25.bm25_topk(asked.limit(0), docs, 3).collect() == []


def test_large_steps_are_cut_at_texts(spark, monkeypatch):
    asked, docs = frames(spark)
    whole = ranking(bm25.bm25_topk(asked, docs, 6))
    monkeypatch.setattr(bm25, "CELLS", 2)
    assert ranking(bm25.bm25_topk(asked, docs, 6)) == whole


@pytest.mark.parametrize("max_queries", [2000, 4])
@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_knn_equals_brute_force(vectors, metric, max_queries):
    data, queries, df = vectors
    found = knn.knn_topk(queries, df, 5, metric=metric, max_queries=max_queries)
    got = {}
    for q, rank, i, s in ranking(found, "vec_id"):
        got.setdefault(q, []).append(i)
        assert rank == len(got[q]) - 1
    for n in range(9):
        sims = np.round(data @ data[n * 5], 9)
        assert got[f"q{n}"] == sorted(range(400), key=lambda i: (-sims[i], i))[:5]
    assert got["q1"][:3] == [5, 7, 11]


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_approximate_neighbours(spark, vectors, metric):
    """Close neighbours are found by looking at a fraction of the pairs, hot buckets cut up or not."""
    data, queries, _ = vectors
    rng = np.random.default_rng(9)
    close = data[np.repeat(np.arange(0, 45, 5), 4)] + 0.05 * rng.normal(size=(36, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([rng.normal(size=(600, 16)), close]).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    pairs = lambda f: {(r["query_id"], r["vec_id"]) for r in f.collect()}
    exact, approx = pairs(knn.knn_topk(queries, df, 4, metric="cosine")), pairs(knn.knn_approx(queries, df, 4, metric="cosine"))
    assert len(exact & approx) / len(exact) > 0.9
    looked = knn.candidate_pairs(queries, df, "query_id", "vec_id", "embedding", 12, 6)
    assert looked.count() < 0.35 * 9 * 636
    assert pairs(knn.candidate_pairs(queries, df, "query_id", "vec_id", "embedding", 12, 6, part=3)) == pairs(looked)
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in knn.knn_approx(queries, df, 50, metric=metric).collect()}
    every = {(r["query_id"], r["vec_id"]): r["score"] for r in knn.knn_topk(queries, df, 636, metric=metric).collect()}
    assert all(abs(every[p] - s) < 1e-6 for p, s in found.items())


def test_approximate_neighbours_of_the_embeddings(spark):
    """Against brute force on the real table, for every row whose id is divisible by 100."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    asked = df.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    pairs = lambda f: {(r["query_id"], r["vec_id"]) for r in f.collect()}
    exact, approx = pairs(knn.knn_topk(asked, df, 10)), pairs(knn.knn_approx(asked, df, 10))
    assert len(exact) == 200 and len(exact & approx) / len(exact) >= 0.9
    looked = knn.candidate_pairs(asked, df, "query_id", "vec_id", "embedding", 12, 6, probes=4)
    assert looked.count() < 0.65 * 20 * 2000


def test_unsound_vectors_take_no_part_and_are_listed(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [nan, 0.0]), (5, [None, 1.0]), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    asked = spark.createDataFrame([("q", [1.0, 0.1]), ("z", None)], "query_id string, embedding array<float>")
    for search in (knn.knn_topk, knn.knn_approx):
        assert {r["vec_id"] for r in search(asked, df, 9).collect()} <= {1, 6}
    assert [r["vec_id"] for r in knn.knn_topk(asked, df, 9).orderBy("rank").collect()] == [1, 6]
    assert sorted(r["vec_id"] for r in knn.unsound(df, 2).collect()) == [2, 3, 4, 5]


def test_best_of_keeps_the_first_of_equal_scores():
    scores = np.array([[0.0, 1], [0, 3], [2, -np.inf], [0, 3], [0, 3]])
    assert best_of(scores, 2).T.tolist() == [[True, False, True, False, False], [False, True, False, True, False]]
    assert best_of(scores, 9).sum() == 9


def test_embedding_plug_in(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a  B"), (3, "")], "id int, text string")
    lengths = knn.embed(df, "text", lambda texts: np.array([[len(t), 1.0] for t in texts]))
    assert [r["embedding"] for r in lengths.orderBy("id").collect()] == [[3.0, 1.0], [4.0, 1.0], [0.0, 1.0]]


def test_hashed_embedding_is_column_expressions(spark):
    texts = ["a b", "a  B", "", None, "x " * 500 + "y"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    hashed = knn.hashed(df, "text", 8)
    for r in hashed.collect():
        counts = np.zeros(8)
        for w in (r["text"] or "").lower().split():
            counts[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 8] += 1
        np.testing.assert_allclose(r["embedding"], counts / max(np.linalg.norm(counts), 1e-300), rtol=1e-6)
    plan = hashed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def lists(spark, *orders):
    return [
        spark.createDataFrame([("q", i, rank) for rank, i in enumerate(order)], "query_id string, doc_id string, rank int")
        for order in orders
    ]


@pytest.mark.parametrize(
    "dense,sparse,expected",
    [
        ("ab", "ab", [("a", 2 / 61), ("b", 2 / 62)]),
        ("ac", "ad", [("a", 2 / 61), ("c", 1 / 62), ("d", 1 / 62)]),
        ("a", "d", [("a", 1 / 61), ("d", 1 / 61)]),
        ("a", "", [("a", 1 / 61)]),
    ],
)
def test_rank_fusion(spark, dense, sparse, expected):
    fused = fusion.rrf(lists(spark, dense, sparse)).orderBy("rank").collect()
    assert [(r["doc_id"], r["fused_score"]) for r in fused] == [(d, pytest.approx(s, abs=1e-9)) for d, s in expected]


def test_rerank_is_stable_and_takes_any_scorer(spark):
    rows = [("q", "x y", "none", 0), ("q", "x y", "x", 1), ("q", "x y", "y", 2), ("q", "x y", "y x", 3)]
    df = spark.createDataFrame(rows, "query_id string, query string, text string, rank int")
    best = fusion.rerank(df, word_overlap(F.col("query"), F.col("text")), 3).orderBy("rank").collect()
    assert [(r["text"], r["candidate_rank"]) for r in best] == [("y x", 3), ("x", 1), ("y", 2)]

    @F.pandas_udf("double")
    def longest(texts: pd.Series) -> pd.Series:
        return texts.str.len().astype(float)

    assert [r["text"] for r in fusion.rerank(df, longest("text"), 1).collect()] == ["none"]


def test_retrieval_report_matches_known_runs(spark):
    runs = [[0.637, 0.545, 0.674], [0.672, 0.579, 0.541], [0.744, 0.432, 0.547], [0.652, 0.447, 0.626]]
    rows = [(q, rank, s) for q, sims in enumerate(runs) for rank, s in enumerate(sims)] + [(9, 0, 0.3), (9, 1, 0.1), (9, 2, 0.31)]
    report = fusion.evaluate_retrieval(spark.createDataFrame(rows, "query_id int, rank int, similarity double"))
    found = {r["query_id"]: r for r in report.collect()}
    assert [found[q]["avg_similarity"] for q in range(4)] == [0.619, 0.597, 0.574, 0.575]
    assert found[0]["per_chunk_scores"] == runs[0] and found[0]["chunks_in_context"] == 3
    assert (found[9]["context_precision"], found[9]["low_precision"]) == (0.333, True)
    overall = fusion.overall_retrieval(report.where("query_id < 9")).first()
    assert (overall["avg_context_precision"], overall["avg_similarity"], overall["queries"]) == (1.0, 0.591, 4)


def test_chunks(spark):
    texts = {
        "title": "# My Doc \n\n## One\nbody\n### sub\n\n## Two  \n",
        "preamble": "# T\nintro\n## A\nx",
        "plain": "no headings\nat all",
        "starts": "## First\nx\n##NoSpace\ny",
        "bare": "# Only title",
        "empty": " \n ",
        "split": "##\nfoo\n## Ok\x0bnot title",
    }
    docs = spark.createDataFrame(list(texts.items()), "slug string, text string")
    chunked = chunk_sections(docs, "slug", "text", F.concat("slug", F.lit(".md")))
    found = {r["chunk_id"]: (r["doc_title"], r["section_title"], r["text"]) for r in chunked.collect()}
    assert found == {
        "title::1": ("My Doc", "One", "## One\nbody\n### sub"),
        "title::2": ("My Doc", "Two", "## Two"),
        "preamble::0": ("T", "Overview", "# T\nintro"),
        "preamble::1": ("T", "A", "## A\nx"),
        "plain::0": ("plain.md", "Overview", "no headings\nat all"),
        "starts::0": ("starts.md", "First", "## First\nx\n##NoSpace\ny"),
        "split::0": ("split.md", "Overview", "##\nfoo"),
        "split::1": ("split.md", "Ok", "## Ok\x0bnot title"),
    }


def test_chunks_in_corpus_order(spark):
    ids = ["a::10", "a::2", "b::0", "a::2::1", "a::0"]
    df = spark.createDataFrame([(i,) for i in ids], "chunk_id string").withColumn("position", corpus_order("chunk_id"))
    rows = df.withColumn("back", chunk_of("position")).orderBy("position").collect()
    assert [r["chunk_id"] for r in rows] == ["a::0", "a::2", "a::10", "a::2::1", "b::0"] and all(r["back"] == r["chunk_id"] for r in rows)


def test_context_and_citations(spark):
    asked = spark.createDataFrame([(1, "why?"), (2, "none")], "query_id int, query string")
    chunks = spark.createDataFrame([("a", "Doc", "Sec", "x" * 201), ("b", "Doc", "Two", "short")],
                                   "chunk_id string, doc_title string, section_title string, text string")
    ranked = spark.createDataFrame([(1, "b", 0), (1, "a", 1)], "query_id int, chunk_id string, rank int")
    found = {r["query_id"]: r for r in build_context(asked, fetch_chunks(ranked, chunks)).collect()}
    assert found[1]["context"] == "[1] short\n\n[2] " + "x" * 201
    assert [(c["citation"], c["excerpt"]) for c in found[1]["citations"]] == [
        ("Doc > Two", "short"), ("Doc > Sec", "x" * 200 + "..."),
    ]
    assert found[1]["prompt"].endswith("Question: why?\nAnswer:") and found[2]["citations"] == [] and found[2]["context"] == ""


def test_live_status_of_the_first_flight_named(spark):
    questions = ["Where is SV123-20260806 or XY1234-20260806?", "And F3123-20260806?", "hello", "xSV123-20260806", "SV999-20260806"]
    asked = spark.createDataFrame(list(enumerate(questions)), "query_id int, query string")
    state = spark.createDataFrame([("SV123-20260806", "DELAYED", "A1", 30, "ATC"), ("F3123-20260806", "ARRIVED", None, None, None)],
                                  "flight_id string, status string, gate string, delay_minutes int, delay_reason_code string")
    found = {r["query_id"]: r["live_status"] for r in lookup_extracted_key(asked, state, "flight_id").collect()}
    assert found[0].asDict() == {
        "flight_id": "SV123-20260806", "status": "DELAYED", "gate": "A1", "delay_minutes": 30, "delay_reason_code": "ATC",
    }
    assert [found[i] for i in range(1, 5)] == [None] * 4


def test_excerpt_and_extract(spark):
    row = spark.createDataFrame([("a" * 200, "n1 n2")], "t string, u string").select(
        excerpt(F.col("t")).alias("e"), extract_first(F.col("u"), r"(n\d)").alias("x"), extract_first(F.col("u"), "(z)").alias("z")
    ).first()
    assert (row["e"], row["x"], row["z"]) == ("a" * 200, "n1", None)


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_approximate_neighbours_meet_by_bucket_and_not_as_pairs(spark, metric):
    """The k best of the candidate pairs, buckets cut up or not, copies included, without a row for a pair."""
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(size=(150, 8)), np.repeat(rng.normal(size=(1, 8)), 60, axis=0), np.zeros((3, 8))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id bigint, embedding array<float>")
    asked = df.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    pairs = knn.candidate_pairs(asked, df, "query_id", "vec_id", "embedding", 12, 6, probes=4)
    both = pairs.join(asked.withColumnRenamed("embedding", "a"), "query_id").join(df.withColumnRenamed("embedding", "b"), "vec_id")
    scored = both.select("query_id", "vec_id", knn._score(F.col("a"), F.col("b"), metric).alias("score"))
    expected = ranking(rank_top(scored, "query_id", [F.col("score").desc(), F.col("vec_id")], 7), "vec_id")
    for part_bytes in (1 << 20, 5 * 8 * 4):
        found = knn.knn_approx(asked, df, 7, metric=metric, part_bytes=part_bytes)
        assert ranking(found, "vec_id") == expected
        assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()


def test_words_are_split_in_slices_of_bounded_bytes(spark):
    """Batches of many long texts are never split whole, and slices give what one batch gives."""
    texts = pa.array(["a b " * 100, None, "", "c " * 5000, *["d e f"] * 300])
    cut = list(slices(texts, 2000))
    assert [s for s, _ in cut] == [0, *np.cumsum([n for _, n in cut])[:-1]] and sum(n for _, n in cut) == len(texts) and list(slices(texts.slice(0, 0))) == []
    assert all(n == 1 or sum(len(t or "") for t in texts.slice(s, n).to_pylist()) <= 2000 for s, n in cut)
    long = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([f"w{k} x " * 20_000 for k in range(40)])], names=["id", "text"])
    made = list(bm25._count_words("id")(iter([long])))
    assert len(made) > 8 and [r for b in made for r in b.to_pylist()] == [
        {"id": k, "length": 40_000, "term": t, "tf": 20_000} for k in range(40) for t in (f"w{k}", "x")
    ]
    (vectors,) = knn._slots(8)(iter([long.column("text")]))
    assert vectors.to_pylist() == [v for t in long.column("text") for v in next(knn._slots(8)(iter([pa.array([t.as_py()])]))).to_pylist()]
    counted = list(segments._count_texts("id")(iter([long])))
    assert len(counted) > 8 and sum(b.num_rows for b in counted) == 40


def test_texts_are_scored_where_they_are(spark):
    """Searching texts without an index shuffles lists and vocabulary, no postings; ids of text are compared as text."""
    texts = ["a b c", "b  b\x1cc", "", None, "d \u2003a", "c"] * 3
    docs = spark.createDataFrame([(f"t{n:02d}", t) for n, t in enumerate(texts)], "doc_id string, text string").repartition(3)
    asked = spark.createDataFrame([(1, "B c c"), (2, "zzz"), (3, "a d")], "query_id int, query string")
    found = bm25.bm25_topk(asked, docs, 5)
    assert ranking(found) == ranking(bm25.search(asked, bm25.build(docs, "doc_id", "text"), 5))
    assert "tf#" not in found._jdf.queryExecution().executedPlan().toString()
    expected = sorted(tuple(r) for r in bm25.document_frequency(bm25.postings(docs, "doc_id", "text")).collect())
    assert sorted(tuple(r) for r in bm25.frequency(docs, "text").collect()) == expected


def test_stored_index_is_counted_where_it_lies(spark, tmp_path):
    docs = spark.createDataFrame([(n, f"w{n % 7} common w{n % 3}") for n in range(50)], "doc_id int, text string")
    bm25.store(docs, "doc_id", "text", str(tmp_path / "stored"))
    bm25.write(bm25.build(docs, "doc_id", "text"), str(tmp_path / "written"))
    assert spark.read.parquet(f"{tmp_path}/stored/stats").first() == pytest.approx(spark.read.parquet(f"{tmp_path}/written/stats").first())
    for name in ("postings", "terms", "ids"):
        stored, written = (sorted(map(str, spark.read.parquet(f"{tmp_path}/{place}/{name}").collect())) for place in ("stored", "written"))
        assert stored == written
