"""The segmented keyword index: loads, replacements, deletions and merges against an index built anew."""

import os
import random

import pytest
from pyspark.sql import functions as F

from opsledger.operators import bm25, segments

WORDS = [f"w{k}" for k in range(40)]


def frame(spark, texts):
    return spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")


def ranking(df):
    rows = sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"]))
    return [(r["query_id"], r["doc_id"], round(r["score"], 6)) for r in rows]


def texts_of(rng, ids, low=0, high=30):
    return {i: " ".join(rng.choices(WORDS, weights=range(40, 0, -1), k=rng.randint(low, high))) for i in ids}


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{root}/segments") for f in names}


@pytest.fixture(scope="module")
def asked(spark):
    rng = random.Random(8)
    rows = [(q, " ".join(rng.choices(WORDS, k=rng.randint(1, 6)))) for q in range(12)] + [(50, "unknown words"), (51, None), (52, "W3 w3 w3 w39")]
    return spark.createDataFrame(rows, "query_id long, query string")


def test_three_loads_equal_a_rebuilt_index_and_leave_old_segments_alone(spark, asked, tmp_path):
    rng, root = random.Random(4), str(tmp_path / "index")
    state = texts_of(rng, range(120))
    state[7] = None
    segments.apply(spark, root, frame(spark, state))
    before = files(root)
    second = texts_of(rng, [*range(100, 150), 3, 7], 40, 90)  # much longer: the mean length moves
    segments.apply(spark, root, frame(spark, second))
    state |= second
    third, gone = texts_of(rng, [3, 200, 201]), [5, 6, 100, 999]
    segments.apply(spark, root, frame(spark, third), deleted=spark.createDataFrame([(g,) for g in gone], "doc_id long"))
    state = {i: t for i, t in (state | third).items() if i not in gone}
    index = segments.read(spark, root)
    expected = ranking(bm25.bm25_topk(asked, frame(spark, state), 6))
    assert ranking(segments.search(asked, index, 6)) == expected
    rebuilt = bm25.build(frame(spark, state), "doc_id", "text").stats.first()
    assert index.corpus.documents == rebuilt["documents"] == len(state)
    assert index.corpus.mean_length == pytest.approx(rebuilt["mean_length"]) and index.corpus.mean_idf == pytest.approx(rebuilt["mean_idf"])
    now = files(root)
    assert all(now[name] == time for name, time in before.items())
    # The two small segments become one; the first stays, and so does what they masked in it.
    assert len(segments.merge(spark, root, 60)) == 2
    assert ranking(segments.search(asked, segments.read(spark, root), 6)) == expected
    assert len(segments.merge(spark, root, 1000)) == 1
    merged = segments.read(spark, root)
    assert ranking(segments.search(asked, merged, 6)) == expected and merged.mask.count() == 0
    assert all(files(root)[name] == time for name, time in before.items())


def test_fewer_postings_are_read_where_bounds_tell_texts_apart(spark, tmp_path):
    rng, root = random.Random(5), str(tmp_path / "index")
    texts = texts_of(rng, range(400), 60, 80)
    for i in range(0, 400, 40):
        texts[i] = "rare " * 5 + "w0 w1"
    segments.apply(spark, root, frame(spark, texts))
    index = segments.read(spark, root)
    asked = spark.createDataFrame([(1, "rare w30 w31")], "query_id long, query string")
    looked = segments.postings_read(asked, index, 5).first()
    assert looked["read"] < looked["matching"] / 2
    assert ranking(segments.search(asked, index, 5)) == ranking(bm25.bm25_topk(asked, frame(spark, texts), 5))


def test_small_and_empty_indexes(spark, asked, tmp_path):
    root = str(tmp_path / "index")
    segments.apply(spark, root, frame(spark, {1: "a b"}).where("false"))
    assert segments.search(asked, segments.read(spark, root), 3).collect() == []
    segments.apply(spark, root, frame(spark, {1: "w1 w2", 2: "w1", 3: "w1 w3"}))  # w1 is in all: mean weight below zero
    state = frame(spark, {1: "w1 w2", 2: "w1", 3: "w1 w3"})
    found = segments.search(asked, segments.read(spark, root), 2)
    assert ranking(found) == ranking(bm25.bm25_topk(asked, state, 2))
    segments.apply(spark, root, state.where("false"), deleted=state.select("doc_id"))
    assert segments.read(spark, root).corpus.documents == 0


def test_a_load_that_died_is_not_seen(spark, asked, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    texts = {i: f"w{i} w{i % 3} w1" for i in range(12)}
    segments.apply(spark, root, frame(spark, texts))
    expected = ranking(segments.search(asked, segments.read(spark, root), 3))
    monkeypatch.setattr(segments, "_commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        segments.apply(spark, root, frame(spark, {1: "w9 w9"}))
    monkeypatch.undo()
    assert ranking(segments.search(asked, segments.read(spark, root), 3)) == expected
    assert segments.read(spark, root).texts.where(F.col("doc_id") == 1).count() == 1


def test_a_block_is_shuffled_once_however_many_queries_ask(spark, tmp_path):
    """Many queries with the same words: what the search hands on are blocks and the best of each task, not a row for each query and zone."""
    rng, root = random.Random(6), str(tmp_path / "index")
    texts = texts_of(rng, range(600), 10, 30)
    segments.apply(spark, root, frame(spark, texts))
    segments.apply(spark, root, frame(spark, texts_of(rng, range(0, 600, 5))), deleted=frame(spark, texts).select("doc_id").where("doc_id % 7 = 3"))
    index = segments.read(spark, root)
    asked = spark.createDataFrame([(q, " ".join(rng.choices(WORDS, k=4))) for q in range(150)], "query_id long, query string")
    found = segments._found(segments._weighed(asked, index, "query_id", "query", 0.25), index, 2, "query_id")
    assert found.count() < 150 * 80 / 4  # 80 zones
    live = segments._unmasked(index.texts, index.mask, "doc_id").select("doc_id", F.concat_ws(" ", F.flatten(F.zip_with("words", "counts", F.array_repeat))).alias("text"))
    assert ranking(segments.search(asked, index, 2)) == ranking(bm25.bm25_topk(asked, live, 2))


def test_rows_follow_chunks_of_texts_not_postings(spark, tmp_path):
    """What Spark writes, sorts and moves for an index is a row per chunk and folder of words, however many postings there are."""
    rng, root = random.Random(7), str(tmp_path / "index")
    texts = texts_of(rng, range(600), 10, 30)
    segments.apply(spark, root, frame(spark, texts).coalesce(1))
    assert segments.read(spark, root).blocks.count() <= segments.BUCKETS


def test_texts_of_several_chunks_and_ids_that_are_words(spark, asked, tmp_path):
    rng, root = random.Random(9), str(tmp_path / "index")
    texts = {i: " ".join(rng.choices(WORDS, weights=range(40, 0, -1), k=rng.randint(0, 1200))) for i in range(2500)}  # some 5 MB
    named = lambda texts: frame(spark, texts).withColumn("doc_id", F.format_string("t%05d", "doc_id")).coalesce(1)
    segments.apply(spark, root, named(texts))
    changed = texts_of(rng, [3, 700, 2499, 3000])
    gone = named({i: "" for i in range(0, 2500, 7)})
    segments.apply(spark, root, named(changed), deleted=gone)
    state = {i: t for i, t in texts.items() if i % 7} | changed
    expected = ranking(bm25.bm25_topk(asked, named(state), 6))
    index = segments.read(spark, root, "doc_id string")
    assert index.chunks.count() > 2
    assert ranking(segments.search(asked, index, 6)) == expected
    assert len(segments.merge(spark, root, 10_000, "doc_id string")) == 1
    merged = segments.read(spark, root, "doc_id string")
    assert ranking(segments.search(asked, merged, 6)) == expected
    held = {r["doc_id"]: dict(zip(r["words"], r["counts"])) for r in merged.texts.collect()}
    assert held == {f"t{i:05d}": {w: t.split().count(w) for w in set(t.split())} for i, t in state.items()}
