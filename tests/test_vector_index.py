"""The trained vector index: recall on the test tables, pruning, hot cells, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.operators import knn, vector_index

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "vectors")
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    vector_index.build(vectors, path)
    asked = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors, vector_index.read(spark, path), asked


def pairs(df):
    return {(r["query_id"], r["vec_id"]): r["score"] for r in df.collect()}


def test_recall_of_all_ids_divisible_by_100(stored):
    vectors, index, asked = stored
    found, true = pairs(vector_index.search(asked, index, 10)), pairs(knn.knn_topk(asked, vectors, 10))
    assert len(found) == len(true) and len(found.keys() & true.keys()) >= 0.9 * len(true)
    assert all(found[p] == pytest.approx(true[p], abs=1e-6) for p in found.keys() & true.keys())
    looked = vector_index.compared(asked, index, 50).first()
    assert looked["in_full"] <= 0.1 * looked["pairs"] and looked["by_code"] < looked["pairs"]


def test_every_row_is_indexed_once(stored):
    vectors, index, _ = stored
    assert index.lists.count() == vectors.count() == index.lists.select("vec_id").distinct().count()
    assert index.sizes.agg(F.sum("rows")).first()[0] == vectors.count()


def test_cells_grow_with_the_table(spark, stored, tmp_path):
    vectors, index, _ = stored
    vector_index.build(vectors.where("vec_id < 500"), str(tmp_path / "small"))
    small = vector_index.read(spark, str(tmp_path / "small"))
    assert len(small.centroids) == 90 and len(index.centroids) == 179


def test_a_search_opens_only_the_folders_it_probes(stored):
    _, index, asked = stored
    one = asked.limit(1)
    cells = [r["cell"] for r in vector_index._probed(one, index, "query_id", "embedding", 1).collect()]
    per_shelf = -(-len(index.centroids) // vector_index.SHELVES)
    opened = index.lists.where(F.col("shelf").isin([c // per_shelf for c in cells]))
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "shelf#" in plan.split("PartitionFilters")[1]
    assert pairs(vector_index.search(one, index, 3, probes=1))


def test_cut_lists_and_blocks_of_queries_give_the_same(stored, monkeypatch):
    _, index, asked = stored
    whole = pairs(vector_index.search(asked, index, 5))
    monkeypatch.setattr(vector_index, "PART", 5)
    monkeypatch.setattr(vector_index, "BLOCK", 3)
    assert pairs(vector_index.search(asked, index, 5)) == whole


def test_copies_odd_vectors_and_short_tables(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.0, 2.0], "own") for i in range(300)]  # one vector owns most rows
    rows += [(300 + i, rng.normal(size=3).tolist(), "own") for i in range(60)]
    rows += [(900, None, "x"), (901, [1.0], "x"), (902, [float("nan"), 0.0, 1.0], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    vector_index.build(vectors, str(tmp_path / "ix"))
    index = vector_index.read(spark, str(tmp_path / "ix"))
    asked = spark.createDataFrame([(1, [1.0, 0.0, 2.0]), (2, None), (3, [0.0, 0.0])], "query_id long, embedding array<double>")
    found = pairs(vector_index.search(asked, index, 10, probes=len(index.centroids)))
    assert {q for q, _ in found} == {1} and {v for _, v in found} <= set(range(300)) and set(found.values()) == {0.0}
    two = vectors.where("vec_id IN (300, 301)")
    vector_index.build(two, str(tmp_path / "two"))
    assert len(pairs(vector_index.search(asked, vector_index.read(spark, str(tmp_path / "two")), 10))) == 2
    with pytest.raises(ValueError):
        vector_index.build(vectors.limit(0), str(tmp_path / "none"))
