import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa
import pytest

from helpers import FOLDER, near_copies, shingles, smallest_reachable, words
from opsledger.llm import near_dup, quality_rules, rolling
from opsledger.llm.components import components

SCHEMA = "doc_id long, text string, n_shingles string, kept string, rep int"


def hot_group(n=160, seed=2):
    """Copies of one text with a growing share of words changed: some only link to others, some to none."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    texts = []
    for k in range(n):
        copy = list(base)
        for _ in range(draw.randrange(0, 22)):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(10_000)}"
        texts.append(" ".join(copy))
    return texts


@given(st.lists(st.text(alphabet="aB \t\n\x0bé😀.", max_size=30), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_and_shingle_sets_are_those_of_a_plain_split(texts):
    column = pa.array(texts, pa.large_string())
    low = rolling.Texts.of(column).lower()
    found = rolling.words(low)
    spelled = [low.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)]
    assert spelled == [w for t in texts for w in words(t)]
    for size in (1, 2, 5):
        rows, codes = rolling.shingle_sets(rolling.Texts.of(column), size)
        assert np.bincount(rows, minlength=len(texts)).tolist() == [len(shingles(t, size)) for t in texts]
        names = {}
        for k, t in enumerate(texts):
            names.setdefault(shingles(t, size), set()).add(frozenset(codes[rows == k].tolist()))
        assert all(len(v) == 1 for v in names.values()) and len({x for v in names.values() for x in v}) == len(names)


def test_minima_agree_as_often_as_sets_do():
    rule = near_dup.Rule()
    draw = np.random.default_rng(1)
    codes = draw.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [codes[:2000], codes[500:2500]]
    m = near_dup._minima(np.concatenate(sets), np.array([0, 2000]), 400)
    assert abs((m[0] == m[1]).mean() - 1500 / 2500) < 0.1
    assert near_dup._halves(m[:, : rule.hashes].astype(np.int32), rule).shape == (2, 2 * rule.tables)


def test_edge_rows_and_a_hot_group(spark):
    """Nulls, empty and short texts, ties, repeated rows, clashing columns, and copies around the threshold."""
    texts = {k: t for k, t in enumerate(hot_group(), 100)}
    texts |= {1: None, 2: "", 3: " \n", 4: "Word", 5: "word", 6: "two words", 7: "TWO words", 8: "word word word", 9: "x" * 40_000 + " y", 10: "a b " * 20_000, 11: "a b " * 20_000}
    rows = [(i, t, "clash", "clash", 1) for i, t in texts.items()] + [(4, "Word", None, None, None), (None, "two words", None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    size = 2
    found = near_dup.near_duplicates(docs, near_dup.Rule(size=size)).collect()
    assert len(found) == len(rows)
    component, sizes = near_copies(texts, size)
    named = [r for r in found if r.doc_id is not None]
    assert sorted({(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in named}) == sorted(
        (i, sizes[i], component[i], component[i] == i) for i in texts
    )
    assert len(named) == len(texts) + 1
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is None) == [(0, None, True), (1, None, True)]


def test_members_outside_the_hubs_component_are_still_compared(spark, monkeypatch):
    """With blocks of a few members, every link of a chain of copies is found."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    texts = dict(enumerate(hot_group(90, 5)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_dup.near_duplicates(docs, near_dup.Rule(size=2)).collect()
    assert {r.doc_id: r.component_id for r in found} == near_copies(texts, 2)[0]


def test_an_empty_table_gives_an_empty_result(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(docs).collect() == []


def test_five_word_shingles_on_the_test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert found == near_copies(texts, 5)[0]


@pytest.mark.parametrize("shape", ["chain", "random"])
def test_components(spark, shape):
    draw = random.Random(3)
    links = [(k, k + 1) for k in range(40)] if shape == "chain" else [(draw.randrange(80), draw.randrange(80)) for _ in range(45)]
    links += links[:3] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    used = {i for a, b in links if a != b for i in (a, b)}
    assert found == smallest_reachable(used, [(a, b) for a, b in links if a != b])


def test_long_words_of_which_a_polynomial_hash_makes_one(spark):
    """Two letters in an order and in its opposite: modulo 2**64 their polynomials agree in any odd base."""
    order = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = order.translate(str.maketrans("ab", "ba"))
    texts = rolling.Texts.of(pa.array([f"{order} {other}", order, other, f"{order}\n{other}"], pa.large_string()))
    hashes = rolling.word_hashes(texts, rolling.words(texts))
    assert len(set(hashes.tolist())) == 2 and hashes[0] == hashes[2] != hashes[1] == hashes[3]
    docs = spark.createDataFrame([(1, f"one {order} two"), (2, f"one {other} two")], "doc_id long, text string")
    assert all(r["kept"] for r in near_dup.near_duplicates(docs, near_dup.Rule(size=2)).collect())
    lines = spark.createDataFrame([(1, f"{order}\n{other}\n{order}")], "doc_id long, text string")
    assert quality_rules.measure(lines).first()["n_dup_lines"] == 1


def test_table_keys_are_counted_by_slices_and_filtered(spark):
    """Counts of keys per slice add up to those of all texts; what the filter lets through holds every key of several texts."""
    rule = near_dup.Rule()
    minima = np.random.default_rng(3).integers(0, 2**31 - 1, (40, rule.hashes), dtype=np.int32)
    minima[20:] = minima[:20]
    column = pa.ListArray.from_arrays(pa.array(np.arange(41, dtype=np.int32) * rule.hashes), pa.array(minima.ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(40)), column], names=["doc_id", "minima"])
    counted = list(near_dup._key_counts(rule)(iter([batch.slice(0, 25), batch.slice(25)])))
    assert sum(c.column("n").to_numpy().sum() for c in counted) == 40 * rule.tables**2
    keys = np.unique(near_dup._keys_of(column, rule))
    several = spark.createDataFrame([(int(k),) for k in keys[:100]], "key long")
    found = list(near_dup._table_keys(rule, spark.sparkContext.broadcast(near_dup.Filter.of(several)))(iter([batch])))
    names = np.concatenate([f.column("key").to_numpy() for f in found])
    assert np.isin(keys[:100], names).all() and len(names) < 40 * rule.tables**2
