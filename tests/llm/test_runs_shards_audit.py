"""Periodic runs, sharding by label propagation and the audit of filters, against plain versions."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.llm import filter_audit, label_shards, periodic_runs
from opsledger.llm.queries import QUERIES
from tests.llm.helpers import FOLDER

SCHEMA = "doc_id long, text string, lang string"


def plain_runs(words, least):
    """Every stretch of every period, the smallest period of each kept."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, q, e) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, q, e in runs for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words_equal_plain_search():
    rng = random.Random(3)
    for _ in range(1500):
        words = [rng.randint(1, rng.choice([1, 2, 3, 4])) for _ in range(rng.randint(0, 48))]
        if words and rng.random() < 0.5:
            at, p = rng.randrange(len(words)), rng.randint(1, 9)
            words = [w if i < at else words[min(at + (i - at) % p, len(words) - 1)] for i, w in enumerate(words)]
        start, end, period = periodic_runs.runs(np.array(words + [-1]), 2)
        assert list(zip(start.tolist(), period.tolist(), end.tolist())) == plain_runs(words, 2)


def test_a_period_hidden_between_two_progressions_is_found():
    words = list("ababababa" + "abababa" + "ba")
    found = periodic_runs.runs(np.array([ord(c) for c in words] + [-1]), 2)
    assert (2, 7, 16) in list(zip(*(column.tolist() for column in (found[0], found[2], found[1]))))


def test_long_texts_of_one_word_and_of_nested_periods():
    found = periodic_runs.runs(np.append(np.ones(300_000, dtype=np.int64), -1))
    assert [x.tolist() for x in found] == [[0], [300_000], [1]]
    first, second = "a", "ab"
    while len(second) < 3000:
        first, second = second, second + first
    found = periodic_runs.runs(np.array([ord(c) for c in second] + [-1]))
    assert list(zip(found[0].tolist(), found[2].tolist(), found[1].tolist())) == plain_runs(second, 12)


def test_runs_of_edge_texts(spark):
    long_word = "x" * 5000
    texts = [None, "", " \n\t ", "a " * 12, "a " * 11, "a b " * 12, f"{long_word} " * 12 + "end", "one two three four five six " * 2, "a " * 12]
    docs = spark.createDataFrame([(i // 2, t, "x", [i]) for i, t in enumerate(texts)], "doc_id long, text string, RUNS string, n_words array<int>")
    rows = sorted(periodic_runs.find(docs).collect(), key=lambda r: (r["doc_id"], r["n_words"]))
    assert len(rows) == len(texts)
    by_text = {r["text"]: r for r in rows}
    for text in texts:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = plain_runs(words, 12)
        assert [(r["start"], r["period"], r["start"] + r["length"]) for r in by_text[text]["runs"]] == runs
        assert by_text[text]["collapsed"] == collapsed(words, runs) and by_text[text]["n_words"] == len(words)
    assert by_text["a " * 12]["collapsed"] == "a" and by_text["a " * 11]["runs"] == []
    assert not periodic_runs.find(docs.limit(0)).count()


def test_run_query_equals_plain_planting(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        words = (doc["text"] or "").encode().split()
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # the plain search takes the square of the length
        runs = plain_runs(words, 12)
        best = max(((e - s, -s, -q) for s, q, e in runs), default=None)
        row = rows[doc["doc_id"]]
        assert row["n_runs"] == len(runs)
        assert (row["length"], row["start"], row["period"]) == ((best[0], -best[1], -best[2]) if best else (None, None, None))


def balanced(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts.get(s, 0)))


def test_small_groups_stay_whole_and_shards_even(spark):
    rng = random.Random(5)
    texts = [f"text {k}" for k in range(60) for _ in range(rng.randint(2, 9))] + [f"alone {k}" for k in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = label_shards.shard_documents(docs, label_shards.Rule(block=50)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    balanced(rows, 8)
    where = defaultdict(set)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        where[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_a_group_of_a_third_of_all_rows_is_cut_into_few_parts(spark):
    texts = ["hot"] * 400 + [f"text {k // 3}" for k in range(300)] + [f"alone {k}" for k in range(500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = label_shards.shard_documents(docs, label_shards.Rule(block=64)).collect()
    balanced(rows, 8)
    hot = Counter(r["shard"] for r in rows if texts[r["doc_id"]] == "hot")
    assert sum(sorted(hot.values())[-4:]) >= 380  # of 150 rows a shard some belong to other groups
    where = defaultdict(set)
    for r in rows:
        where[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for t, s in where.items() if t != "hot") <= 5


def test_shards_where_all_are_linked_repeated_or_null(spark):
    one = [(None, None)] * 5 + [(7, "same")] * 20 + [(8, "")] * 4
    rows = label_shards.shard_documents(spark.createDataFrame(one, "doc_id long, text string").withColumn("shard", F.lit("own"))).collect()
    assert Counter(r["doc_id"] for r in rows) == {None: 5, 7: 20, 8: 4}
    balanced(rows, 8)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] != 7} == {(1, 0)}
    assert not label_shards.shard_documents(spark.createDataFrame([], "doc_id long, text string")).count()


def test_propagation_keeps_cliques_joined_by_one_link_whole(spark):
    links = [(n, g) for g, members in enumerate([range(0, 10), range(10, 20), [9, 10]]) for n in members]
    nodes = spark.createDataFrame([(n, 1) for n in range(20)], "node long, weight int")
    found = label_shards.propagate(nodes, spark.createDataFrame(links, "node long, `group` int"), [12, 12], label_shards.Rule(shards=2))
    where = {r["node"]: r["shard"] for r in found.collect()}
    cut = sum(where[a] != where[b] for k in (0, 10) for a, b in itertools.combinations(range(k, k + 10), 2))
    assert len(where) == 20 and cut <= 18 and max(Counter(where.values()).values()) <= 12


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    masks = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        }
        masks[lang or ""].append((i, {k for k, bad in fails.items() if bad}))
    out = {}
    for part, rows in masks.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order):
                before = set(order[:step])
                removed = [i for i, f in rows if letter in f and not f & before]
                shapley[letter] += len(removed)
                out[part, "".join(order), step + 1] = [
                    sum(not f & (before | {letter}) for _, f in rows), len(removed), sum(letter in f and bool(f & before) for _, f in rows),
                    sum(f == {letter} for _, f in rows), sum(i in good for i in removed), sum(i in toxic for i in removed), letter,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = shapley[row[6]]
    return out


def told(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in df.collect()}


def test_audit_equals_plain_enumeration(spark):
    rng = random.Random(11)
    docs = []
    for k in range(250):
        words = [rng.choice(["a", "B", "cc", "d#d", "Ee", f"w{k}", f"v{rng.randrange(400)}"]) for _ in range(rng.choice([0, 3, 199, 200, 230]))]
        docs.append((rng.choice([None, k, k, k // 2]), rng.choice([" ".join(words), " ".join(words), None, "same text"]), rng.choice(["en", "de", None, ""])))
    docs += docs[:3]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 250, 2)] + [(None, 1, 1), (4, 1, 0)]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("n_words", F.lit("own"))
    found = filter_audit.audit_documents(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert told(found) == plain_audit(docs, labels)
    assert not filter_audit.audit_documents(frame.limit(0), spark.createDataFrame(labels[:0], "doc_id long, quality int, toxic int")).count()


@pytest.mark.parametrize("limit", ["1000"])
def test_audit_of_more_rows_than_a_recursion_may_return_by_default(spark, limit):
    spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    try:
        cells = spark.createDataFrame([(f"p{k}", 1, 2, 1, 0) for k in range(10)], "part string, mask int, documents long, good long, toxic long")
        assert filter_audit.audit(cells, "ABCDE").count() == 10 * 600
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
