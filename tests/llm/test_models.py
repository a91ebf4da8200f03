import math
import pathlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import FOLDER, words
from opsledger.llm import language_id, quality_rules, suffix_chunks, suffix_tree, zstd_quality
from opsledger.llm.tables import fold, materialize
from opsledger.session import checkpoint_dir

LARGER = "/root/testdata/sf0.01"


def test_the_fold_is_a_crc_of_the_id(spark):
    ids = [0, 1, -5, 123456789, None]
    found = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", fold().alias("f")).collect()
    assert {r.doc_id: r.f for r in found} == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 for i in ids}


# Quality rules


def plain_measures(text):
    w = quality_words(text)
    lines = [line for line in (text or "").split("\n") if quality_words(line)]
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    seen, again = Counter(windows), set()
    for k, x in enumerate(windows):
        if seen[x] > 1:
            again |= set(range(k, k + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


def quality_words(text):
    import helpers

    return helpers.WORD.findall(text or "")


def test_measures_and_hosts(spark):
    junk, fine = "### buy *** now $$$ " * 10, " ".join(f"word{k}" for k in range(40))
    texts = [None, "", "\n\n", "a\nb\na\n a\n", "é ü 😀 #", "x y z " * 30, fine, junk, fine + "\n" + fine, "one " * 50]
    rows = [(k, t, None if k % 3 == 0 else "h", 1) for k, t in enumerate(texts)] + [(6, fine, "h", 1), (100, junk, "bad", 1), (101, junk, "bad", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    found = quality_rules.verdicts(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for k, t, *_ in rows:
        assert tuple(by[k][1:6]) == plain_measures(t)
    assert not by[0].kept and by[0].base_failed and by[6].kept and not by[7].kept and not by[9].kept
    assert by[100].host_failed and by[0].host_rate is not None
    assert quality_rules.verdicts(docs.limit(0)).collect() == []


def test_a_strict_host_holds_its_documents_to_more(spark):
    """The same document passes on a clean host and fails on one where most documents do."""
    fine = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    between = " ".join(f"b{j}" for j in range(80)) + " #" * 16  # symbols: over the strict limit, under the lenient one
    rows = [(k, fine(k), "clean") for k in range(40)] + [(100 + k, "### *** " * 30, "bad") for k in range(40)]
    rows += [(200, between, "clean"), (201, between, "bad"), (202, fine(202), "bad")]
    by = {r.doc_id: r for r in quality_rules.verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert by[200].kept and not by[201].kept and by[202].kept
    # Shrunk towards the mean: neither rate is the plain share.
    assert 0 < by[0].host_rate < by[100].host_rate < 1


# Suffix tree


def scored_rows(spark, rows, rule=suffix_tree.Rule()):
    return suffix_tree.learn_and_score(spark.createDataFrame(rows, "doc_id long, held_out boolean, text string"), rule).collect()


def test_base_scores_are_plain_counts(spark):
    rows = [(1, False, "A b a"), (1, False, "A b a"), (2, False, None), (3, True, "b c zz zz"), (None, True, ""), (4, False, "É é \n c" * 200)]
    counts = Counter(w for _, held, t in rows if not held for w in [*words(t), None])
    total, kinds = sum(counts.values()), len(counts)

    def expected(row):
        own = [*words(row[2]), None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        return (row[0] or 0, row[1], len(own), sum(counts[w] > 0 for w in own), total, round(base, 6))

    found = sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored_rows(spark, rows))
    assert found == sorted(map(expected, rows))


def test_contexts_that_matter_become_states(spark):
    """Words that follow each other are likelier together; with independent words the tree is its root."""
    draw = np.random.default_rng(4)
    song = [(k, False, "the cat sat on a mat and the dog ran to a hill " * 8) for k in range(40)]
    made = scored_rows(spark, [*song, (900, True, "the cat sat on a mat"), (901, True, "mat the on cat a sat")])
    by = {r.doc_id: r for r in made}
    assert by[900].base_score == pytest.approx(by[901].base_score) and by[900].score > by[901].score + 3
    assert by[900].score > by[900].base_score
    loose = spark.createDataFrame([(k, " ".join(draw.choice(list("abcdefgh"), 60))) for k in range(60)], "doc_id long, text string")
    vocab = suffix_tree.vocabulary(loose)
    tree = suffix_tree.grow(loose, vocab)
    assert len(tree.log10) <= 3
    np.testing.assert_allclose((10**tree.log10).sum(axis=1), 1)


def plain_scores(rows, rule):
    """Scores over every context of the learning texts, by dictionaries; `()` is the root, contexts end with the latest symbol."""
    after, counts = {}, Counter(w for _, held, t in rows if not held for w in [*words(t), None])
    for _, held, text in rows:
        told = ["<start>", *words(text), None]
        for at in range(1, len(told)):
            for d in range(1, rule.depth + 1):
                if not held and d <= at:
                    after.setdefault(tuple(told[at - d : at]), Counter())[told[at]] += 1
    tested = {c: n for c, n in after.items() if sum(n.values()) >= rule.least}

    def chance(c, w):
        if not c:
            return (counts[w] + 0.5) / (sum(counts.values()) + 0.5 * (len(counts) + 1))
        n = tested[c]
        return (n[w] + len(n) * chance(c[1:], w)) / (sum(n.values()) + len(n))

    def diverges(c):
        n, total, size = tested[c], sum(tested[c].values()), sum(len(o) == len(c) for o in tested)
        far = sum(k * math.log(k / total / chance(c[1:], w)) for w, k in n.items())
        gains = []
        for a in suffix_tree.PRIORS:
            each = (math.lgamma(k + a * chance(c[1:], w)) - math.lgamma(a * chance(c[1:], w)) - k * math.log(chance(c[1:], w)) for w, k in n.items())
            gains.append(math.lgamma(a) - math.lgamma(a + total) + sum(each))
        return far >= rule.divergence * total and max(gains) - math.log(len(gains)) >= math.log(size) + rule.chance

    states = {c[k:] for c in tested if diverges(c) for k in range(len(c))}
    scores = []
    for _, _, text in rows:
        told = ["<start>", *words(text), None]
        before = [[c for d in range(rule.depth, 0, -1) if d <= at and (c := tuple(told[at - d : at])) in states] for at in range(1, len(told))]
        scores.append(sum(math.log10(chance(c[0] if c else (), w)) for c, w in zip(before, told[1:])))
    return scores, states


@pytest.mark.parametrize("known", [100_000, 1])
def test_scores_are_those_of_all_contexts_counted_plainly(spark, known):
    """Looked up in the task or met in the join."""
    draw, rule = np.random.default_rng(6), suffix_tree.Rule(known=known)
    pool = [f"w{k}" for k in range(60)]
    rows = [(k, bool(k % 5 == 1), " ".join(draw.choice(pool, int(draw.integers(0, 40))))) for k in range(80)]
    rows += [(100 + k, False, f"{draw.choice(pool)} {['one fine phrase of words', 'two fine phrase of signs'][k % 2]} {draw.choice(pool)}") for k in range(40)]
    rows += [(200, True, "two fine phrase of words"), (201, False, None), (202, True, "")]
    expected, states = plain_scores(rows, rule)
    found = {r.doc_id: r.score for r in scored_rows(spark, rows, rule)}
    assert max(map(len, states)) == 4 and len(found) == len(rows)
    assert [found[r[0]] for r in rows] == pytest.approx(expected, abs=1e-6)


def test_a_phrase_far_below_any_share_of_the_corpus_becomes_states(spark):
    """Ten copies of a phrase of words found nowhere else, among 60,000 tokens."""
    draw = np.random.default_rng(7)
    pool = [f"w{k}" for k in range(3000)]
    rows = [(k, False, " ".join(draw.choice(pool, 600))) for k in range(100)]
    rows += [(200 + k, False, "w1 quiet amber rivers turn slowly w2") for k in range(10)]
    rows += [(300, True, "quiet amber rivers turn slowly"), (301, True, "slowly turn rivers amber quiet")]
    by = {r.doc_id: r for r in scored_rows(spark, rows)}
    assert by[300].score > by[300].base_score + 5 and by[301].score < by[300].score - 5


def test_scoring_held_out_documents_beats_the_word_model(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", (fold() == 1).alias("held_out"), "text")
    held = suffix_tree.learn_and_score(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_chunks_score_as_the_tables_of_a_tree_do(spark, monkeypatch):
    """Many small chunks and ranges; a very frequent word, copies, null and empty texts, null and repeated ids."""
    draw = np.random.default_rng(11)
    pool = [f"w{k}" for k in range(50)]
    rows = [(k, k % 5 == 1, "the " + " the ".join(draw.choice(pool, int(draw.integers(1, 30))))) for k in range(120)]
    rows += [(200 + k, False, "many copies of the very same short text") for k in range(40)]
    rows += [(None, True, "copies of the text"), (200, True, "the"), (300, False, None), (301, True, ""), (302, True, "never seen")]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)
    rule = suffix_tree.Rule()
    vocab = suffix_tree.vocabulary(docs.filter("not held_out"))
    expected = suffix_tree.score(docs, vocab, suffix_tree.grow(docs.filter("not held_out"), vocab, rule), rule).collect()
    monkeypatch.setattr(suffix_chunks, "RANGES", 7)
    found = suffix_tree.learn_and_score(docs, rule).collect()

    def told(rows):
        return sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows)

    assert told(found) == told(expected) and any(r.score > r.base_score + 1 for r in found)


def test_packed_arrays_come_back():
    for a in (np.array([], np.int64), np.array([0, 0], np.int32), np.array([5, 1 << 40, 0], np.uint64), np.array([True, False]), np.array([2**64 - 1], np.uint64)):
        (back,) = suffix_chunks.unpack(suffix_chunks.pack(a))
        assert back.dtype == a.dtype and back.tolist() == a.tolist()
    sums = np.array([0.0, -3.25, 1e6, -1e-3])
    np.testing.assert_allclose(suffix_chunks._float(suffix_chunks._fixed(sums)), sums, atol=1e-7)


def test_tables_on_disk_stay_below_three_times_the_input(spark, monkeypatch):
    """All tables that lie in the checkpoint folder after each one written."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", (fold() == 1).alias("held_out"), "text")
    folder, most = pathlib.Path(checkpoint_dir(spark).removeprefix("file:")), []

    def lying():
        return sum(f.stat().st_size for f in folder.rglob("*.parquet"))

    def watched(df, outer=False, before=lying()):
        made = materialize(df, outer)
        most.append(lying() - before)
        return made

    for module in (suffix_tree, suffix_chunks):
        monkeypatch.setattr(module, "materialize", watched)
    assert suffix_tree.learn_and_score(docs).count() == docs.count()
    assert 0 < max(most) < 3 * pathlib.Path(f"{LARGER}/documents.parquet").stat().st_size


def test_scoring_without_learning_rows(spark):
    found = scored_rows(spark, [(1, True, "a b"), (2, True, None)])
    assert {(r.doc_id, r.n_known, r.train_tokens) for r in found} == {(1, 0, 0), (2, 0, 0)}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    assert scored_rows(spark, []) == []


# Language


def test_codewords_lie_apart():
    for k in (2, 3, 4, 7, 12):
        code = language_id.codewords(k, 1)
        apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 4) and code.shape[0] == k


def test_decoding_mends_a_wrong_bit_and_flags_ties():
    code = language_id.codewords(4, 1)
    model = language_id.Model(list("abcd"), code, np.zeros((1, 1)), np.ones(7) / 7)
    margins = code * 3.0
    margins[np.arange(4), np.arange(4)] *= -1
    best, score, second = language_id.decode(margins, model)
    assert best.tolist() == [0, 1, 2, 3] and (score > 0.9).all()
    best, score, second = language_id.decode(np.zeros((1, 7)), model)
    assert abs(score[0] - second[0]) < 1e-9


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.learn(docs.filter(fold() != 0))
    assert model.languages == ["de", "en", "es", "fr"]
    found = language_id.predict(docs.filter(fold() == 0), model)
    assert found.filter("lang_pred = lang").count() >= 0.98 * found.count()
    odd = [(1, None, "x"), (2, "", None), (3, "123 !!", None), (4, "ß", "y"), (4, "the and of the", "y"), (None, "der die das und " * 9000, "y")]
    rows = spark.createDataFrame(odd, "doc_id long, text string, score string")
    made = language_id.predict(rows, model).collect()
    assert len(made) == len(odd) and {r.lang_pred for r in made if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(0 <= r.score <= 1 for r in made) and all(r.score == 0 for r in made if r.lang_pred == "und")
    assert [r.lang_pred for r in made if r.doc_id is None] == ["de"]
    assert language_id.predict(rows.limit(0), model).collect() == []


def test_no_or_one_language(spark):
    rows = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    none = language_id.learn(rows)
    assert [r.lang_pred for r in language_id.predict(rows, none).collect()] == ["und", "und"]
    one = language_id.learn(spark.createDataFrame([("some text here", "en")] * 5, "text string, lang string"))
    assert [r.lang_pred for r in language_id.predict(rows, one).collect()] == ["en", "und"]


# Compression


def test_quality_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    model = zstd_quality.learn(docs, labels.filter(fold() != 0))
    held = zstd_quality.predict(docs.join(labels.filter(fold() == 0), "doc_id"), model).select("score", "quality", "predicted").toPandas()
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean() > 0.95  # area under the curve
    assert (held.predicted == held.quality).mean() > 0.93 and ((held.score >= 0.3) == (held.predicted == 1)).all()
    odd = spark.createDataFrame([(1, None, "x"), (1, "", None), (None, "a " * 60_000, None)], "doc_id long, text string, score string")
    made = zstd_quality.predict(odd, model).collect()
    assert made[0].score == made[1].score and all(0 <= r.score <= 1 for r in made)
    assert zstd_quality.predict(odd.limit(0), model).collect() == []


def test_quality_without_both_labels(spark):
    rows = [(k, "good text", 1) for k in range(20)] + [(20, None, None), (21, "x", None), (0, "good text", 1)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = zstd_quality.learn(rows.select("doc_id", "text"), rows.select("doc_id", "quality"))
    made = zstd_quality.predict(spark.createDataFrame([(1, "any")], "doc_id long, text string"), model).first()
    assert made.predicted == 1 and made.score == pytest.approx(20.5 / 21)


def test_language_of_repeated_texts_and_many_languages(spark):
    """One text in all rows, two texts, and more languages than a fixed number would allow."""
    for texts in (["the same text"], ["the same text", "ein anderer Text"]):
        rows = [(texts[i % len(texts)], ["en", "de"][i % len(texts)]) for i in range(4000)]
        model = language_id.learn(spark.createDataFrame(rows, "text string, lang string"))
        found = language_id.predict(spark.createDataFrame(rows[:2], "text string, lang string"), model).collect()
        assert [r["lang_pred"] for r in found] == [r["lang"] for r in found]
    many = [(f"{'abcdefghij'[k % 10] * 3} {k}", f"l{k:03d}") for k in range(600)]
    model = language_id.learn(spark.createDataFrame(many, "text string, lang string"), language_id.Rule(rounds=2))
    assert len(model.languages) == 600


def test_learning_is_the_same_for_rows_in_any_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text", "lang")
    rule = language_id.Rule(most_rows=60, rounds=3)
    first, second = language_id.learn(docs, rule), language_id.learn(docs.orderBy("text").unionByName(docs.limit(50)), rule)
    assert first.languages == second.languages and np.allclose(first.weights, second.weights) and np.allclose(first.trust, second.trust)


def test_decoding_equals_plain_loops():
    rng = np.random.default_rng(9)
    model = language_id.Model(list("abcde"), language_id.codewords(5, 3), np.zeros((1, 1)), rng.dirichlet(np.ones(language_id.codewords(5, 3).shape[1])))
    margins = rng.normal(size=(200, model.codes.shape[1])) * 3
    best, score, second = language_id.decode(margins, model)
    for row, (b, s, t) in enumerate(zip(best, score, second)):
        bits = range(model.codes.shape[1])
        loss = [sum(model.trust[j] * np.log1p(np.exp(-code[j] * margins[row][j])) for j in bits) for code in model.codes]
        like = [np.exp(-v * len(bits)) for v in loss]
        share = sorted((v / sum(like) for v in like), reverse=True)
        assert b == int(np.argmin(loss)) and s == pytest.approx(share[0]) and t == pytest.approx(share[1])
