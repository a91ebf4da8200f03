import random
import re
import time

from pyspark.sql import functions as F

from opsledger.llm import pii
from opsledger.llm.tables import materialize

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == 1:
        return all(int(p) <= 255 for p in value.split("."))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), k, m.end()) for k, (_, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if holds(k, m.group())]
    return ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans_are_those_of_the_plain_patterns(spark):
    """Random strings of the letters that matter, both marks among them, and long hostile runs."""
    draw, alphabet = random.Random(4), "0123456789 .-+()@a1 4.\x01\x02é😀_%"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 80))) for _ in range(1500)]
    texts += [None, "", "1" * 30_000, "1 " * 30_000, "a." * 20_000 + "@" + "b." * 20_000 + "c", "+1" + "(" * 20_000, "1.2.3.4" * 5000]
    texts += ["4111 1111 1111 1111, 4111-1111-1111-1111", "a@b.com_x@c.de", "x 000001.2.3.255 y", "+1 (487) 555-7209"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = pii.candidates(docs).select("doc_id", pii.written("base").alias("s"), pii.counted("base", "card").alias("n")).collect()
    assert {r.doc_id: r.s for r in found} == {k: plain(t) for k, t in enumerate(texts)}
    assert all(r.n == r.s.count("card:") for r in found)


def corpus(n=120):
    draw, rows = random.Random(8), []
    for k in range(n):
        token = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        head = f'words here token = "{token}" and' if k % 2 else f"words here {token} and"
        rows.append((k, f"{head} mail me.{k}@site.example.org or 10.0.{k}.7 version 3.{k}.1 part {'7' * (4 + k % 5)}", "x"))
    return rows


def test_the_method_adds_spans_and_leaves_base_ones(spark):
    rows = [*corpus(), (500, None, None), (500, None, None), (None, "clean words only", "y"), (501, "é😀 a.b@c.de", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string")
    found = pii.candidates(docs)
    model = pii.learn(found)
    made = pii.select(found, model).select("doc_id", "text", pii.written("base").alias("base"), pii.written("spans").alias("spans")).collect()
    assert len(made) == len(rows)
    for r in made:
        assert r.base == plain(r.text) and set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))
        places = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s]
        assert places == sorted(places)
        if r.text and "token" in r.text and 4 in model.thresholds:
            start = r.text.index('"') + 1
            assert f"secret:{start}:{start + 40}" in r.spans
        if r.doc_id is None:
            assert r.spans == ""
    clean = {r.doc_id: r for r in pii.redact(pii.select(found, model)).collect()}
    assert clean[501].text == "é😀 [EMAIL]" and clean[500].text is None and clean[None].text == "clean words only"
    assert "[IP]" in clean[0].text and "@" not in clean[0].text


def test_scoring_expressions_equal_the_fitted_trees(spark):
    """Thresholds select the same candidates that the model's own transform would."""
    found = pii.candidates(spark.createDataFrame(corpus(), "doc_id long, text string, other string"))
    model = pii.learn(found)
    assert model.thresholds and all(0 < t <= 1 for t in model.thresholds.values())
    each = found.select(F.explode("proposed").alias("c")).select(model.margin(pii._features(F.col("c"))).alias("p"))
    low, high = each.agg(F.min("p"), F.max("p")).first()
    assert 0 <= low < high <= 1


def test_without_candidates_nothing_is_added(spark):
    docs = spark.createDataFrame([(1, "no data at all"), (2, "a@b.cd")], "doc_id long, text string")
    made = {r.doc_id: r for r in pii.find(docs).select("doc_id", pii.written("spans").alias("s")).collect()}
    assert made[1].s == "" and made[2].s == "email:0:6"
    assert pii.find(docs.limit(0)).collect() == []


def test_overlapping_spans_are_redacted_as_one(spark):
    rows = spark.createDataFrame([(1, "0123456789", [(2, 1, 5), (4, 2, 7), (9, 3, 10)])], "doc_id long, text string, spans array<struct<start:int,kind:int,end:int>>")
    assert pii.redact(rows.withColumn("base", F.col("spans"))).first().text == "01[IP]78[PHONE]"


def few_secrets(secrets, others):
    """Texts with some named secrets, one number said very often and many numbers said once."""
    draw, texts = random.Random(12), []
    text = lambda n, of: "".join(draw.choice(of) for _ in range(n))
    for k in range(others):
        texts.append(f"part 12345678 and {draw.randint(10**8, 10**9)} then v1.2.{k} or {text(24, 'abcdefgh1234')} as built")
    texts += [f'set token = "{text(40, "0123456789abcdef")}" here' for _ in range(secrets)]
    return list(enumerate(texts))


def test_a_kind_with_few_confirmed_candidates_is_still_found(spark):
    for secrets in (13, 6):
        rows = few_secrets(secrets, 60)
        found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"))
        made = pii.select(found, pii.learn(found)).select("doc_id", "text", pii.written("spans").alias("s")).collect()
        named = [r for r in made if "token" in r.text]
        start = named[0].text.index('"') + 1
        assert len(named) == secrets and all(f"secret:{start}:{start + 40}" in r.s for r in named)


def test_a_rare_kind_keeps_its_place_in_the_sample(spark):
    """Each kind has its share of distinct candidates, whatever others there are and however often one is said."""
    rows = few_secrets(30, 3000)
    rule = pii.Rule(most_rows=300)
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"))
    sample = pii._sample(found, rule).groupBy("kind").agg(F.count("*").alias("n"), F.sum("label").alias("right"), F.count_distinct("place").alias("d")).collect()
    assert all(r.n == r.d <= 60 for r in sample) and {r.kind for r in sample} >= {1, 3, 4}
    assert next(r.n for r in sample if r.kind == 3) == 60


def test_one_text_of_very_many_matches_takes_time_in_proportion(spark):
    """2 MB with 100,000 matches, searched, labelled, chosen from and redacted in under a minute."""
    unit = [f"me{k % 1000}@site{k % 7}.org x " for k in range(100_000)]
    text = "".join(unit)
    docs = spark.createDataFrame([(1, text), *((10 + r[0], r[1]) for r in corpus())], "doc_id long, text string")
    began = time.monotonic()
    found = materialize(pii.candidates(docs.repartition(4)))
    made = pii.select(found, pii.learn(found))
    rows = {r.doc_id: r for r in made.select("doc_id", pii.counted("base", "email").alias("n"), F.size("spans").alias("all"), pii.written("base").alias("s")).collect()}
    clean = pii.redact(made.filter("doc_id = 1")).first().text
    assert time.monotonic() - began < 60
    assert rows[1].n == 100_000 and rows[1].all >= 100_000 and rows[1].s == plain(text)
    assert clean == "[EMAIL] x " * 100_000


def test_spans_beside_base_ones_and_their_labels(spark):
    """Random spans: those free of every base span, and the candidates equal to one, are those of a plain search."""
    draw = random.Random(5)

    def spans(n):
        made = {(draw.randint(0, 300), draw.randint(0, 3), draw.randint(1, 12)) for _ in range(n)}
        return sorted((a, k, a + size) for a, k, size in made)

    rows = [(i, spans(draw.randint(0, 40)), spans(draw.randint(0, 40))) for i in range(300)]
    rows = [(i, base, sorted({*more, *base[::3]})) for i, base, more in rows]
    kind = "array<struct<start:int,kind:int,end:int>>"
    df = spark.createDataFrame(rows, f"id int, base {kind}, more {kind}")
    shaped = F.transform("more", lambda s: F.struct(s["kind"], s["start"], s["end"], F.lit("v"), F.lit(""), F.lit("")).cast(pii._FOUND))
    found = df.select("id", pii._free(F.col("more"), F.col("base")).alias("free"), pii._labelled(F.col("base"), shaped).alias("told")).collect()
    by = {i: (base, more) for i, base, more in rows}
    for r in found:
        base, more = by[r.id]
        assert sorted(map(tuple, r.free)) == [s for s in more if not any(a < s[2] and s[0] < b for a, _, b in base)]
        assert sorted((x.c.start, x.c.kind, x.c.end, x.label) for x in r.told) == [(*s, s in base) for s in more]


def test_redaction_across_the_pieces_of_a_long_text(spark):
    draw = random.Random(6)
    text = "".join(draw.choice("abé😀 \n") for _ in range(5000))
    spans = [(a, draw.randint(0, 4), a + draw.randint(1, 1500)) for a in sorted(draw.sample(range(3500), 8))]
    expected, at = "", 0
    for a, k, b in spans:
        if a >= at:
            expected += text[at:a] + f"[{pii.KINDS[k].upper()}]"
        at = max(at, b)
    rows = spark.createDataFrame([(1, text, spans)], "doc_id long, text string, spans array<struct<start:int,kind:int,end:int>>")
    assert pii.redact(rows.withColumn("base", F.col("spans"))).first().text == expected + text[at:]


def test_every_distinct_candidate_is_learned_from(spark):
    """No candidate is left out of the rows that trees and thresholds come from, however many there are of a kind."""
    rows = few_secrets(30, 30_000)
    found = materialize(pii.candidates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    each = found.select(F.explode("proposed").alias("c")).groupBy("c.kind").agg(F.count_distinct("c.value", "c.before", "c.after").alias("n"))
    alike = pii._alike(pii._sample(found, pii.Rule()))
    assert {r.kind: r.n for r in alike.groupBy("kind").agg(F.sum("n").alias("n")).collect()} == {r.kind: r.n for r in each.collect()}
    assert alike.count() < each.agg(F.sum("n")).first()[0] / 4
    named = [r for r in pii.select(found, pii.learn(found)).select("doc_id", pii.counted("spans", "secret").alias("n")).collect() if r.doc_id >= 30_000]
    assert len(named) == 30 and sum(r.n == 1 for r in named) >= 27
