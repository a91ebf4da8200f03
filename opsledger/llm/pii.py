"""Personal data: high-recall generators propose spans, boosted trees over format and context choose among them.

Everything on the path is column expressions. A pattern's matches are found by marking them in the text and
folding over the pieces, which gives their places in code points. Four base kinds (email, ip, card, phone) are exact
rules with checks. Five generators propose further, overlapping spans; candidates get features of their
format (digits, groups, separators, letters) and context (what stands before and after). Gradient-boosted
trees learn, from all distinct candidates of the corpus, which formats the checks confirm (Luhn sum,
address range, digit count) or an assignment names as a secret; neither checks nor names are features. Candidates
that are alike in features and label are one row that carries their number, and neither the confirmed nor the other candidates of
a kind weigh more than `most_weight`, so neither a frequent kind nor a repeated span crowds out others. Per
kind, the threshold is the lowest at which held-back candidates are confirmed with `precision`. A kind with too
few confirmed among them is judged by all its rows, each half scored by trees grown on the other; if that is too
few still, by the rows of all kinds together. The trees become one column expression, so scoring is part of the scan.

Base spans always stay; chosen spans that overlap one are dropped, and of chosen spans that overlap each other
the first stays. A null text counts as empty and has no span. Repeated rows are searched again; other columns pass
through `candidates` and `redact` unless they are called base, proposed or spans.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsledger.llm.tables import materialize

OPEN, SHUT = "\u0001", "\u0002"
KINDS = ("email", "ip", "card", "phone", "secret")
_FOUND = "struct<kind:int,start:int,end:int,value:string,before:string,after:string>"
_SPAN = "struct<start:int,kind:int,end:int>"
CONTEXT = 24
TASK_ROWS = 50_000  # rows that one task learns from
BINS = 256  # places tried for a split of a feature
GRID = 100_000  # steps of a score that thresholds tell apart
BLOCK = 256  # elements gathered at a time
CHUNK = 1024  # code points of a text cut out at a time

# The base patterns. Loops are possessive and starts are tied to the run they begin, which leaves the
# matches as they are and keeps the search linear and without recursion on any text.
_LOCAL = "A-Za-z0-9._%+-"
BASE = (
    (0, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    (1, r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    (2, r"[0-9](?:[ -]?[0-9])++"),
    (3, r"\+[0-9][ ().0-9-]+[0-9]"),
)
# Generators: anything around an @, dotted numbers, card-like groups, long digit strings, long mixed strings.
GENERATORS = (
    (0, r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++"),
    (1, r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+"),
    (2, r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}(?:[ -]?[0-9]{1,4})?(?![0-9])"),
    (3, r"(?<![0-9])\+?[0-9][0-9 ().-]{6,24}[0-9](?![0-9])"),
    (4, r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+"),
)
_ASSIGNED = r"(?i)(token|secret|passw(or)?d|api.?key|credential)s?['\"]?\s*[:=]\s*['\"]?$"


@dataclass(frozen=True)
class Rule:
    most_rows: int | None = None  # distinct candidates learned from, an equal share for each kind; None: all
    most_weight: int = 4_000  # of the candidates of a kind with one label together
    trees: int = 8
    depth: int = 3
    precision: float = 0.95
    fewest: int = 10  # confirmed candidates of a kind among those held back
    seed: int = 17


@dataclass(frozen=True)
class Model:
    margin: Callable[[list[Column]], Column] | None = None
    thresholds: dict[int, float] = field(default_factory=dict)


def _clean(text: Column) -> Column:
    """The text, null as empty, with the two marks replaced by another control character."""
    text = F.coalesce(text, F.lit(""))
    marked = F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(SHUT))
    return F.when(marked, F.translate(text, OPEN + SHUT, "\u0003\u0003")).otherwise(text)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _gather(items: Column, state: dict[str, Column], step: Callable[[Column, Column], tuple[dict[str, Column], Column]], kind: str) -> Column:
    """Fold over an array: `step` gives the next state and an array of what is put out, and all of that is returned.

    Appending copies what it appends to, so blocks gather their own and are joined at the end.
    """
    none = F.array().cast(f"array<{kind}>")

    def holding(values: dict[str, Column], out: Column) -> Column:
        return F.struct(*(c.alias(n) for n, c in values.items()), out.alias("out"))

    def one(acc: Column, item: Column) -> Column:
        now, out = step(acc, item)
        return holding(now, F.concat(acc["out"], out))

    def blocks(xs: Column) -> Column:
        def block(acc: Column, number: Column) -> Column:
            inner = F.aggregate(F.slice(xs, number * BLOCK + 1, F.lit(BLOCK)), holding({n: acc[n] for n in state}, none), one)
            return _once(inner, lambda i: holding({n: i[n] for n in state}, F.concat(acc["out"], F.array(i["out"]))))

        numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        start = holding(state, F.array().cast(f"array<array<{kind}>>"))
        return F.when(F.size(xs) > 0, F.aggregate(numbers, start, block, lambda acc: F.flatten(acc["out"]))).otherwise(none)

    return _once(items, blocks)


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """All matches of a pattern, leftmost and apart, with places in code points and what stands around."""

    def step(acc: Column, part: Column) -> tuple[dict[str, Column], Column]:
        value = F.substring_index(part, SHUT, 1)
        size = F.char_length(value)
        plain = F.translate(part, SHUT, "")
        one = F.struct(
            F.lit(kind).alias("kind"), acc["at"].alias("start"), (acc["at"] + size).alias("end"), value.alias("value"),
            acc["tail"].alias("before"), F.substring(part, size + 2, F.lit(8)).alias("after"),
        )
        tail = F.right(F.concat(acc["tail"], plain), F.lit(CONTEXT))
        return {"at": acc["at"] + F.char_length(plain), "tail": tail}, F.array(one)

    def placed(parts: Column) -> Column:
        start = {"at": F.char_length(parts[0]), "tail": F.right(parts[0], F.lit(CONTEXT))}
        return _gather(F.slice(parts, F.lit(2), F.size(parts) - 1), start, step, _FOUND)

    return _once(F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{SHUT}"), OPEN), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits, doubled at every second place from the right, sum to a multiple of ten."""
    backward = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(backward, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _holds(found: Column) -> Column:
    """The check of a base match by its kind."""
    value = found["value"]
    count = F.char_length(_digits(value))
    small = F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (
        F.when(found["kind"] == 1, small)
        .when(found["kind"] == 2, F.when(count.between(12, 19), _luhn(_digits(value))).otherwise(False))
        .when(found["kind"] == 3, count.between(9, 15))
        .otherwise(True)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """`docs` with `base` (exact spans, by start and kind) and `proposed` (generated spans)."""
    clean = docs.drop("base", "proposed", "spans").withColumn("_clean", _clean(F.col("text")))
    text = F.col("_clean")
    marked = clean.withColumn("base", F.concat(*(F.filter(_matches(text, k, p), _holds) for k, p in BASE)))
    marked = marked.withColumn("proposed", F.concat(*(_matches(text, k, p) for k, p in GENERATORS)))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return marked.withColumn("base", F.array_sort(plain)).drop("_clean")


def _features(c: Column) -> list[Column]:
    """Format and context of a candidate, as numbers. No checksum, no range and no naming word is among them."""
    value, before, after = c["value"], c["before"], c["after"]

    def count(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(value, pattern, ""))

    length = F.char_length(value)
    digits = count("[^0-9]")
    letters = count("[^A-Za-z]")
    made = [
        c["kind"], length, digits, letters,
        F.size(F.split(value, "[0-9]+")) - 1,  # groups of digits
        F.char_length(F.regexp_replace(value, "^.*?([0-9]+)[^0-9]*$", "$1")),  # the last group
        count(r"[^.]"), count("[^ -]"), count("[^()]"), count("[^a-fA-F0-9]") / length, count("[^aeiouAEIOU]") / length,
        value.startswith("+").cast("int"), before.rlike(r"[A-Za-z0-9]$").cast("int"), after.rlike("^[A-Za-z0-9]").cast("int"),
        before.rlike(r"[\"'=:(\[]\s*$").cast("int"), before.rlike(r"[0-9]\s*$").cast("int"), after.rlike(r"^\s*[0-9]").cast("int"),
        before.rlike(r"(?i)(tel|phone|call|fax|mail|card|ip|host|addr)\w*\W*$").cast("int"),
    ]
    return [f.cast("double") for f in made]


def _labelled(base: Column, proposed: Column) -> Column:
    """Candidates as (c, label). The weak label: the candidate is a checked base span, or an assignment names it."""
    keys = ("start", "kind", "end")
    nothing = F.lit(None).cast(_FOUND)
    exact = F.transform(base, lambda s: F.struct(*(s[k].alias(k) for k in keys), nothing.alias("c")))
    found = F.transform(proposed, lambda c: F.struct(*(c[k].alias(k) for k in keys), c.alias("c")))

    def compared(ordered: Column) -> Column:
        # A base span, which has no candidate, sorts right before the candidate equal to it.
        def one(x: Column, i: Column) -> Column:
            last = F.get(ordered, i - 1)
            same = F.coalesce(last["c"].isNull() & (last["start"] == x["start"]) & (last["kind"] == x["kind"]) & (last["end"] == x["end"]), F.lit(False))
            return F.struct(x["c"].alias("c"), F.when(x["kind"] == 4, x["c"]["before"].rlike(_ASSIGNED)).otherwise(same).alias("label"))

        return F.filter(F.transform(ordered, one), lambda x: x["c"].isNotNull())

    return _once(F.array_sort(F.concat(exact, found)), compared)


def _free(spans: Column, base: Column) -> Column:
    """Those of the spans that overlap no base span, found by two walks over all of them in order."""

    def tagged(xs: Column, exact: bool) -> Column:
        return F.transform(xs, lambda s: F.struct(s["start"].alias("start"), F.lit(not exact).alias("added"), s["kind"].alias("kind"), s["end"].alias("end")))

    def ahead(acc: Column, s: Column) -> tuple[dict[str, Column], Column]:
        """Past the base spans that start no later: keep what starts after all of them end."""
        return {"end": F.when(s["added"], acc["end"]).otherwise(F.greatest(acc["end"], s["end"]))}, F.when(~s["added"] | (s["start"] >= acc["end"]), F.array(s)).otherwise(none)

    def behind(acc: Column, s: Column) -> tuple[dict[str, Column], Column]:
        """Back from the end: keep what ends before the next base span starts."""
        plain = F.struct(*(s[k].alias(k) for k in ("start", "kind", "end")))
        return {"start": F.when(s["added"], acc["start"]).otherwise(s["start"])}, F.when(s["added"] & (s["end"] <= acc["start"]), F.array(plain)).otherwise(F.array().cast(f"array<{_SPAN}>"))

    kind = "struct<start:int,added:boolean,kind:int,end:int>"
    none = F.array().cast(f"array<{kind}>")
    ordered = F.array_sort(F.concat(tagged(base, True), tagged(spans, False)))
    first = _gather(ordered, {"end": F.lit(0)}, ahead, kind)
    return _gather(F.reverse(first), {"start": F.lit(2**31 - 1)}, behind, _SPAN)


def _expression(node) -> Callable[[list[Column]], Column]:
    """A tree of the fitted model as a function from features to a column."""
    if node.subtreeDepth() == 0:
        value = float(node.prediction())
        return lambda x: F.lit(value)
    split = node.split()
    index, limit = int(split.featureIndex()), float(split.threshold())
    left, right = _expression(node.leftChild()), _expression(node.rightChild())
    return lambda x: F.when(x[index] <= limit, left(x)).otherwise(right(x))


def _told(found: DataFrame, rule: Rule) -> DataFrame:
    """(kind, place, label, c) of every candidate; `place` is a hash of what tells distinct candidates apart."""
    told = found.select(F.explode(_labelled(F.col("base"), F.col("proposed"))).alias("x")).select("x.c", "x.label")
    place = F.xxhash64(*(F.col("c")[x] for x in ("kind", "value", "before", "after")), F.lit(rule.seed))
    return told.select(F.col("c")["kind"].alias("kind"), place.alias("place"), "label", "c")


def _sample(found: DataFrame, rule: Rule) -> DataFrame:
    """(kind, place, label, features) of distinct candidates, at most an equal share of `most_rows` of each kind, by lowest hash."""
    each = _told(found, rule)
    if rule.most_rows is None:
        measured = each.select("kind", "place", "label", *(f.alias(f"f{i}") for i, f in enumerate(_features(F.col("c")))))
        # Equal candidates have equal features.
        same = [F.max(c).alias(c) for c in measured.columns if c[0] == "f"]
        return measured.groupBy("kind", "place").agg(F.max(F.col("label").cast("double")).alias("label"), *same)
    most = rule.most_rows // len(KINDS)
    sizes = each.groupBy("kind").agg(F.approx_count_distinct("place", 0.05).alias("n")).collect()
    # About twice as many as wanted pass by their hash; the lowest of them are taken.
    passes = F.lit(False)
    for r in sizes:
        limit = 2**63 - 1 if r["n"] <= 2 * most else int(-(2.0**63) + 2.0**64 * 2 * most / r["n"])
        passes = passes | ((F.col("kind") == r["kind"]) & (F.col("place") <= limit))
    drawn = each.filter(passes).select(
        "kind", "place", "label",
        F.struct(F.col("c")["kind"].alias("kind"), *(F.col("c")[x].alias(x) for x in ("value", "before", "after"))).alias("c"),
    )
    distinct = drawn.groupBy("kind", "place").agg(F.max("label").cast("double").alias("label"), F.min("c").alias("c"))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("place"))
    lowest = distinct.withColumn("rank", rank).filter(F.col("rank") <= most)
    return materialize(lowest.select("kind", "place", "label", *(f.alias(f"f{i}") for i, f in enumerate(_features(F.col("c"))))))


def _alike(sample: DataFrame) -> DataFrame:
    """(half, label, kind, features, n): how many distinct candidates of a half are alike in features and label."""
    half = F.pmod(F.xxhash64("place"), F.lit(2)).cast("int")
    alike = ["half", "label", "kind", *(c for c in sample.columns if c[0] == "f")]
    return materialize(sample.withColumn("half", half).groupBy(alike).agg(F.count("*").alias("n")))


def _threshold(rows: list[tuple[float, float, float]], precision: float) -> float | None:
    """The lowest score at which (score, number, confirmed) rows are confirmed with `precision`."""
    rows, total, right, best = sorted(rows, reverse=True), 0.0, 0.0, None
    for at, (p, n, confirmed) in enumerate(rows, 1):
        total, right = total + n, right + confirmed
        last = at == len(rows) or rows[at][0] < p
        if last and right and right >= precision * total - 1e-9:
            best = p
    return best


def learn(found: DataFrame, rule: Rule = Rule()) -> Model:
    """A model from the rows of `candidates`, learned from all of them unless the rule has a bound."""
    alike = _alike(_sample(found, rule))
    sizes = {(r["half"], r["label"], r["kind"]): (r["rows"], r["n"]) for r in alike.groupBy("half", "label", "kind").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    both = [h for h in (0, 1) if {0.0, 1.0} <= {label for half, label, _ in sizes if half == h}]
    if not both:
        return Model()
    of_kind, of_label = Counter(), Counter()
    for (_, label, kind), (_, n) in sizes.items():
        of_kind[kind] += n
        of_label[kind, label] += n
    share = {k: min(1.0, rule.most_weight / n) for k, n in of_kind.items()}
    features = [c for c in alike.columns if c[0] == "f"]
    one = [F.when((F.col("kind") == k) & (F.col("label") == label), F.lit(min(1.0, rule.most_weight / n))) for (k, label), n in sorted(of_label.items())]
    weight = F.col("n") * F.coalesce(*one)
    # One order of the rows, so that sums come out the same each time as long as one task holds them.
    tasks = -(-sum(rows for rows, _ in sizes.values()) // TASK_ROWS)
    ordered = alike.withColumn("weight", weight).repartitionByRange(tasks, *features, "label").sortWithinPartitions(*features, "label")
    ready = VectorAssembler(inputCols=features, outputCol="features").transform(ordered).select("half", "kind", "label", "n", "weight", "features")
    booster = GBTClassifier(maxIter=rule.trees, maxDepth=rule.depth, seed=rule.seed, stepSize=0.3, cacheNodeIds=False, maxBins=BINS, weightCol="weight")

    def scores(model, of: int) -> dict[int, list[tuple[float, float, float]]]:
        """(score, number, confirmed) by kind, with a row per step of the score."""
        made: dict[int, list[tuple[float, float, float]]] = {k: [] for k in range(len(KINDS))}
        step = F.floor(vector_to_array("probability")[1] * GRID).alias("step")
        told = model.transform(ready.filter(F.col("half") == of)).select("kind", step, "n", (F.col("n") * F.col("label")).alias("confirmed"))
        for r in told.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("confirmed").alias("confirmed")).collect():
            made[r["kind"]].append((r["step"] / GRID, float(r["n"]), r["confirmed"]))
        return made

    fitted = booster.fit(ready.filter(F.col("half") == both[0]))
    trees = [(w, _expression(t._call_java("rootNode"))) for w, t in zip(fitted.treeWeights, fitted.trees)]

    def margin(x: list[Column]) -> Column:
        total = F.lit(0.0)
        for w, tree in trees:
            total = total + w * tree(x)
        return 1 / (1 + F.exp(-2 * total))

    def few(rows: list[tuple[float, float, float]]) -> bool:
        return sum(confirmed for _, _, confirmed in rows) < rule.fewest

    held = scores(fitted, 1 - both[0])
    crossed = held
    if len(both) == 2 and any(few(rows) for rows in held.values()):
        other = scores(booster.fit(ready.filter(F.col("half") == both[1])), both[0])
        crossed = {k: held[k] + other[k] for k in held}
    pooled = _threshold([(p, n * share[k], c * share[k]) for k, rows in crossed.items() if k in share for p, n, c in rows], rule.precision)
    thresholds = {}
    for kind, rows in held.items():
        rows = crossed[kind] if few(rows) else rows
        best = pooled if few(rows) else _threshold(rows, rule.precision)
        if best is not None:
            thresholds[kind] = best
    return Model(margin, thresholds)


def select(found: DataFrame, model: Model) -> DataFrame:
    """Rows of `candidates` with `spans`: the base spans and those that the model adds, by start then kind."""
    if model.margin is None or not model.thresholds:
        return found.withColumn("spans", F.col("base")).drop("proposed")

    def chosen(c: Column) -> Column:
        limit = F.lit(2.0)
        for kind, threshold in model.thresholds.items():
            limit = F.when(c["s"]["kind"] == kind, F.lit(threshold)).otherwise(limit)
        x = [c["x"][i] for i in range(width)]
        return model.margin(x) >= limit - 1e-9

    width = len(_features(F.struct(F.lit(0).alias("kind"), *(F.lit("").alias(n) for n in ("value", "before", "after")))))
    measured = F.transform("proposed", lambda c: F.struct(
        F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")).alias("s"), F.array(*_features(c)).alias("x")
    ))
    free = _free(F.transform(F.filter(measured, chosen), lambda c: c["s"]), F.col("base"))
    # Of chosen spans that overlap each other the first stays, the longer one on equal starts.
    order = F.array_sort(free, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))

    def first(acc: Column, s: Column) -> tuple[dict[str, Column], Column]:
        apart = s["start"] >= acc["end"]
        return {"end": F.when(apart, s["end"]).otherwise(acc["end"])}, F.when(apart, F.array(s)).otherwise(F.array().cast(f"array<{_SPAN}>"))

    apart = _gather(order, {"end": F.lit(0)}, first, _SPAN)
    return found.withColumn("spans", F.when(F.size("proposed") > 0, F.array_sort(F.concat("base", apart))).otherwise(F.col("base"))).drop("proposed")


def written(spans: str) -> Column:
    """Spans as `kind:start:end`, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: str, kind: str) -> Column:
    """How many of the spans are of a kind."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def redact(found: DataFrame) -> DataFrame:
    """Rows of `select` with each span of the text, overlapping ones joined, replaced by its first kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    text = F.col("text")
    ending = F.transform(F.array(F.char_length(text)), lambda n: F.struct(n.alias("start"), F.lit(None).cast("int").alias("kind"), n.alias("end")))

    def cut(chunks: Column, start: Column, end: Column) -> Column:
        """The text between two places, from the chunks that hold it."""
        first = F.floor(start / CHUNK).cast("int")
        held = F.array_join(F.slice(chunks, first + 1, F.floor((end - 1) / CHUNK).cast("int") - first + 1), "")
        return F.when(end > start, F.substring(held, start % CHUNK + 1, end - start)).otherwise("")

    def pieces(chunks: Column) -> Column:
        def step(acc: Column, s: Column) -> tuple[dict[str, Column], Column]:
            piece = F.concat(cut(chunks, acc["at"], s["start"]), F.coalesce(F.get(names, s["kind"]), F.lit("")))
            return {"at": F.greatest(acc["at"], s["end"])}, F.when(s["start"] >= acc["at"], F.array(piece)).otherwise(F.array().cast("array<string>"))

        return F.array_join(_gather(F.concat(F.col("spans"), ending), {"at": F.lit(0)}, step, "string"), "")

    whole = _once(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0)), pieces)
    return found.withColumn("text", F.when(F.size("spans") > 0, whole).otherwise(text)).drop("base", "spans")


def find(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, base, spans) per document; the texts are searched once."""
    found = materialize(candidates(docs.select("doc_id", "text")).drop("text"))
    return select(found, learn(found, rule))
