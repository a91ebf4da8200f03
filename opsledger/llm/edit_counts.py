"""Token counts that follow edits: a tree over each document's pre-tokens, re-encoded only where edits reach.

A document's pre-tokens lie in leaves of about LEAF; an implicit binary tree keeps the characters and tokens
below every node. An edit finds its place by the character sums, re-splits the text from the start of a
pre-token shortly before it, and stops at the first old pre-token start that the new split reaches again behind the
edit: from there on the split cannot differ. Only the new pre-tokens in between are encoded; the leaf's sums are
carried up its path.

An edit is (start, length, text) in code points of the document as the edits before it left it; what lies
outside the text is ignored. Null texts count as empty, null edits as none, null parts as 0 or empty.
Repeated rows are counted again; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.llm.batches import mapper, text_column
from opsledger.llm.byte_tokens import PATTERN, ByteTokens, byte_tokens

LEAF = 64
# Characters read behind an edit before the first attempt to meet the old split again.
AHEAD = 64
# Characters between the start of the new split and the edit.
CONTEXT = 4
_SPLIT = regex.compile(PATTERN)
EDITS = "array<struct<start:bigint,length:bigint,text:string>>"


class TokenTree:
    """The pre-tokens of one document with subtree sums of characters and tokens."""

    def __init__(self, text: str, sizes: np.ndarray, tokens: np.ndarray, encoder: ByteTokens):
        self.encoder = encoder
        cut = range(0, max(len(sizes), 1), LEAF)
        self.sizes = [sizes[k : k + LEAF].tolist() for k in cut]
        self.tokens = [tokens[k : k + LEAF].tolist() for k in cut]
        self.width = 1 << (len(self.sizes) - 1).bit_length()
        chars = [sum(s) for s in self.sizes]
        at = np.concatenate([[0], np.cumsum(chars)]).tolist()
        self.text = [text[a:b] for a, b in zip(at[:-1], at[1:])]
        fill = [0] * (self.width - len(chars))
        self.chars = [0] * self.width + chars + fill
        self.sums = [0] * self.width + [sum(t) for t in self.tokens] + fill
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]
        self.encoded = 0

    @property
    def total(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def _leaf(self, position: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds a position; the last leaf for the end."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.chars[node] <= position and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def _update(self, leaf: int, text: str, sizes: list[int], tokens: list[int]) -> None:
        self.text[leaf], self.sizes[leaf], self.tokens[leaf] = text, sizes, tokens
        node = self.width + leaf
        more, extra = len(text) - self.chars[node], sum(tokens) - self.sums[node]
        while node:
            self.chars[node] += more
            self.sums[node] += extra
            node //= 2

    def _count(self, pieces: list[str]) -> list[int]:
        self.encoded += len(pieces)
        one = self.encoder.merger.encode_ordinary
        return [len(one(p)) for p in pieces]

    def edit(self, start: int, length: int, text: str) -> None:
        start = min(max(start, 0), self.length)
        end = min(start + max(length, 0), self.length)
        if start == end and not text:
            return
        leaf, before = self._leaf(start)
        first = leaf
        # Back to a pre-token that shows something and lies far enough before the edit that no split to its
        # left looks at a changed character: a run of white space reads one character past its end, a
        # contraction two past its quote.
        inside = self._bounds(leaf)
        k = bisect.bisect_right(inside, start - before) - 1
        while True:
            k -= 1
            while k < 0 and first > 0:
                first -= 1
                before -= len(self.text[first])
                inside = self._bounds(first)
                k = len(self.sizes[first]) - 1
            if k < 0:
                break
            at = before + inside[k]
            if start - at >= CONTEXT and not self.text[first][inside[k] : inside[k + 1]].isspace():
                break
        k = max(k, 0)
        held = before + (inside[k] if k < len(inside) else 0)  # the new split starts here
        last, reach, old, parts = first, before, [], []
        goal = end + AHEAD
        while True:
            while last < len(self.text) and (reach < goal or not parts):
                old += [reach + b for b in self._bounds(last)[:-1]]
                parts.append(self.text[last])
                reach += len(self.text[last])
                last += 1
            whole = "".join(parts)
            window = whole[held - before : start - before] + text + whole[end - before :]
            final = last == len(self.text)
            moved = len(text) - (end - start)
            known = set(old)
            pieces, at, met = [], held, None
            limit = reach + moved
            for m in _SPLIT.finditer(window):
                a = held + m.start()
                if a - moved >= end and a >= start + len(text) and (a - moved) in known:
                    met = a - moved
                    break
                pieces.append(m.group())
                at = held + m.end()
            if met is None and final:
                met = reach
            if met is not None or final:
                break
            assert at == limit
            goal = reach + (reach - before) + AHEAD
        sizes, tokens = self.sizes[first][:k], self.tokens[first][:k]
        sizes += [len(p) for p in pieces]
        tokens += self._count(pieces)
        kept, position = [], before
        for j in range(first, last):
            for s, t in zip(self.sizes[j], self.tokens[j]):
                if position >= met:
                    kept.append((s, t))
                position += s
        sizes += [s for s, _ in kept]
        tokens += [t for _, t in kept]
        self._update(first, whole[: held - before] + window, sizes, tokens)
        for j in range(first + 1, last):
            self._update(j, "", [], [])

    def _bounds(self, leaf: int) -> list[int]:
        out = [0]
        for s in self.sizes[leaf]:
            out.append(out[-1] + s)
        return out


def count(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_chars_after, n_pre_tokens, n_encoded) per row of (doc_id, text, edits).

    `n_encoded` is the number of pre-tokens encoded again for the edits.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    names = ["n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_pre_tokens", "n_encoded"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = byte_tokens(path)
        texts = text_column(batch.column("text")).to_pylist()
        _, length, start, offsets = encoder.pre_token_ids(texts)
        size = np.diff(np.append(start, offsets[-1]))
        bounds = np.searchsorted(start, offsets)
        rows = []
        for text, edits, a, b in zip(texts, batch.column("edits").to_pylist(), bounds[:-1], bounds[1:]):
            tree = TokenTree(text, size[a:b], length[a:b], encoder)
            before, edits = tree.total, [e for e in edits or [] if e]
            for e in edits:
                tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
            rows.append((before, len(edits), tree.total, tree.length, b - a, tree.encoded))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(np.array(c, dtype=np.int64)) for c in zip(*rows))], names=["doc_id", *names]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
    return docs.select("doc_id", "text", F.col("edits").cast(EDITS).alias("edits")).mapInArrow(mapper(step), schema)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """`docs` with the rows of `edits` (doc_id, seq, start, length, text) gathered, in order, per document.

    The edits of one document are applied one after another, so they are held together in its row.
    """
    log = edits.filter("doc_id is not null").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("seq", "start", "length", "text"))).alias("log")
    )
    parts = F.transform("log", lambda e: F.struct(e["start"].cast("long").alias("start"), e["length"].cast("long").alias("length"), e["text"].alias("text")))
    return docs.drop("edits").join(log, "doc_id", "left").withColumn("edits", parts).drop("log")


def apply(text: str, edits: Iterable[tuple[int, int, str]]) -> str:
    """The plain meaning of a list of edits."""
    for start, length, new in edits:
        start = min(max(start, 0), len(text))
        text = text[:start] + new + text[min(start + max(length, 0), len(text)) :]
    return text
