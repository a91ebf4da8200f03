"""SentencePiece BPE by vectorised merge rounds, and its decoding.

All new words of a step lie in one flat symbol array. A round looks up the rank of every adjacent pair, takes
each word's smallest (leftmost on ties), merges it in all words at once and compacts; words without a
mergeable pair leave. Merging one pair a word and round keeps the order the model defines, whatever its ranks.

Null texts count as empty and have no id. Repeated rows are encoded again; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from opsledger.llm.batches import mapper, text_column
from opsledger.llm.spans import SpanIds, code_points, gather

META = 0x2581
NONE = np.int64(1) << 40
# Words of more symbols are merged with a heap: a round each would take too many rounds.
HEAPED = 256


class PieceTokens:
    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
            raise ValueError("only BPE models with byte fallback, a leading space and no text normalisation are supported")
        kinds = model.SentencePiece
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if any(chr(META) in p.lstrip(chr(META)) for p in normal):
            raise ValueError("a piece goes on after white space: words cannot be encoded one by one")
        self.byte_id = np.zeros(256, dtype=np.int32)
        surface = []
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
                surface.append(bytes([int(p.piece[3:5], 16)]))
            else:
                surface.append(p.piece.replace(chr(META), " ").encode() if p.type == kinds.NORMAL else b"")
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.surface_length = np.array([len(s) for s in surface], dtype=np.int64)
        self.surface_offset = np.cumsum(self.surface_length) - self.surface_length
        # Symbols: the pieces by id, then single characters that are no piece themselves.
        symbols = dict(normal)
        for c in sorted({c for p in normal for c in p} - set(normal)):
            symbols[c] = len(model.pieces) + len(symbols)
        self.limit = max(symbols.values()) + 1
        self.char = np.full(0x110000, -1, dtype=np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        loose = self.char < 0
        self.char[loose] = self.limit + np.flatnonzero(loose)
        self.pieces = len(model.pieces)
        scores = sorted({model.pieces[i].score for i in normal.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.limit + b] = (rank[model.pieces[i].score], i)
        self.pair = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair.tolist()], dtype=np.int64)
        self.pair_made = np.array([pairs[k][1] for k in self.pair.tolist()], dtype=np.int64)
        self.pairs = pairs
        self.spans = SpanIds(self._encode)

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into the pair table, or -1."""
        key = left * self.limit + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((left < self.limit) & (right < self.limit) & (self.pair[at] == key), at, -1)

    def _rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done = []
        while len(symbols):
            found = np.full(len(symbols), -1, dtype=np.int64)
            found[:-1] = np.where(word[1:] == word[:-1], self._look(symbols[:-1], symbols[1:]), -1)
            rank = np.where(found >= 0, self.pair_rank[found], NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(starts, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, starts), size)
            over = least == NONE
            if over.any():
                done.append((symbols[over], word[over]))
            at = np.flatnonzero((rank == least) & ~over)
            at = at[np.append(True, word[at][1:] != word[at][:-1])] if len(at) else at
            symbols = symbols.copy()
            symbols[at] = self.pair_made[found[at]]
            keep = ~over
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        symbols = np.concatenate([d[0] for d in done]) if done else symbols
        word = np.concatenate([d[1] for d in done]) if done else word
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _heap(self, symbols: list[int]) -> list[int]:
        """One long word: the same order of merges from a heap over a linked list."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and symbols[i] < self.limit and symbols[j] < self.limit and (p := self.pairs.get(symbols[i] * self.limit + symbols[j])):
                heapq.heappush(heap, (p[0], i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = self.pairs[a * self.limit + b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, offsets = code_points(words)
        size = np.diff(offsets)
        symbols, word = self.char[codes], np.repeat(np.arange(len(words)), size)
        short = (size <= HEAPED)[word]
        parts = [self._rounds(symbols[short], word[short])]
        for k in np.flatnonzero(size > HEAPED):
            merged = self._heap(symbols[offsets[k] : offsets[k + 1]].tolist())
            parts.append((np.array(merged, dtype=np.int64), np.full(len(merged), k)))
        symbols, word = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        symbols, word = symbols[order], word[order]
        single = np.flatnonzero(symbols >= self.pieces)
        if not len(single):
            return symbols.astype(np.int32), np.bincount(word, minlength=len(words))
        spelled = {s: self.byte_id[list(self._letter(s).encode("utf-8", "surrogatepass"))] for s in set(symbols[single].tolist())}
        length = np.ones(len(symbols), dtype=np.int64)
        length[single] = [len(spelled[s]) for s in symbols[single].tolist()]
        ids = np.repeat(symbols, length)
        at = np.cumsum(length) - length
        for k in single:
            ids[at[k] : at[k] + length[k]] = spelled[int(symbols[k])]
        return ids.astype(np.int32), np.bincount(np.repeat(word, length), minlength=len(words))

    @functools.cached_property
    def _single(self) -> dict[int, str]:
        part = np.flatnonzero((self.char >= self.pieces) & (self.char < self.limit))
        return {int(self.char[c]): chr(c) for c in part}

    def _letter(self, symbol: int) -> str:
        return chr(symbol - self.limit) if symbol >= self.limit else self._single[symbol]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, where the ids of each text begin)."""
        codes, offsets = code_points([" " + t if t else t for t in texts])
        codes = np.where(codes == 32, np.uint32(META), codes)
        if not len(codes):
            return np.empty(0, np.int32), np.zeros(len(offsets), dtype=np.int64)
        white = codes == META
        start = np.zeros(len(codes) + 1, dtype=bool)
        start[1:-1] = white[1:] & ~white[:-1]
        start[offsets] = True
        first = np.flatnonzero(start[:-1])
        ids, length = self.spans(codes, first, np.append(first[1:], len(codes)))
        return ids, np.concatenate([[0], np.cumsum(length)])[np.searchsorted(first, offsets)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids; the leading space of the first piece is dropped."""
        length = self.surface_length[ids]
        data = gather(self.surface, self.surface_offset[ids], length).tobytes()
        at = np.concatenate([[0], np.cumsum(length)])[bounds].tolist()
        out = []
        for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
            first = bounds[k] < bounds[k + 1] and self.surface_length[ids[bounds[k]]] > 0 and self.surface[self.surface_offset[ids[bounds[k]]]] == 32
            out.append(data[a + bool(first) : b].decode("utf-8", "replace"))
        return out


@functools.cache
def piece_tokens(path: str) -> PieceTokens:
    """One per worker process and file."""
    return PieceTokens(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of each whole text."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = piece_tokens(path).encode(text_column(batch.column("text")).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(mapper(step), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text and the text they decode to, in one pass."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = piece_tokens(path)
        ids, bounds = model.encode(text_column(batch.column("text")).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(model.decode(ids, bounds), pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        mapper(step), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string"
    )
