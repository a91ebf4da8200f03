import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import FOLDER
from opsledger.llm import edit_counts, packing, piece_tokens
from opsledger.llm.byte_tokens import byte_tokens
from opsledger.llm.piece_tokens import piece_tokens as pieces
from opsledger.llm.spans import SpanIds

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = " \n\t'sdtrevlm…aé  12٣ß漢字😀.,!-_▁\x00‍́<|>endoftxABZ\xa0　"
ODD = ["", "'", "'s", " 's", "''s'", "a'll's 'rest \n\n 've\n'd", "x" * 300 + " " * 300 + "ab" * 400, "<|endoftext|> a <|endoftext|>", "<s> </s> <0x41> <unk>", "▁▁a", " ", "  a", "a ", "it's we're"]


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(3)
    made = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    return [*made, *ODD, *(r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect())]


def test_byte_ids_are_the_librarys(texts):
    ids, bounds = byte_tokens(BYTE).encode(texts)
    wanted = Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [w.ids for w in wanted]


def test_piece_ids_and_text_are_the_librarys(texts):
    model, library = pieces(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    ids, bounds = model.encode(texts)
    wanted = library.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == wanted
    assert model.decode(ids, bounds) == [library.decode(w) for w in wanted]


@given(st.text(alphabet="abcdeth▁", max_size=80))
@settings(max_examples=60, deadline=None)
def test_a_heap_merges_as_the_rounds_do(text):
    model = pieces(PIECE)
    symbols = model.char[[ord(c) for c in text]] if text else np.empty(0, np.int64)
    rounds, _ = model._rounds(symbols, np.zeros(len(symbols), dtype=np.int64))
    assert model._heap(symbols.tolist()) == rounds.tolist()


def test_the_span_table_is_cleared_and_refilled(monkeypatch):
    monkeypatch.setattr("opsledger.llm.spans.KEPT", 3)
    spans = SpanIds(lambda found: (np.array([ord(c) for s in found for c in s], dtype=np.int32), np.array([len(s) for s in found])))
    codes = np.frombuffer("abcabdeffa".encode("utf-32-le"), dtype=np.uint32)
    for _ in range(3):
        ids, length = spans(codes, np.array([0, 3, 6]), np.array([3, 6, 10]))
        assert bytes(ids.tolist()) == b"abcabdeffa" and length.tolist() == [3, 3, 4]


def test_encoding_a_table(spark):
    rows = [(1, "Hello there"), (1, "Hello there"), (2, None), (None, ""), (3, "x " * 3000)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id int, text string, ids string")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found = piece_tokens.encode_decode(docs).collect()
    key = lambda r: (r[0] or 0, len(r[1] or ""))
    expected = sorted(((i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=key) == expected
    assert sorted((r.doc_id or 0, len(r.ids)) for r in piece_tokens.encode(docs).collect()) == sorted((i or 0, len(w)) for i, w, _ in expected)
    assert piece_tokens.encode_decode(docs.limit(0)).collect() == []


# Packing


@given(st.integers(0, 5000))
@settings(max_examples=100, deadline=None)
def test_cuts_cover_every_id_once(n):
    made = packing.cuts(n)
    assert [s for s, _ in made] == np.cumsum([0, *(k for _, k in made)])[:-1].tolist() and sum(k for _, k in made) == n
    assert all(k == 1024 or k & (k - 1) == 0 or k < packing.GRAIN for _, k in made)


def test_bins_hold_whole_classes_and_leave_little_padding():
    bins, rows = packing.Bins(100), []
    for doc in range(400):
        n = 1 + doc * 37 % 3000
        for start, length in packing.cuts(n):
            rows += bins.add(doc, start, np.arange(start, start + length).astype("<u4"), n)
    rows += bins.finish()
    filled: dict[int, int] = {}
    for _, _, length, _, _, sequence, offset, total, _ in sorted(rows, key=lambda r: (r[5], r[6])):
        assert filled.get(sequence, 0) == offset and total <= 1024
        filled[sequence] = offset + length
    assert sum(r[2] for r in rows) == sum(1 + d * 37 % 3000 for d in range(400))
    assert sum(packing.padded(n) - n for n in filled.values()) < 0.002 * sum(filled.values())


def test_packing_a_table(spark):
    rows = [(1, "Hello there " * 900), (1, "again"), (2, None), (None, ""), (3, "y")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, start int").repartition(3)
    library = Tokenizer.from_file(BYTE)
    found = packing.pack(docs).collect()
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in found) == total
    by = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert by.get(r.sequence_id, 0) == r.offset
        by[r.sequence_id] = r.offset + r.length
        assert r.padding == packing.padded(r.sequence_tokens) - r.sequence_tokens
    assert packing.pack(docs.limit(0)).collect() == []


# Edits


def tree(text):
    encoder = byte_tokens(BYTE)
    _, length, start, offsets = encoder.pre_token_ids([text])
    return edit_counts.TokenTree(text, np.diff(np.append(start, offsets[-1])), length, encoder)


def test_edited_trees_equal_fresh_ones():
    draw, alphabet = random.Random(5), " \n\t'sdtrevlm… 12ab. "
    for _ in range(400):
        text = "".join(draw.choice(alphabet) for _ in range(draw.choice([0, 3, 20, 400, 1500])))
        edited = tree(text)
        for _ in range(5):
            edit = (draw.randint(-1, len(text) + 2), draw.choice([0, 0, 1, 2, 5, 50, 500]), "".join(draw.choice(alphabet) for _ in range(draw.choice([0, 1, 2, 9, 100]))))
            edited.edit(*edit)
            text = edit_counts.apply(text, [edit])
            fresh = tree(text)
            assert "".join(edited.text) == text and (edited.total, edited.length) == (fresh.total, len(text))
            assert [s for leaf in edited.sizes for s in leaf] == [s for leaf in fresh.sizes for s in leaf]


def test_only_the_touched_region_is_encoded_again():
    edited = tree("some words in a row " * 2000)
    edited.edit(20_000, 3, "new")
    assert edited.encoded < 200


def test_counting_a_table_of_edits(spark):
    library = Tokenizer.from_file(BYTE)
    texts = {1: "It's a test of edits. " * 50, 2: None, 3: "", 4: "tail"}
    log = [(1, 2, 5, 4, "NEW words"), (1, 1, 0, 2, None), (3, 1, 0, 0, "fresh text"), (9, 1, 0, 0, "no such row"), (None, 1, 0, 0, "x")]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    edits = spark.createDataFrame(log, "doc_id long, seq int, start int, length int, text string")
    found = {r.doc_id: r for r in edit_counts.count(edit_counts.with_edits(docs, edits)).collect()}
    assert set(found) == set(texts)
    for i, text in texts.items():
        own = [(s, n, t or "") for d, _, s, n, t in sorted(e for e in log if e[0] == i)]
        after = edit_counts.apply(text or "", own)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
        assert (found[i].n_tokens, found[i].n_edits, found[i].n_tokens_after, found[i].n_chars_after) == (count(text or ""), len(own), count(after), len(after))
    assert edit_counts.count(edit_counts.with_edits(docs.limit(0), edits)).collect() == []
