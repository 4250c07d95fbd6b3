"""Operators 1, 2 and 7: ids, pieces and counts against the libraries."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import sentencepieces, token_counts, token_files
from strata.llm.common import shared_folder

from . import cases

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(WORD_BPE)


def library_ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def test_files_hold_every_document_in_order(spark, tok):
    docs = cases.documents(spark)
    manifest = token_files.write_token_files(docs, shared_folder(spark, "t"), WORD_BPE, frame_tokens=500)
    got = token_files.read_token_files(manifest).orderBy("start").collect()
    want = sorted(((r[0] is not None, r[0] or 0, library_ids(tok, r[1]) + [1]) for r in cases.rows()), key=lambda x: x[:2])
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got] == [w[:2] for w in want]
    assert sorted((r["doc_id"] or -1, tuple(np.frombuffer(r["ids"], "<u4"))) for r in got) == \
        sorted((w[1] if w[0] else -1, tuple(w[2])) for w in want)
    at = 0
    for r in got:
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(r["ids"]) and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]


def test_reader_touches_only_the_frames_asked_for(tmp_path):
    path = str(tmp_path / "x.zst")
    w = token_files.TokenFileWriter(path, frame_tokens=10)
    docs = {d: np.arange(d % 7, dtype="<u4").tobytes() for d in range(0, 300, 3)}
    for d, ids in docs.items():
        w.add(d, ids)
    w.close()
    r = token_files.TokenFileReader(path)
    assert len(r.frames) > 10
    read = []
    frame = r.frame
    r.frame = lambda k: read.append(k) or frame(k)
    assert {d: ids for d, _, ids in r.documents([30, 33, 1])} == {30: docs[30], 33: docs[33]}
    assert len(read) <= 2
    assert os.listdir(tmp_path) == ["x.zst"]


def test_a_damaged_frame_is_refused(tmp_path):
    path = tmp_path / "x.zst"
    w = token_files.TokenFileWriter(str(path))
    w.add(None, np.arange(5000, dtype="<u4").tobytes())
    w.close()
    raw = bytearray(path.read_bytes())
    raw[40] ^= 1
    path.write_bytes(raw)
    with pytest.raises(Exception):
        list(token_files.TokenFileReader(str(path)).documents())


def test_empty_tables(spark):
    none = cases.empty(spark)
    manifest = token_files.write_token_files(none, shared_folder(spark, "t"), WORD_BPE)
    assert token_files.read_token_files(manifest).count() == 0
    assert sentencepieces.encode(none, PIECES).count() == 0
    assert token_counts.token_counts(none, WORD_BPE).count() == 0


def test_pieces_are_the_library_s_and_decode(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sentencepieces.encode_and_decode(cases.documents(spark), PIECES).collect()
    assert len(got) == len(cases.rows())
    want = sorted((r[0] or -1, tuple(sp.encode(r[1] or "")), sp.decode(sp.encode(r[1] or ""))) for r in cases.rows())
    assert sorted((r["doc_id"] or -1, tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["decoded"]) for r in got) == want
    back = sentencepieces.decode(sentencepieces.encode(cases.documents(spark), PIECES), PIECES)
    assert sorted(r["text"] for r in back.collect()) == sorted(w[2] for w in want)


def test_pieces_of_odd_texts():
    rng = np.random.default_rng(4)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    alphabet = list("ab  the ing ▁é日😀\n\x00=--//..  \t")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(2000)] + [" " * 300 + "x", "the" * 400, "▁"]
    enc = sentencepieces.Encoder(PIECES, limit=500)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == sp.encode(texts)
    assert enc.trie.reused > 0


@pytest.mark.parametrize("chunk", [5, 16384])
def test_counts_are_the_library_s(tok, chunk):
    rng = np.random.default_rng(6)
    alphabet = list("ab 's 'll ' 12½ é日\n\x1c\x85　Σİ.,!_\"") + ["<|endoftext|>", "<|", "I'M ", "don't", "thing"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(1500)] + ["x" * 20000, "'" * 3000, "a.'s" * 3000, ""]
    counter = token_counts.Counter(WORD_BPE, chunk)
    assert [counter.count(t) for t in texts] == [len(library_ids(tok, t)) for t in texts]


def test_counts_of_a_table(spark, tok):
    got = token_counts.token_counts(cases.documents(spark), WORD_BPE).collect()
    want = sorted((r[0] or -1, len((r[1] or "").encode()), len(library_ids(tok, r[1]))) for r in cases.rows())
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == want


def test_state_maps_compose_to_the_whole():
    counter = token_counts.Counter(WORD_BPE)
    text = "we'll go there, it's 12 o'clock! andthenonandon"
    whole = counter.count(text)
    for at in range(1, len(text)):
        m = counter.scan([counter.state_map(text[:at]), counter.state_map(text[at:])])
        q, tokens = counter.fst.run(0, m.head)
        assert tokens + m.tokens + counter.fst.close[q if m.exit is None else m.exit] == whole


def test_counts_of_characters_newer_than_python_s_tables(tok):
    counter = token_counts.Counter(WORD_BPE)
    odd = [0x13808, 0x1385B, 0x1385C, 0x13988, 0x10D4A, 0x1E5D0, 0x16D60, 0x1C89, 0xA7CB, 0x2028, 0x3000, 0x85, 0x200B, 0x660, 0x2160, 0x1F600]
    for c in map(chr, odd):
        for text in (f"a{c}", c + c, f"1{c}2 {c}'s {c}.{c}"):
            assert counter.count(text) == len(library_ids(tok, text)), hex(ord(c))


def test_fields_of_the_older_generation_come_back(tok):
    counter = token_counts.Counter(WORD_BPE, limit=5)
    text = " ".join(f"word{i % 13} other{i}" for i in range(60)) + " ."
    assert counter.count(text) == len(library_ids(tok, text)) == counter.count(text)
    assert len(counter) <= 5 and len(counter.older) <= 5
