"""Operator 2: SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are split into marked words (a run of word marks and what follows up to
the next mark); no piece of the vocabulary has a mark behind another character,
so words are encoded on their own.  The distinct new words of a block are
sorted, which walks their trie depth-first: the forward states of the prefix
that a word shares with the one before are kept, and only the rest of the word
is scored.

The model file is of the merge-order (BPE) kind.  There a sum of piece scores
does not give the library's result; the forward state of a prefix is instead
the one last piece that merge order allows (module ``merges``), which gives the
library's ids.  Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from .common import read_table, text_of, worker_cached
from .merges import MergeTable, merge_all

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
MEMO_WORDS = 200_000
MEMO_CHARS = 64
BLOCK_CHARS = 1_000_000
NORMAL, BYTE = 1, 6  # piece kinds of the model file


class PieceModel:
    """Vocabulary and merge order read from a model file."""

    def __init__(self, path: str):
        proto = model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces \
                or not spec.add_dummy_prefix or not proto.trainer_spec.byte_fallback:
            raise ValueError("needs a merge-order model with byte pieces, a prefix mark and no normalizing")
        self.pieces = [p.piece for p in proto.pieces]
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes_ = [self.pieces.index(f"<0x{b:02X}>") for b in range(256)]
        self.special = [p.type not in (NORMAL, BYTE) for p in proto.pieces]
        score = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in score):
            raise ValueError("a piece holds a mark behind another character: words are not independent")
        self.score = score
        self.longest = max(map(len, score))
        #: merges of runs of marks share one score; runs are merged apart from the rest
        self.run_score = max(score.values())
        merges = {}
        for p in score:
            if len(p) > 1 and p.strip(MARK):
                parts = merge_all(list(p), lambda a, b: self._below(a, b, score[p]))
                if len(parts) == 2:
                    merges[tuple(parts)] = score[p]
        self.table = MergeTable(merges)
        self.usable = {p for p in score if len(p) == 1} | {a + b for a, b in merges}
        # every pair that joins to a usable piece merges, not only the piece's own last merge
        full = {}
        for p in self.usable:
            for k in range(1, len(p)):
                if p[:k] in score and p[k:] in score:
                    full[p[:k], p[k:]] = score[p]
        self.table.rank = full
        self.runs: dict[int, list[str]] = {}
        if any(p.strip(MARK) and p.startswith(MARK * 2) for p in score):
            raise ValueError("a piece begins with two marks and more")

    def _below(self, a: str, b: str, limit: float):
        r = self.score.get(a + b)
        return r if r is not None and r < limit else None

    def _any(self, a: str, b: str):
        return self.score.get(a + b)

    def run(self, n: int) -> list[str]:
        """Pieces of ``n`` marks."""
        if n not in self.runs:
            if len(self.runs) > 4096:
                self.runs.clear()
            self.runs[n] = merge_all([MARK] * n, self._any)
        return self.runs[n]

    def ids_of(self, pieces: list[str]) -> array:
        out = array("I")
        for p in pieces:
            i = self.id.get(p)
            if i is None:  # a single character without a piece
                out.extend(self.bytes_[b] for b in p.encode("utf-8"))
            else:
                out.append(i)
        return out


class TrieEncoder:
    """Encodes sorted words, keeping the forward states of shared prefixes."""

    def __init__(self, model: PieceModel):
        self.m = model
        self.reused = self.scored = 0

    def encode(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """``(word, ids)`` of the distinct words, in sorted order."""
        m, usable, apart = self.m, self.m.usable, self.m.table.apart
        longest, before, last = m.longest, "", [""]
        for word in sorted(words):
            body = word.lstrip(MARK)
            marks = len(word) - len(body)
            text = MARK + body if marks and body else body or ""
            keep, most = 0, min(len(text), len(before))
            while keep < most and text[keep] == before[keep]:
                keep += 1
            del last[keep + 1:]
            self.reused += keep
            self.scored += len(text) - keep
            for end in range(keep + 1, len(text) + 1):
                for size in range(1, min(longest, end) + 1):
                    piece = text[end - size:end]
                    if (size == 1 or piece in usable) and (end == size or apart(last[end - size], piece)):
                        break
                last.append(piece)
            before = text
            pieces, end = [], len(text)
            while end:
                pieces.append(last[end])
                end -= len(last[end])
            pieces.reverse()
            if marks > 1 or not body:
                if not body:
                    pieces = m.run(marks)
                elif pieces[0] == MARK:
                    pieces = m.run(marks) + pieces[1:]
                else:
                    pieces = m.run(marks - 1) + pieces
            yield word, m.ids_of(pieces).tobytes()


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit), remembering words."""

    def __init__(self, path: str, limit: int = MEMO_WORDS):
        self.model = PieceModel(path)
        self.trie = TrieEncoder(self.model)
        self.memo: dict[str, bytes] = {}
        self.limit = limit

    @staticmethod
    def marked(text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def encode_block(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        split = [WORDS.findall(self.marked(t)) for t in texts]
        new = set().union(*split).difference(memo)
        if len(memo) + len(new) > self.limit:
            memo.clear()
            new = set().union(*split)
        memo.update(self.trie.encode(list(new)))
        out = [b"".join(map(memo.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; words are held for ``BLOCK_CHARS`` at a time."""
        for a, b in blocks(texts):
            yield from self.encode_block(texts[a:b])


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK_CHARS`` together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_CHARS):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


class Decoder:
    """Ids to text, as the library decodes them."""

    def __init__(self, m: PieceModel):
        self.raw = [b"" if s else p.replace(MARK, " ").encode() for p, s in zip(m.pieces, m.special)]
        for b, i in enumerate(m.bytes_):
            self.raw[i] = bytes([b])

    def decode(self, ids: bytes) -> str:
        out = b"".join(map(self.raw.__getitem__, array("I", ids)))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of every text, as little-endian unsigned
    32-bit integers in a binary column.

    Null and empty texts have no ids; null and repeated ids each give their
    row; an empty table gives none; other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_cached(("pieces", model), lambda: Encoder(model))
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "ids": list(enc.encode(pdf["text"].tolist()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
               .mapInPandas(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``; null ids decode to the empty text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dec = Decoder(PieceModel(model))
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "text": [dec.decode(x or b"") for x in pdf["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` in one pass: the ids and what they decode to."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_cached(("pieces", model), lambda: Encoder(model))
        dec = Decoder(enc.model)
        for pdf in batches:
            doc_id, texts = pdf["doc_id"].astype("Int64"), pdf["text"].tolist()
            for a, b in blocks(texts):
                ids = enc.encode_block(texts[a:b])
                yield pd.DataFrame({"doc_id": doc_id[a:b], "ids": ids, "decoded": list(map(dec.decode, ids))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
               .mapInPandas(run, "doc_id long, ids binary, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, their crc32, and the decoded text's hash."""
    docs = read_table(spark, sf_dir, "documents")
    out = encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """The last stage of a pipeline: ``(doc_id, n_tokens, ids, lossless)`` per
    row, ids as an array of integers; lossless says that they decode to the text.

    Null and empty texts have no ids; null and repeated ids each give their row; an
    empty table gives none; other columns are not read.
    """
    model = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_cached(("pieces", model), lambda: Encoder(model))
        dec = Decoder(enc.model)
        for pdf in batches:
            doc_id, texts = pdf["doc_id"].astype("Int64"), pdf["text"].tolist()
            for a, b in blocks(texts):
                ids = enc.encode_block(texts[a:b])
                yield pd.DataFrame({"doc_id": doc_id[a:b], "n_tokens": [len(x) // 4 for x in ids],
                                    "ids": [np.frombuffer(x, "<i4") for x in ids],
                                    "lossless": [dec.decode(x) == t for x, t in zip(ids, texts[a:b])]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")) \
               .mapInPandas(run, "doc_id long, n_tokens long, ids array<int>, lossless boolean")
