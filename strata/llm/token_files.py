"""Operator 1: token ids in seekable binary files.

A file is a row of independent zstandard frames (each with zstandard's own
content checksum), followed by two skippable frames: a directory of the
documents, and the trailing seek table of the public zstandard seekable format
(sizes and a checksum per frame).  A reader loads the table and the directory
from the end of the file, then reads and decompresses only the frames of the
documents that are asked for.

Documents are range-partitioned by id, one file per partition, written under a
temporary name and renamed, so a task that runs again replaces its own file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import read_table, shared_folder, store, text_of, worker_cached

END_ID = 1
FRAME_TOKENS = 65536
# fixed values of the zstandard seekable format
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MEMO_FIELDS = 500_000
MEMO_FIELD_BYTES = 64


def byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class FieldEncoder(dict):
    """Ids (little-endian unsigned 32-bit) of white-space separated fields.

    The tokenizer drops white space and never looks across it, so a text's ids
    are those of its fields in order.  Fields are encoded by the library once
    and remembered; the memory is emptied when it holds ``limit`` fields.
    Fields of Latin-1 letters, with a mark behind or not, are one or two
    pre-tokens in composed form already, so the library's model gets them
    directly; all others, and those with special strings, go through the
    library's whole chain.
    """

    def __init__(self, path: str, limit: int = MEMO_FIELDS):
        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.model, self.limit = self.tok.model, limit
        self.table = str.maketrans({chr(b): c for b, c in byte_chars().items()})

    def _word(self, letters: str) -> list[int]:
        mapped = letters.lower().encode().decode("latin-1").translate(self.table)
        return [t.id for t in self.model.tokenize(mapped)]

    def __missing__(self, field: bytes) -> bytes:
        s = field.decode()
        head, last = s[:-1], s[-1:]
        if s.isalpha() and max(s) < "Ā":
            ids = self._word(s)
        elif head.isalpha() and last in ".,;:!?" and max(head) < "Ā":
            ids = self._word(head) + self._word(last)
        else:
            ids = self.tok.encode(s, add_special_tokens=False).ids
        out = array("I", ids).tobytes()
        if len(field) <= MEMO_FIELD_BYTES:
            if len(self) >= self.limit:
                self.clear()
            self[field] = out
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split()))


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a plain path is a local one."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else ("file://" + uri.removeprefix("file:")))


class TokenFileWriter:
    """Writes documents to one file, frame by frame."""

    def __init__(self, uri: str, frame_tokens: int = FRAME_TOKENS):
        self.fs, self.path = _open(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temp)
        self.zstd = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
        self.limit, self.frames, self.open_, self.size = 4 * frame_tokens, [], [], 0
        self.ids, self.void, self.counts, self.frame_of = array("q"), bytearray(), array("I"), array("I")

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.open_ and self.size + len(ids) > self.limit:
            self._flush()
        self.ids.append(0 if doc_id is None else doc_id)
        self.void.append(doc_id is None)
        self.counts.append(len(ids) // 4)
        self.frame_of.append(len(self.frames))
        self.open_.append(ids)
        self.size += len(ids)

    def _flush(self) -> None:
        if self.open_:
            raw = b"".join(self.open_)
            packed = self.zstd.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.open_, self.size = [], 0

    def close(self) -> None:
        self._flush()
        parts = [bytes(self.void), self.ids.tobytes(), self.counts.tobytes(), self.frame_of.tobytes()]
        directory = self.zstd.compress(struct.pack("<Q", len(self.void)) + b"".join(parts))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)
        self.out.close()
        self.fs.move(self.temp, self.path)


class TokenFileReader:
    """Random access to one file; frames are read and checked on demand."""

    def __init__(self, uri: str):
        fs, path = _open(uri)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        n, flag, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError(f"{uri}: no seek table")
        start = end - 9 - 12 * n
        self.frames = np.frombuffer(self._at(start, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.r_[0, np.cumsum(self.frames[:, 0])] if n else np.zeros(1, np.int64)
        at = int(self.offsets[-1])
        magic, size = struct.unpack("<II", self._at(at, 8))
        if magic != SKIPPABLE_DIRECTORY:
            raise ValueError(f"{uri}: no directory")
        raw = zstandard.ZstdDecompressor().decompress(self._at(at + 8, size))
        docs = struct.unpack_from("<Q", raw)[0]
        self.void = np.frombuffer(raw, np.uint8, docs, 8).astype(bool)
        self.ids = np.frombuffer(raw, "<i8", docs, 8 + docs)
        self.counts = np.frombuffer(raw, "<u4", docs, 8 + 9 * docs).astype(np.int64)
        self.frame_of = np.frombuffer(raw, "<u4", docs, 8 + 13 * docs).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, k: int) -> bytes:
        packed, raw_size, check = self.frames[k]
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[k]), int(packed)))
        if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: checksum differs")
        return raw

    def documents(self, which: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """``(doc_id, ids before it in this file, its ids)`` of the documents
        with the given ids, or of all, in file order."""
        wanted = np.ones(len(self.ids), bool) if which is None else \
            np.isin(self.ids, np.fromiter(which, np.int64)) & ~self.void
        before = np.cumsum(self.counts) - self.counts
        now, raw = -1, b""
        first = np.searchsorted(self.frame_of, np.arange(len(self.frames)))
        for d in np.flatnonzero(wanted):
            if self.frame_of[d] != now:
                now = int(self.frame_of[d])
                raw = self.frame(now)
            at = 4 * int(before[d] - before[first[now]])
            yield (None if self.void[d] else int(self.ids[d])), int(before[d]), raw[at:at + 4 * int(self.counts[d])]

    def close(self) -> None:
        self.file.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                      frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into files under ``folder``; the manifest.

    The manifest has one row per file: ``path``, ``docs``, ``tokens`` and
    ``start`` (ids in all files before it).  Files, and documents in them, are
    in ascending doc_id order, nulls first, rows of one id by a hash of the
    text (so many equal or null ids are dealt over several files).  Null and
    empty texts give a document of only the end id; an empty table gives no
    file.  Other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, out, end = None, None, array("I", [end_id]).tobytes()
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}.ids.zst"
        n = tokens = 0
        for pdf in batches:
            if out is None:
                out = TokenFileWriter(path, frame_tokens)
                enc = worker_cached(("fields", tokenizer), lambda: FieldEncoder(tokenizer))
            for d, void, text in zip(pdf["doc_id"], pdf["void"], pdf["text"]):
                ids = enc.encode(text) + end
                out.add(None if void else int(d), ids)
                n, tokens = n + 1, tokens + len(ids) // 4
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "docs": [n], "tokens": [tokens]})

    id_ = F.col("doc_id").cast("long")
    d = docs.select(F.coalesce(id_, F.lit(0)).alias("doc_id"), id_.isNull().alias("void"), text_of().alias("text"))
    order = [F.col("void").desc(), F.col("doc_id"), F.xxhash64("text")]
    files = (d.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInPandas(run, "path string, docs long, tokens long"))
    files = store(files, "token-manifest")  # one row a file
    ahead = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` of every document, from the files."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start in zip(pdf["path"], pdf["start"]):
                reader, rows, size = TokenFileReader(path), [], 0
                for doc_id, before, ids in reader.documents():
                    rows.append((doc_id, start + before, len(ids) // 4, zlib.crc32(ids), ids))
                    size += len(ids)
                    if size > 1 << 23:
                        yield frame(rows)
                        rows, size = [], 0
                reader.close()
                if rows:
                    yield frame(rows)

    def frame(rows: list) -> pd.DataFrame:
        pdf = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
        return pdf.astype({"doc_id": "Int64"})

    # files of about equal size, dealt over as many tasks (a given number is not coalesced)
    spread = manifest.repartition(max(1, manifest.count()), "path")
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    manifest = write_token_files(read_table(spark, sf_dir, "documents"), folder,
                                 public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
