"""Token ids in Arrow files of fixed-size-list batches.

Documents are range-partitioned and sorted by doc_id, so file after file is one
ascending stream of ids. Every task cuts the ids of its documents, an end id
behind each, into sequences of ``SEQUENCE`` ids and writes them, ``BATCH``
sequences a record batch, in Arrow's random-access file format: ``ids`` and
``mask``, both fixed-size lists of that length. Only the last sequence of a file
is padded; the mask (bits) is false there. Files are not compressed, so a reader
maps one into memory and each sequence is a view of it: batch ``i // BATCH``,
row ``i % BATCH``. A second Arrow file of the task lists its documents (doc_id,
first id, number of ids).

Texts are encoded with the tokenizers library. A byte-level vocabulary never
joins characters over the start of a word, so a text is cut in front of blanks
where that changes no id, each distinct part is encoded once and kept in a
cache bounded in bytes: two halves, of which the older one is dropped when the
newer is full, so that parts in use stay. A new part of Latin letters and signs is
cut by the vocabulary's pattern and its pieces go to the library's model; any
other part, other tokenizers, and texts that hold a special token, go to the
library whole.

A task names its files anew each time it runs and only the files named in the
manifest, which Spark commits, are read; what a lost or repeated task leaves is
ignored. Memory in a task is bounded by a block of texts, one batch of
sequences and the cache. Where the files of the tasks begin in the stream is a
running sum over one row for each file.

Defined results: null text encodes as empty and has the end id alone. A null
doc_id comes first. Rows repeated with one id follow each other by a hash of
the text, and a hot id spreads over files. An empty table gives no file and no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import PATTERN, byte_alphabet
from strata.llm.common import map_batches, slices

SEQUENCE = 2048
BATCH = 64
END_ID = 0
# Bytes of text encoded at a time, and bytes that each half of the parts kept in a worker may take.
BLOCK_BYTES = 1 << 20
CACHE_BYTES = 72 << 20
# What an entry of the cache takes besides its text and ids.
_ENTRY_BYTES = 220
# A blank between white space, or at the end behind some: the cut in front of it could part one piece of white space.
_UNSAFE = re.compile(r"\s (?:\s|$)")
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")
# Below this, what is a letter is the same in every version of Unicode.
_LATIN = "\u0250"
_BYTES = byte_alphabet()
_BLANK = _BYTES[32]
# Signs that are a piece of their own behind a letter.
_STOPS = tuple(".,;:!?)")

_MANIFEST = "part int, file string, documents string, n_documents long, n_ids long"


class _Parts(dict):
    """Packed ids of parts of texts; an unknown part is encoded when it is asked for."""

    def __init__(self, tokenizer, code: str):
        super().__init__()
        self.tokenizer, self.model, self.code, self.find = tokenizer, tokenizer.model, code, regex.compile(PATTERN).findall
        self.older: dict[str, bytes] = {}
        self.used = 0

    def __missing__(self, part: str) -> bytes:
        if (ids := self.older.get(part)) is None:
            ids = self._encoded(part)
        self[part] = ids
        self.used += len(part) + len(ids) + _ENTRY_BYTES
        return ids

    def _encoded(self, part: str) -> bytes:
        if not part.isascii() and max(part) >= _LATIN:
            return self.whole([part])[0]
        if not (part[1:].isalpha() and (part[0] == " " or part[0].isalpha())):
            if part[-1:] in _STOPS and part[1:-1].isalpha() and (part[0] == " " or part[0].isalpha()):
                return self[part[:-1]] + self[part[-1]]
            pieces = self.find(part)
            if len(pieces) != 1:
                return b"".join([self[p] for p in pieces])
        # one piece; printable ASCII but the blank stands for itself
        spelt = part.replace(" ", _BLANK) if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(_BYTES)
        return array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def aged(self, limit: int) -> "_Parts":
        """This, or an empty one with this as its older half if it holds over ``limit`` bytes."""
        if self.used <= limit:
            return self
        new = _Parts(self.tokenizer, self.code)
        self.older = {}
        new.older = self
        return new


class Encoder:
    """Texts to arrays of ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, spec: str, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on a core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        spec = json.loads(spec)
        before = spec.get("pre_tokenizer") or {}
        self.by_parts = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and spec.get("normalizer") is None
                         and not before.get("add_prefix_space"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.type = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.parts, self.cache_bytes = _Parts(tokenizer, self.type.char), cache_bytes

    def _cut(self, text: str) -> list[str] | None:
        """The text cut in front of blanks; None if it must stay whole."""
        if not self.by_parts or any(t in text for t in self.special):
            return None
        if "\0" in text or _UNSAFE.search(text):
            return _SAFE_CUT.split(text)
        return text.replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.parts = self.parts.aged(self.cache_bytes)
        ids = self.parts.__getitem__
        out = [b"".join(map(ids, cut)) if (cut := self._cut(text)) is not None else self.parts.whole([text])[0] for text in texts]
        return [np.frombuffer(x, self.type) for x in out]


_ENCODER: dict[str, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """The encoder of a broadcast tokenizer; a reused Python worker keeps one."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[key] = Encoder(spec)
    return _ENCODER[key]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a plain local path."""
    return fs.FileSystem.from_uri(path)


class SequenceWriter:
    """One pair of files: ids go in, document by document; sequences and their masks come out in batches."""

    def __init__(self, folder: str, name: str, id_type: np.dtype, sequence: int = SEQUENCE, batch: int = BATCH):
        self.file, self.documents = f"{folder}/{name}.arrow", f"{folder}/{name}.documents.arrow"
        self.sequence, self.size, self.type = sequence, sequence * batch, id_type
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(id_type), sequence)),
                                 ("mask", pa.list_(pa.bool_(), sequence))], metadata={"batch": str(batch)})
        self.rows_schema = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64())])
        system, path = _opened(folder)
        system.create_dir(path, recursive=True)
        self.sinks = [system.open_output_stream(_opened(p)[1]) for p in (self.file, self.documents)]
        self.writer = pa.ipc.new_file(self.sinks[0], self.schema)
        self.rows_writer = pa.ipc.new_file(self.sinks[1], self.rows_schema)
        self.buffer, self.filled = np.zeros(self.size, id_type), 0
        self.n_documents = self.n_ids = 0

    def _flush(self) -> None:
        n = -(-self.filled // self.sequence) * self.sequence
        self.buffer[self.filled:n] = 0
        mask = np.zeros(n, bool)
        mask[:self.filled] = True
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(self.buffer[:n]), type=self.schema.field(0).type),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field(1).type)], schema=self.schema))
        self.filled = 0

    def add(self, doc_ids: pa.Array, ids: list[np.ndarray], end_id: int) -> None:
        first, lengths = [], []
        for found in ids:
            first.append(self.n_ids)
            lengths.append(len(found) + 1)
            self.n_ids += len(found) + 1
            for piece in (found, np.array([end_id], self.type)):
                done = 0
                while done < len(piece):
                    step = min(len(piece) - done, self.size - self.filled)
                    self.buffer[self.filled:self.filled + step] = piece[done:done + step]
                    self.filled += step
                    done += step
                    if self.filled == self.size:
                        self._flush()
        self.rows_writer.write_batch(pa.record_batch(
            [doc_ids.cast(pa.int64()), pa.array(first, pa.int64()), pa.array(lengths, pa.int64())], schema=self.rows_schema))
        self.n_documents += len(ids)

    def close(self) -> None:
        if self.filled:
            self._flush()
        for part in (self.writer, self.rows_writer, *self.sinks):
            part.close()


class SequenceFile:
    """Random access to the sequences, masks and documents of one pair of files.

    A local file is mapped into memory and sequences are views of the map; from
    another store a batch is read when it is asked for.
    """

    def __init__(self, file: str, documents: str):
        self.reader, self.rows = self._reader(file), self._reader(documents)
        self.sequence = self.reader.schema.field("ids").type.list_size
        self.batch = int(self.reader.schema.metadata[b"batch"])
        self._at: tuple[int, pa.RecordBatch | None] = (-1, None)

    @staticmethod
    def _reader(path: str) -> pa.ipc.RecordBatchFileReader:
        system, path = _opened(path)
        return pa.ipc.open_file(pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path))

    def __len__(self) -> int:
        last = self.reader.num_record_batches - 1
        return 0 if last < 0 else last * self.batch + self._batch(last).num_rows

    def _batch(self, k: int) -> pa.RecordBatch:
        if self._at[0] != k:
            self._at = (k, self.reader.get_batch(k))
        return self._at[1]

    def ids(self, i: int) -> np.ndarray:
        """Sequence ``i``, a view."""
        return self._batch(i // self.batch).column("ids")[i % self.batch].values.to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.Array:
        """The mask of sequence ``i``, a view of its bits."""
        return self._batch(i // self.batch).column("mask")[i % self.batch].values

    def stretch(self, first: int, n: int) -> Iterator[np.ndarray]:
        """``n`` ids of the stream from ``first`` on, as views of one batch each."""
        size = self.batch * self.sequence
        while n > 0:
            k, at = divmod(first, size)
            step = min(n, size - at)
            yield self._batch(k).column("ids").flatten().to_numpy(zero_copy_only=True)[at:at + step]
            first, n = first + step, n - step

    def document_rows(self) -> Iterator[pa.RecordBatch]:
        for k in range(self.rows.num_record_batches):
            yield self.rows.get_batch(k)


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, sequence: int = SEQUENCE,
          batch: int = BATCH) -> DataFrame:
    """Writes the files below ``folder`` and returns the committed manifest.

    One row a file, in stream order by ``part``: file, documents, n_documents, n_ids.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, part = _encoder(shared.value), None, 0
        try:
            for rows in batches:
                for block in slices(rows, 1, BLOCK_BYTES):
                    if out is None:
                        part = block.column(2)[0].as_py()
                        out = SequenceWriter(f"{folder}/data", f"part-{part:06d}-{uuid.uuid4().hex}", encoder.type, sequence, batch)
                    out.add(block.column(0), encoder.encode([t or "" for t in block.column(1).to_pylist()]), end_id)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([out.file]), pa.array([out.documents]),
                 pa.array([out.n_documents], pa.int64()), pa.array([out.n_ids], pa.int64())],
                names=["part", "file", "documents", "n_documents", "n_ids"])

    # equal rows may go anywhere among themselves, so a hot id needs no task of its own
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.xxhash64("text").alias("_hash"), F.rand(11).alias("_salt"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), "_hash", "_salt")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_hash"))
    rows = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))
    map_batches(rows, run, _MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def digest(manifest: DataFrame) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for file, documents, base in zip(*(c.to_pylist() for c in files.columns), strict=True):
                found = SequenceFile(file, documents)
                for rows in found.document_rows():
                    first, n = rows.column("first").to_numpy(), rows.column("n_ids").to_numpy()
                    crcs = []
                    for at, size in zip(first.tolist(), n.tolist(), strict=True):
                        crc = 0
                        for view in found.stretch(at, size):
                            crc = zlib.crc32(view.astype("<u4"), crc)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), pa.array(first + base, pa.int64()), pa.array(n, pa.int64()), pa.array(crcs, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # a row a file; summed in one task, read in one task for each file
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", "documents", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    return map_batches(files.repartition(max(manifest.count(), 1)), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
