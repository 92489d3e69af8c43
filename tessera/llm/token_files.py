"""Token ids in Arrow IPC files of equal-length sequences.

``write_token_files`` encodes documents, appends an end id to each, and
lays the ids of all documents end to end in ascending ``doc_id`` order.
Spark range-partitions and sorts the rows by ``doc_id``; every partition
writes

* ``tokens-NNNNN.arrow``: Arrow IPC file, record batches of
  ``BATCH_SEQUENCES`` rows with two fixed-size-list columns, ``ids`` (the
  smallest unsigned type that holds the vocabulary) and ``mask`` (true for
  ids, false for the padding that fills the last sequence of a file);
* ``docs-NNNNN.arrow``: Arrow IPC file with ``doc_id``, ``start`` (within
  the token file) and ``n_tokens``.

Values of a record batch lie contiguously and uncompressed, so a memory
map gives any sequence, mask or document without copying (``TokenFile``).
A task writes under a name of its own and renames when it is done: a task
that is lost or runs twice leaves the same file.

Defined results: NULL or empty text has only the end id.  Rows with a NULL
``doc_id`` come first; rows with the same id are ordered by text and all
kept.  An empty table gives no files and an empty result.  Further columns
of the input are not read.
"""

from __future__ import annotations

import array
import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, cut, runs

#: Ids per sequence, sequences per record batch.
SEQUENCE = 2048
BATCH_SEQUENCES = 64
#: Chunks a worker remembers (per generation), and their longest length.
REMEMBERED = 400_000
MEMO_BYTES = 48
#: Bytes of text encoded at a time (a longer document alone).
RUN_BYTES = 8 << 20

MANIFEST = "part int, tokens string, docs string, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


class ChunkEncoder:
    """``tokenizers`` ids of texts, put together from the ids of their
    white-space-separated chunks.

    Valid for tokenizers whose pre-tokenizer drops white space and never
    joins across it; others are encoded whole.  The chunks of a batch are
    dictionary-encoded, so each different chunk is looked up once and the
    ids are gathered by array operations.  For chunks of plain characters
    (printable ASCII and the letters of Latin-1, which are composed already
    and have a lower case of one character) under the normaliser (NFC,
    white space, lower case) and the pre-tokenizer (split by a pattern,
    byte level), the split is done here with the file's own pattern and
    only the merges are left to the library.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.dtype = np.dtype(dtype)
        self.pattern = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
        steps = pre.get("pretokenizers", [])
        split = steps[0] if [s["type"] for s in steps] == ["Split", "ByteLevel"] else {}
        self.by_chunk = bool(split.get("invert")) and split.get("behavior") == "Removed" and not any(
            t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        if (self.by_chunk and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
                and [s["type"] for s in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]):
            import regex

            self.pattern = regex.compile(split["pattern"]["Regex"])
            self.plain = regex.compile("[!-~À-ÖØ-öø-ÿ]+")
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.model = self.lib.model
        self.chunks = Memo(self._chunk, REMEMBERED)
        self.pieces = Memo(self._piece, REMEMBERED)

    def _pack(self, ids: list[int]) -> bytes:
        return array.array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.lib.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        return self._pack([t.id for t in self.model.tokenize(
            piece if piece.isascii() else piece.translate(self.bytes))])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.pattern is not None and (text.isascii() or self.plain.fullmatch(text)):
            if text.isalpha():  # one piece
                return self.pieces[text.lower()]
            if text[-1:] in (".", ",") and text[:-1].isalpha():  # two
                return self.pieces[text[:-1].lower()] + self.pieces[text[-1]]
            if text.isprintable() and not any(a in text for a in self.added):
                return b"".join([self.pieces[p] for p in self.pattern.findall(text.lower())])
        return self._whole(text) if text else b""

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin
        (one more entry: the end).  NULL is the empty text."""
        texts = texts.fill_null("")
        if not self.by_chunk:
            packed = [np.frombuffer(self._whole(t), self.dtype) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, self.dtype), *packed]), np.cumsum([0, *map(len, packed)])
        self.chunks.turn()
        self.pieces.turn()
        # fewer different chunks; added tokens are matched before letters become lower case
        if self.pattern is not None and not any(pc.any(pc.match_substring(texts, a, ignore_case=True)).as_py()
                                                for a in self.added):
            texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        memo = self.chunks
        packed = [memo[c] if len(c) <= MEMO_BYTES else self._chunk(c)
                  for c in found.dictionary.cast(pa.binary()).to_pylist()]
        pool = np.frombuffer(b"".join(packed), self.dtype)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        at = np.cumsum(sizes) - sizes
        chunk = found.indices.to_numpy()
        size = sizes[chunk]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = pool[np.repeat(at[chunk] - ends[:-1], size) + np.arange(ends[-1])]
        lists = split.offsets.to_numpy()
        return ids, ends[lists - lists[0]]


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, dtype: str) -> ChunkEncoder:
    """One encoder for each worker process."""
    key = (path, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, dtype)
    return _ENCODERS[key]


def id_type(path: str) -> str:
    """Smallest little-endian unsigned type that holds every id."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, and the path within it."""
    return pafs.FileSystem.from_uri(path)


class SequenceWriter:
    """Collects packed ids and writes full record batches."""

    def __init__(self, sink, dtype: str, length: int):
        self.dtype, self.length = np.dtype(dtype), length
        kind = pa.from_numpy_dtype(self.dtype.newbyteorder("="))
        self.schema = pa.schema([pa.field("ids", pa.list_(kind, length), nullable=False),
                                 pa.field("mask", pa.list_(pa.bool_(), length), nullable=False)])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[bytes] = []
        self.bytes = self.tokens = 0
        self.full = length * BATCH_SEQUENCES * self.dtype.itemsize

    def add(self, packed: bytes) -> int:
        """Append one document; returns its number of ids."""
        n = len(packed) // self.dtype.itemsize
        self.waiting.append(packed)
        self.bytes += len(packed)
        self.tokens += n
        if self.bytes >= self.full:
            data = b"".join(self.waiting)
            whole = len(data) // self.full * self.full
            for i in range(0, whole, self.full):
                self._batch(data[i:i + self.full])
            self.waiting, self.bytes = [data[whole:]], len(data) - whole
        return n

    def _batch(self, data: bytes) -> None:
        ids = np.frombuffer(data, self.dtype)
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, self.dtype)
        padded[:len(ids)] = ids
        mask = np.arange(rows * self.length) < len(ids)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (padded, mask)]
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.bytes:
            self._batch(b"".join(self.waiting))
        self.out.close()


class TokenFile:
    """Random access to one token file, zero-copy where it is local."""

    def __init__(self, path: str):
        fs, inner = file_system(path)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(inner) if local else fs.open_input_file(inner)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batches = self.reader.num_record_batches

    def flat(self, batch: int) -> np.ndarray:
        """All ids of a record batch, padding included."""
        return self.reader.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``."""
        batch, row = divmod(i, BATCH_SEQUENCES)
        got = self.reader.get_batch(batch)
        ids, mask = (got.column(c).flatten().slice(row * self.length, self.length) for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def crc32(self, starts: np.ndarray, counts: np.ndarray) -> list[int]:
        """Checksums of id ranges in ascending order, as 32-bit integers;
        each record batch is read once."""
        out, at, data = [], -1, b""
        width = self.length * BATCH_SEQUENCES
        for start, n in zip(starts.tolist(), counts.tolist()):
            crc = 0
            while n:
                batch, offset = divmod(start, width)
                if batch != at:
                    at, data = batch, memoryview(self.flat(batch).astype("<u4")).cast("B")
                take = min(n, width - offset)
                crc = zlib.crc32(data[4 * offset:4 * (offset + take)], crc)
                start, n = start + take, n - take
            out.append(crc)
        return out

    def close(self) -> None:
        self.source.close()


def _writer(folder: str, path: str, dtype: str, length: int, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        enc, end = encoder(path, dtype), np.array([end_id], np.dtype(dtype)).tobytes()
        fs, inner = file_system(folder)
        names = [f"{kind}-{part:05d}.arrow" for kind in ("tokens", "docs")]
        own = f"{inner}/.{uuid.uuid4().hex}"
        out = sinks = None
        index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        docs = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(own, recursive=True)
                sinks = [fs.open_output_stream(f"{own}/{n}") for n in names]
                out = SequenceWriter(sinks[0], dtype, length)
                index = pa.ipc.new_file(sinks[1], index_schema)
            texts = batch.column(1)
            for start, stop in runs(pc.binary_length(texts).fill_null(0).to_pylist(), RUN_BYTES):
                ids, at = enc.encode(texts.slice(start, stop - start))
                starts, counts = [], []
                for a, b in zip(at.tolist(), at[1:].tolist()):
                    starts.append(out.tokens)
                    counts.append(out.add(ids[a:b].tobytes() + end))
                index.write_batch(pa.record_batch(
                    [batch.column(0).slice(start, stop - start), pa.array(starts, pa.int64()),
                     pa.array(counts, pa.int64())], schema=index_schema))
            docs += batch.num_rows
        if out is None:
            return
        out.close()
        index.close()
        for sink, name in zip(sinks, names):
            sink.close()
            fs.move(f"{own}/{name}", f"{inner}/{name}")
        fs.delete_dir(own)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "tokens": [f"{folder}/{names[0]}"], "docs": [f"{folder}/{names[1]}"],
            "n_docs": pa.array([docs], pa.int64()), "n_tokens": pa.array([out.tokens], pa.int64())})

    return write


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 1, length: int = SEQUENCE) -> DataFrame:
    """Write ``docs`` (doc_id, text) into ``folder``, a shared folder, and
    return the manifest: one row per file, with ``start``, the number of
    ids in the files before it.

    One shuffle (range partitioning by ``doc_id`` and the text's hash, so
    that a repeated id fills as many files as its texts need; its rows are in
    order of the hash); the manifest has one row per partition and is all
    that is ordered in one task.
    """
    sort = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("text").asc_nulls_first()]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .repartitionByRange(*sort[:2]).sortWithinPartitions(*sort))
    files = cut(rows.mapInArrow(_writer(folder, path, id_type(path), length, end_id), MANIFEST))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """Read the files of a manifest back: ``doc_id``, global ``start``,
    ``n_tokens`` and the checksum of the ids of every document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for row in files.to_pylist():
                tokens = TokenFile(row["tokens"])
                fs, inner = file_system(row["docs"])
                with fs.open_input_file(inner) as f:
                    reader = pa.ipc.open_file(f)
                    for i in range(reader.num_record_batches):
                        docs = reader.get_batch(i)
                        starts, counts = (docs.column(c).to_numpy() for c in (1, 2))
                        yield pa.RecordBatch.from_arrays(
                            [docs.column(0), pa.array(starts + row["start"]), docs.column(2),
                             pa.array(tokens.crc32(starts, counts), pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                tokens.close()

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("tokens", "docs", "start").repartition(parts).mapInArrow(read, READ)
