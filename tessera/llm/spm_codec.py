"""SentencePiece encoding with the original byte span of every piece.

A model's normaliser is read from its compiled character map: a
double-array trie of byte strings, each with a replacement.  At every
position the longest prefix found in the map is replaced (a character that
is not in the map stands for itself), and the place in the original text
that each normalised byte comes from is recorded.  The pieces tile the
normalised text, so their starts and ends, taken through that record, are
byte spans of the original text; a text that its pieces do not tile is an
error.  Every text is normalised so, also by a map without entries (the
identity), for which the record is made for all bytes at once.

Ids are those of the sentencepiece library.  Where a model has the
identity map, keeps white space and has no piece that holds a space after
another character, merges never cross a space, so the ids of a text are
those of its normalised text's segments (each a run of spaces and what
follows), which a worker remembers; any other model encodes whole texts.

Defined results: NULL text is the empty text; an empty text has no pieces
(only begin and end ids where asked for).  Begin and end ids have the empty
spans at the two ends.  Repeated rows, further columns and clashing names
are kept as they are (the outputs are put into a struct).  An empty table
gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import BATCH_BYTES, Memo, packed, runs, utf8

SPACE = "▁"
#: Segments a worker remembers (per generation), and their longest length.
REMEMBERED = 100_000
MEMO_BYTES = 48

CODE = "ids array<int>, starts array<int>, ends array<int>, ids_le binary, spans_le binary, decoded string"


class CharMap:
    """Longest-prefix rewriting by a compiled character map."""

    def __init__(self, blob: bytes):
        self.units, self.pool = (), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.pool = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """Length of the longest prefix of ``data[at:]`` in the map and the
        place of its replacement."""
        units, node, found = self.units, 0, None
        if not units:
            return None
        unit = units[0]
        for i in range(at, len(data)):
            # a unit holds an offset (shifted by 8 more where bit 9 is set), a leaf mark and a label
            node ^= (unit >> 10) << ((unit & 0x200) >> 6) ^ data[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[i]:
                break
            if unit & 0x100:
                leaf = node ^ ((unit >> 10) << ((unit & 0x200) >> 6))
                found = (i + 1 - at, units[leaf] & 0x7FFFFFFF)
        return found

    def step(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Bytes consumed at ``at`` and what they become."""
        if found := self.longest(data, at):
            size, place = found
            return size, self.pool[place:self.pool.index(b"\0", place)]
        lead = data[at]
        size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return size, data[at:at + size]


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = schema.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.rules, self.suffix = model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix
        self.map = CharMap(self.rules.precompiled_charsmap)
        kinds = schema.ModelProto.SentencePiece
        sizes = [1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in model.pieces]
        #: bytes of each piece in the normalised text
        self.normal_size = np.array(sizes)
        plain = (not self.rules.precompiled_charsmap and self.rules.add_dummy_prefix and not self.suffix
                 and not self.rules.remove_extra_whitespaces and self.rules.escape_whitespaces)
        mixed = any(SPACE in p.piece.lstrip(SPACE) or p.type == kinds.USER_DEFINED for p in model.pieces)
        whole = sum(p.type == kinds.BYTE for p in model.pieces) == 256
        self.by_segment = plain and whole and not mixed
        self.segments = Memo(self._segment, REMEMBERED)

    # ---- normaliser -----------------------------------------------------

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for every one of them (and the end)
        the place in ``data`` it comes from."""
        rules, space = self.rules, SPACE.encode() if self.rules.escape_whitespaces else b" "
        if not self.map.units and not rules.remove_extra_whitespaces and not self.suffix and data:
            return self._identity(data, space)
        found, at = [], 0
        while at < len(data):
            size, new = self.map.step(data, at)
            found.append((at, size, new))
            at += size
        end = len(data)
        if rules.remove_extra_whitespaces:
            while found and found[0][2].strip(b" ") == b"":
                found.pop(0)
            while found and found[-1][2].strip(b" ") == b"":
                end = found.pop()[0]
        out, origin, after_space = bytearray(), [], rules.remove_extra_whitespaces

        def put(new: bytes, at: int, size: int) -> None:
            out.extend(new)
            # a character that stands for itself maps byte by byte
            origin.extend(range(at, at + size) if new == data[at:at + size] else [at] * len(new))

        if not found:
            return b"", np.array([end])
        if rules.add_dummy_prefix and not self.suffix:
            put(space, found[0][0], 0)
        for at, size, new in found:
            while rules.remove_extra_whitespaces and after_space and new.startswith(b" "):
                new = new[1:]
            if new:
                after_space = new.endswith(b" ")
                put(new.replace(b" ", space), at, size)
        while rules.remove_extra_whitespaces and out.endswith(space):
            del out[-len(space):], origin[-len(space):]
        if rules.add_dummy_prefix and self.suffix:
            put(space, end, 0)
        return bytes(out), np.array([*origin, end])

    def _identity(self, data: bytes, space: bytes) -> tuple[bytes, np.ndarray]:
        """``normalise`` where every character stands for itself."""
        before = space if self.rules.add_dummy_prefix else b""
        width = np.where(np.frombuffer(data, np.uint8) == ord(" "), len(space), 1)
        origin = np.repeat(np.arange(len(data)), width)
        return before + data.replace(b" ", space), np.concatenate([np.zeros(len(before), origin.dtype), origin, [len(data)]])

    # ---- encoder --------------------------------------------------------

    def _segment(self, segment: bytes) -> bytes:
        return np.array(self.lib.encode(segment.decode("utf-8", "replace")), "<u4").tobytes()

    def _by_segments(self, normal: bytes) -> np.ndarray:
        """Ids of a normalised text, put together by segment: a run of
        spaces and the characters after it."""
        self.segments.turn()
        memo = self.segments
        data = normal.replace(SPACE.encode(), b" ")[1:]  # segments get their first space back from the library
        if data.startswith(b" ") or b"  " in data:
            parts = [s[1:] for s in re.findall(rb" +[^ ]*", b" " + data)]
        else:
            parts = data.split(b" ")
        # an empty segment is a lone space (at the end of the text); alone it would have no piece
        return np.frombuffer(b"".join([
            (memo[p] if len(p) <= MEMO_BYTES else self._segment(p)) if p else self.lone for p in parts]), "<u4")

    @property
    def lone(self) -> bytes:
        return np.array([self.lib.piece_to_id(SPACE)], "<u4").tobytes()

    def encode(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, span starts and span ends of a text's pieces."""
        if not data:
            none = np.zeros(0, np.int64)
            return none.astype("<u4"), none, none
        normal, origin = self.normalise(data)
        if self.by_segment and SPACE.encode() not in data:
            ids = self._by_segments(normal)
            sizes = self.normal_size[ids]
        else:
            found = self.lib.encode(data.decode("utf-8", "replace"), return_type="proto").pieces
            ids = np.array([p.id for p in found], "<u4")
            sizes = self.normal_size[ids] if len(ids) else np.zeros(0, np.int64)
            unknown = ids == self.lib.unk_id()
            if unknown.any():
                sizes = np.where(unknown, [len(p.piece.encode()) for p in found], sizes)
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        if len(ids) and edges[-1] != len(normal):
            raise ValueError("the pieces do not tile the normalised text")
        return ids, origin[edges[:-1]], origin[edges[1:]]

    def decode(self, ids: np.ndarray) -> str:
        return self.lib.decode(ids.tolist())


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _coder(path: str, bos: bool, eos: bool, text: int, decode: bool):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        first = [c.lib.bos_id()] if bos else []
        last = [c.lib.eos_id()] if eos else []
        for batch in batches:
            texts = utf8(batch.column(0).field(text))
            # an id array takes several times the text's bytes
            for start, stop in runs([len(t) for t in texts], BATCH_BYTES // 2):
                ids, starts, ends, decoded = [], [], [], []
                for t in texts[start:stop]:
                    i, s, e = c.encode(t)
                    i = np.concatenate([first, i, last]).astype("<u4")
                    ids.append(i)
                    starts.append(np.concatenate([[0] * bos, s, [len(t)] * eos]))
                    ends.append(np.concatenate([[0] * bos, e, [len(t)] * eos]))
                    decoded.append(c.decode(i) if decode else None)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _lists(ids), _lists(starts), _lists(ends),
                     pa.array([i.tobytes() for i in ids], pa.binary()),
                     pa.array([np.stack([a, b], axis=1).astype("<i4").tobytes() for a, b in zip(starts, ends)], pa.binary()),
                     pa.array(decoded, pa.string())],
                    names=["row", "ids", "starts", "ends", "ids_le", "spans_le", "decoded"])

    return code


def encode(df: DataFrame, path: str, text: str = "text", bos: bool = True, eos: bool = True,
           decode: bool = True) -> DataFrame:
    """Encode the column ``text`` of every row.

    Returns the columns of ``df`` in a struct ``row`` and: ``ids``;
    ``starts``, ``ends`` (byte offsets into the UTF-8 text); ``ids_le``,
    the ids as little-endian unsigned 32-bit integers; ``spans_le``, each
    piece's start and end as little-endian 32-bit integers; ``decoded``, what
    the library decodes the ids to (NULL without ``decode``).  No shuffle.
    """
    rows, place = packed(df, text)
    schema = StructType([rows.schema["row"], *StructType.fromDDL(CODE).fields])
    return rows.mapInArrow(_coder(path, bos, eos, place, decode), schema)
