"""SentencePiece encoding with source offsets, and decoding."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: The mark for a space, and the replacement for malformed bytes.
SPACE_MARK = "▁".encode()
REPLACEMENT = "�".encode()
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes):
    """Numbers and values of a message in the protocol buffers wire format."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


class Model:
    """What a model file says about normalisation and the byte length of every piece."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = file.read()
        pieces, normalizer, trainer = [], {}, {}
        for number, value in _fields(message):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece.get(1, b""), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.map = CharacterMap(normalizer.get(2, b""))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))
        self.escape = bool(normalizer.get(5, 1))
        self.suffix_space = bool(trainer.get(24, 0))
        if any(kind == USER_DEFINED for _, kind in pieces) or not any(kind == BYTE for _, kind in pieces):
            raise ValueError("offsets need a model with byte fallback and without user-defined pieces")
        sizes = {CONTROL: 0, BYTE: 1}
        self.sizes = np.array([sizes.get(kind, len(piece)) for piece, kind in pieces], np.int64)

    def normalise(self, text: bytes) -> tuple[int, np.ndarray]:
        """Length of the normalised text, and for each of its bytes (and its end) the source byte it comes from.

        At every place the longest prefix in the character map is replaced; where none fits, one character stays as
        it is. Each byte written is recorded with the begin of the prefix that it stands for.
        """
        if not text:
            return 0, np.zeros(1, np.int64)
        space = SPACE_MARK if self.escape else b" "
        if not self.map and not self.squeeze:
            # Nothing is mapped: only spaces change their length.
            data = np.frombuffer(text, np.uint8)
            source = np.repeat(np.arange(len(data)), np.where(data == 32, len(space), 1))
            front, back = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if self.dummy_prefix and self.suffix_space:
                back = np.full(len(space), len(text))
            elif self.dummy_prefix:
                front = np.zeros(len(space), np.int64)
            source = np.concatenate([front, source, back, [len(text)]])
            return len(source) - 1, source
        parts = list(self.map.parts(text))
        if self.squeeze:
            first = next((i for i, (_, _, out) in enumerate(parts) if out != b" "), len(parts))
            parts = parts[first:]
        if not parts:
            return 0, np.zeros(1, np.int64)
        out: list[tuple[bytes, int, int]] = []
        if self.dummy_prefix and not self.suffix_space:
            out.append((space, parts[0][0], parts[0][0]))
        was_space = self.squeeze
        for begin, end, value in parts:
            if self.squeeze and was_space:
                value = value.lstrip(b" ")
            if value:
                was_space = self.squeeze and value.endswith(b" ")
                out.append((value.replace(b" ", space), begin, end))
        while self.squeeze and out and out[-1][0].endswith(space):
            out[-1] = (out[-1][0].removesuffix(space), *out[-1][1:])
            if not out[-1][0]:
                out.pop()
        if self.dummy_prefix and self.suffix_space and out:
            out.append((space, out[-1][2], out[-1][2]))
        source = np.repeat([b for _, b, _ in out], [len(v) for v, _, _ in out]) if out else np.zeros(0, np.int64)
        return len(source), np.append(source, out[-1][2] if out else 0)


class CharacterMap:
    """The compiled character map: a double-array trie over prefixes, whose values point into a pool of strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.pool = blob[4 + size :]

    def __bool__(self):
        return bool(self.units)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix of ``text[at:]`` in the map."""
        if not self.units:
            return None

        def child(unit):
            return (unit >> 10) << ((unit & 0x200) >> 6)

        node, found = child(self.units[0]), None
        for i in range(at, len(text)):
            node ^= text[i]
            unit = self.units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= child(unit)
            if unit & 0x100:
                begin = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.pool[begin : self.pool.index(0, begin)]
        return found

    def parts(self, text: bytes):
        """(begin, end, replacement) over the whole text."""
        at = 0
        while at < len(text):
            found = self.longest(text, at)
            if found is None:
                first = text[at]
                size = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
                found = size, text[at : at + size]
                try:
                    found[1].decode()
                except UnicodeDecodeError:
                    found = 1, REPLACEMENT
            yield at, at + found[0], found[1]
            at += found[0]


def spans(model: Model, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans in ``text`` of the pieces ``ids``: places in the normalised text, projected to the source."""
    length, source = model.normalise(text)
    ends = np.cumsum(model.sizes[ids])
    if len(ends) and ends[-1] != length:
        raise ValueError("pieces and normalised text differ in length")
    begins = ends - model.sizes[ids]
    return source[begins], source[ends]


def _encode(path: str, schema: pa.Schema):
    def run(batches):
        processor, model = sentencepiece.SentencePieceProcessor(model_file=path), Model(path)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part["text"].to_pylist()
                lists = processor.encode(texts, add_bos=False, add_eos=True, num_threads=1)
                decoded = processor.decode(lists, num_threads=1)
                arrays = [np.array(x, np.int32) for x in lists]
                ends = np.cumsum([0, *map(len, arrays)])
                found = [spans(model, t.encode(), x) for t, x in zip(texts, arrays, strict=True)]
                columns = [arrays, [a for a, _ in found], [b for _, b in found]]
                listed = [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(c).astype(np.int32)))
                    for c in columns
                ]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *listed, pa.array(decoded)], schema=schema)

    return run


def encode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``ids`` (an end id last), ``begins`` and ``ends`` (bytes of the UTF-8 text), ``decoded``.

    Ids are those of the sentencepiece library. Offsets come from a normalisation of our own, which replaces the longest
    prefixes in the model's compiled character map and records for every byte it writes where it comes from; piece
    lengths over the normalised text are then projected to the source. A piece that stands for nothing in the source
    (an added leading space, the end id) has an empty span. Null text counts as empty (the end id only); rows are
    independent of each other; other columns are ignored.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("ids", pa.list_(pa.int32())),
            ("begins", pa.list_(pa.int32())),
            ("ends", pa.list_(pa.int32())),
            ("decoded", pa.string()),
        ]
    )
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    out = rows.mapInArrow(
        _encode(model, schema), "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"
    )
    return out.withColumnRenamed("doc_id", id_col)
