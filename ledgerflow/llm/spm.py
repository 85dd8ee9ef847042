"""SentencePiece encoding and decoding with source offsets.

The model file is read here as far as normalisation needs it: the compiled
character map (a double-array trie of source prefixes, each leading to its
replacement) and the white space settings.  :class:`Normaliser` applies the map
by longest prefix and records, for every byte it emits, the byte of the source
text it came from.  The sentencepiece library segments the text into pieces, and
every piece is laid over the normalised bytes it covers and projected through
the alignment to a byte span of the original text; pieces that do not cover the
normalised text exactly are an error, so the two normalisations check each other.
(Remembering the ids of frequent words was measured and is slower than the
library on texts with a large vocabulary: 1.45 against 2.67 MB/s on one core.)

Defined results: a null text counts as an empty one and has no ids; texts of
any length are encoded whole; repeated rows are encoded each; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_rows, setup

MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """``(field number, value)`` of a protocol buffer message."""
    def varint(i):
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i:i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = data[i:i + n], i + n
        yield tag >> 3, value


@dataclass(frozen=True)
class NormaliserSpec:
    """Fields of the model's normaliser: the compiled map and the white space settings."""

    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @classmethod
    def parse(cls, message: bytes) -> NormaliserSpec:
        got = dict(_fields(message))
        return cls(got.get(2, b""), bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1)))


class CharacterMap:
    """A compiled character map: a 32-bit size, a double-array trie of that many
    bytes, and the replacements, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.replacements = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.replacements = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped prefix of ``data[at:]``.

        A unit holds the label in its low byte (bit 31 marks a value), the offset
        to its children in bits 10 and up (times 256 if bit 9 is set), and in bit 8
        whether one of the children is a value."""
        units = self.units
        if not units:
            return None
        node, found = self._offset(units[0]), None
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            if node >= len(units) or units[node] & 0x800000FF != byte:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if not found:
            return None
        start = found[1]
        return found[0], self.replacements[start:self.replacements.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Longest-prefix normalisation that remembers where each byte came from."""

    def __init__(self, spec: NormaliserSpec):
        self.spec, self.map = spec, CharacterMap(spec.charsmap)
        self.space = MARK.encode() if spec.escape_whitespaces else b" "

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and, for each of them and for the end, its place in the UTF-8 source."""
        data = text.encode("utf-8", "replace")
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.spec.remove_extra_whitespaces:
            return self._spaces_only(data)
        out, come = bytearray(), []
        for at, length, new in self._chunks(data):
            if new:
                out += new
                come += [at] * len(new)
        out, come = bytes(out), np.array(come + [len(data)], dtype=np.int64)
        return self._escaped(out, come, len(data))

    def _spaces_only(self, data: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        wide = np.where(raw == 32, len(self.space), 1)
        come = np.repeat(np.arange(len(raw)), wide)
        out = data.replace(b" ", self.space)
        if self.spec.add_dummy_prefix:
            out, come = self.space + out, np.concatenate([np.zeros(len(self.space), np.int64), come])
        return out, np.append(come, len(data))

    def _chunks(self, data: bytes):
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit:
                length, new = hit
            else:
                first = data[at]
                length = 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                new = data[at:at + length]
            yield at, length, new
            at += length

    def _escaped(self, out: bytes, come: np.ndarray, end: int) -> tuple[bytes, np.ndarray]:
        """Trim and collapse spaces if asked for, add the prefix, and escape."""
        keep = np.frombuffer(out, np.uint8).copy()
        place = np.arange(len(keep))
        if self.spec.remove_extra_whitespaces:
            space = keep == 32
            solid = np.flatnonzero(~space)
            if not len(solid):
                return b"", np.array([end])
            good = ~(space & np.concatenate([[True], space[:-1]]))
            good[solid[-1] + 1:] = False
            place = place[good]
        keep, from_ = keep[place], come[place]
        wide = np.where(keep == 32, len(self.space), 1)
        res = keep.tobytes().replace(b" ", self.space)
        come2 = np.repeat(from_, wide)
        if self.spec.add_dummy_prefix and len(res):
            res = self.space + res
            come2 = np.concatenate([np.full(len(self.space), from_[0]), come2])
        tail = come[place[-1] + 1] if len(place) else end
        return res, np.append(come2, tail)


class SpanEncoder:
    """Encodes texts to ids and byte spans, and decodes ids."""

    def __init__(self, model_file: str):
        import sentencepiece

        with open(model_file, "rb") as f:
            parts = list(_fields(f.read()))
        spec = [v for k, v in parts if k == 3]
        self.spec = NormaliserSpec.parse(spec[0]) if spec else NormaliserSpec()
        self.normaliser = Normaliser(self.spec)
        self.lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = self.lib.get_piece_size()
        pieces = [self.lib.id_to_piece(i) for i in range(n)]
        self.width = np.array([1 if self.lib.is_byte(i) else len(p.encode()) for i, p in enumerate(pieces)])

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text, without begin or end marks."""
        return self.lib.encode([t or "" for t in texts], num_threads=1) if texts else []

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0]

    def spans_batch(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text its ids and, for every piece, the first and the end byte of the UTF-8 source it stands for."""
        out = []
        for text, ids in zip(texts, self.encode_batch(texts)):
            ids = np.array(ids, dtype=np.int32)
            norm, come = self.normaliser(text or "")
            ends = np.cumsum(self.width[ids])
            if (ends[-1] if len(ids) else 0) != len(norm):
                raise ValueError("pieces do not cover the normalised text")
            out.append((ids, come[ends - self.width[ids]].astype(np.int32), come[ends].astype(np.int32)))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(id, first byte, end byte)`` of every piece of one text."""
        return list(zip(*(x.tolist() for x in self.spans_batch([text])[0])))

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        return self.lib.decode(ids, num_threads=1) if ids else []


@functools.lru_cache(maxsize=2)
def encoder(model_file: str) -> SpanEncoder:
    """One encoder per Python worker and model."""
    return SpanEncoder(model_file)


def encode_documents(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, begins, ends, decoded)`` of every document: the ids, the byte
    span of every piece in the UTF-8 source, and the text decoded from the ids.

    ``model_file`` must name the model on every executor."""
    def build(rows, spans, texts):
        return {"ids": [x[0] for x in spans], "begins": [x[1] for x in spans], "ends": [x[2] for x in spans], "decoded": texts}

    return _encoded(docs, model_file, id_col, text_col, build,
                    "ids array<int>, begins array<int>, ends array<int>, decoded string")


def encode_digests(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256)`` and, if asked
    for, the ids: the digests of :func:`encode_documents`' columns, taken where the
    text is encoded so that only they leave the task."""
    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def build(rows, spans, texts):
        return {"n_tokens": [len(x[0]) for x in spans],
                "ids_sha256": [sha(",".join(map(str, x[0].tolist())).encode()) for x in spans],
                "decoded_sha256": [sha(x.encode()) for x in texts],
                "spans_sha256": [sha(x[1].tobytes() + x[2].tobytes()) for x in spans],
                "ids": [x[0] for x in spans]}

    return _encoded(docs, model_file, id_col, text_col, build, "n_tokens long, ids_sha256 string, decoded_sha256 string, "
                    "spans_sha256 string" + ", ids array<int>" * keep_ids)


def _encoded(docs: DataFrame, model_file: str | None, id_col: str, text_col: str, build, schema: str) -> DataFrame:
    setup(docs.sparkSession)
    path = model_file or default_model()

    def run(rows):
        enc = encoder(path)
        spans = enc.spans_batch(rows["text"])
        return {"doc_id": rows["doc_id"]} | build(rows, spans, enc.decode_batch([x[0].tolist() for x in spans]))

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id long, {schema}")
