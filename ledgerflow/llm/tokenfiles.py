"""Token-id files: independent zstandard frames with a trailing seek table.

Layout of a file (a *shard*), readable by any zstandard program:

* data frames.  Every document begins a frame of its own and fills as many
  frames of at most ``FRAME_IDS`` ids as it needs; a frame is compressed alone, so a
  reader decompresses the frames of the documents it wants and no other;
* one skippable frame with the document index: the ids' width in bytes, and
  per document its id and its number of token ids;
* the seek table of the zstandard seekable format: compressed size,
  decompressed size and checksum (low half of XXH64 over the decompressed
  bytes) of every frame, the index being the last entry, with size 0.

Ids are little-endian unsigned integers of 2 bytes if the vocabulary allows it,
else 4.  Documents stand in ascending order of their id over all shards, whose names
sort in that order; null ids come last, rows of one id are ordered by a hash of their
ids.

How it runs.  Documents are encoded once, where they are read, and written as
compressed frames.  These are range-partitioned by (id, hash, row number), so that
an id with a large share of all rows is split like any other range, sorted
within partitions, and packed into shards of at most ``SHARD_IDS`` ids (a longer
document is a shard of its own); a task holds one shard in memory.  The shards
leave through Spark's text writer, one row a file, and hence through its commit
protocol: retried and speculative tasks leave one copy, on any file system that
Spark writes to.  That writer ends each row with its line separator, for which the
last four bytes of the format, its magic number, are given.  Files are read with
the ``binaryFile`` source.

Encoding.  A tokenizer that drops white space between pre-tokens gives a text the
ids of its words, one after the other; a word is encoded once by the library's model, and the
last ``MEMO_WORDS`` (to twice as many) words are remembered.  Texts are cut at white space
into segments of bounded length.  In a segment of Latin letters and ASCII a word's
pre-tokens are found by the tokenizer's own pattern; in others by the library's
normaliser and pre-tokenizer.  ``word_wise`` says whether a tokenizer's
description is of that kind; others encode whole texts.

Defined results: a null or empty text holds the end id alone; repeated rows are
documents of their own; an empty table gives no file and reads back as an empty
table; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_rows, setup, shared_table

END_ID = 2
FRAME_IDS = 1 << 16
SHARD_IDS = 1 << 24
LEVEL = 3
MEMO_WORDS = 1 << 18
MEMO_PIECES = 1 << 17
LONG_WORD = 256
#: Characters handled at once, and then up to the next white space.
SEGMENT = 1 << 16

# Fixed values of the zstandard seekable format.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
WITH_CHECKSUMS = 0x80
ENTRY = np.dtype([("size", "<u4"), ("raw", "<u4"), ("sum", "<u4")])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- encoding


def word_wise(description: dict) -> bool:
    """Whether the ids of a text are those of its words (split at ASCII white space),
    one after the other: normalisers that look at no white space but to collapse it, a
    splitting pattern whose matches hold none, and added tokens without any."""
    import regex

    def parts(x, key):
        return [] if x is None else x[key] if x["type"] == "Sequence" else [x]

    for n in parts(description.get("normalizer"), "normalizers"):
        if n["type"] == "Replace":
            if n["pattern"] != {"Regex": "\\s+"} or n["content"] != " ":
                return False
        elif n["type"] not in ("NFC", "Lowercase"):
            return False
    pre = parts(description.get("pre_tokenizer"), "pretokenizers")
    if not pre or pre[0]["type"] != "Split" or pre[0]["behavior"] != "Removed" or not pre[0]["invert"]:
        return False
    if any(p["type"] != "ByteLevel" or p["add_prefix_space"] or p["use_regex"] for p in pre[1:]):
        return False
    probe = "a b\tc\nd\re\x0bf\x0cg' s 1 2 . , 'll\n\n--  !"
    found = regex.findall(pre[0]["pattern"].get("Regex", " "), probe)
    if any(any(c in " \t\n\r\x0b\x0c" for c in m) for m in found):
        return False
    return not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]]
                   for t in description.get("added_tokens", []))


class Memo(dict):
    """Remembers what ``make`` gives for a key: the last ``most`` keys at least, twice as many at most."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= LONG_WORD:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got


class IdEncoder:
    """Texts to token ids as little-endian bytes, ``width`` bytes an id."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(tokenizer_file)
        with open(tokenizer_file, encoding="utf-8") as f:
            description = json.load(f)
        self.by_word = word_wise(description)
        self.width = 2 if self.lib.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.packers = [struct.Struct(f"<{n}{'H' if self.width == 2 else 'I'}").pack for n in range(64)]
        if self.by_word:
            self.added = [t["content"] for t in description.get("added_tokens", [])]
            self.lower = '"Lowercase"' in json.dumps(description["normalizer"])
            pre = description["pre_tokenizer"]
            pattern = pre.get("pretokenizers", [pre])[0]["pattern"]["Regex"]
            self.pattern = regex.compile(pattern)
            # Letters match as a whole if nothing but endings after an apostrophe comes before them.
            self.letters_whole = re.match(r"(?:'\w+\|)*(?:\[\\p\{L\}\]|\\p\{L\})\+(?:\||$)", pattern) is not None
            # Characters whose case, category and composition no Unicode version has changed.
            self.plain = re.compile(r"[\t-\r\x20-\x7e\xa1-\u012f\u0131-\u017f]*")
            self.break_ = re.compile(r"[\t-\r\x20]")
            self.normaliser, self.cutter, self.model = self.lib.normalizer, self.lib.pre_tokenizer, self.lib.model
            byte_level = [p for p in pre.get("pretokenizers", [pre]) if p["type"] == "ByteLevel"]
            shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.alphabet = {c: shown(chr(c))[0][0] for c in range(0xA1, 0x180)} if byte_level else {}
            self.piece_ids, self.plain_ids = Memo(self._piece, MEMO_PIECES), Memo(self._plain_word, MEMO_WORDS)
            self.word_ids = Memo(self._word, MEMO_WORDS)

    def _bytes(self, ids: list[int]) -> bytes:
        return self.packers[len(ids)](*ids) if len(ids) < 64 else np.array(ids, dtype=self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        cut = piece if piece.isascii() else piece.translate(self.alphabet)
        return self._bytes([t.id for t in self.model.tokenize(cut)])

    def _plain_word(self, word: str) -> bytes:
        low = word.lower() if self.lower else word
        if self.letters_whole and low.isalpha():  # remembered once, as the word it is
            return self._piece(low) if low == word else self.plain_ids[low]
        return b"".join([self.plain_ids[p] if self.letters_whole and p.isalpha() else self.piece_ids[p] for p in self.pattern.findall(low)])

    def _word(self, word: str) -> bytes:
        text = self.normaliser.normalize_str(word) if self.normaliser else word
        return self._bytes([t.id for p, _ in self.cutter.pre_tokenize_str(text) for t in self.model.tokenize(p)])

    def _segments(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = self.break_.search(text, at + SEGMENT)
            end = end.end() if end else len(text)
            yield text[at:end]
            at = end

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word or any(a in text for a in self.added):
            return self._bytes(self.lib.encode(text, add_special_tokens=False).ids)
        out = []
        for part in self._segments(text):
            if self.plain.fullmatch(part):
                out += map(self.plain_ids.__getitem__, part.split())
            else:
                out += map(self.word_ids.__getitem__, self.break_.split(part))
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> IdEncoder:
    """One encoder per Python worker and tokenizer."""
    return IdEncoder(tokenizer_file)


@functools.cache
def packer() -> zstandard.ZstdCompressor:
    """One compressor per Python worker; every call of it makes an independent frame."""
    return zstandard.ZstdCompressor(level=LEVEL)


@functools.cache
def unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def frames_of(ids: bytes, width: int) -> tuple[bytes, list[int], list[int]]:
    """The ids as frames of at most ``FRAME_IDS`` ids: their bytes, sizes and checksums."""
    step = FRAME_IDS * width
    raw = [ids[at:at + step] for at in range(0, len(ids), step)]
    frames = [packer().compress(x) for x in raw]
    return b"".join(frames), [len(x) for x in frames], [xxhash.xxh64_intdigest(x) & 0xFFFFFFFF for x in raw]


FRAMED = "doc_id long, n_tokens long, width int, tie long, frames binary, sizes array<int>, sums array<long>"


def framed_documents(docs: DataFrame, tokenizer_file: str | None = None, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document as compressed frames of its token ids, the end id appended."""
    setup(docs.sparkSession)
    path = tokenizer_file or default_tokenizer()

    def run(rows):
        enc = encoder(path)
        end = np.array([end_id], dtype=enc.kind).tobytes()
        out = {"doc_id": rows["doc_id"], "width": [enc.width] * len(rows["text"]),
               **{c: [] for c in ("n_tokens", "tie", "frames", "sizes", "sums")}}
        for t in rows["text"]:
            ids = enc.encode(t) + end
            out["n_tokens"].append(len(ids) // enc.width)
            out["tie"].append(xxhash.xxh64_intdigest(ids) - (1 << 63))
            for c, v in zip(("frames", "sizes", "sums"), frames_of(ids, enc.width)):
                out[c].append(v)
        return out

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, FRAMED)


# ---------------------------------------------------------------- files


def shard_bytes(ids: list[int | None], n_tokens: list[int], width: int, frames: list[bytes], sizes: list[int], sums: list[int]) -> bytes:
    """A whole file but its last four bytes (``SEEKABLE_MAGIC``)."""
    index = packer().compress(b"".join([
        struct.pack("<BQ", width, len(ids)), np.array([i is None for i in ids], dtype=np.uint8).tobytes(),
        np.array([i or 0 for i in ids], dtype="<i8").tobytes(), np.array(n_tokens, dtype="<u8").tobytes()]))
    index = struct.pack("<II", SKIPPABLE, len(index)) + index
    table = np.zeros(len(sizes) + 1, dtype=ENTRY)
    table["size"][:-1], table["sum"][:-1] = sizes, sums
    table["size"][-1] = len(index)
    left = np.array(n_tokens, dtype=np.int64)
    count = -(-left // FRAME_IDS)
    first = np.cumsum(count) - count
    raw = np.full(len(sizes), FRAME_IDS * width, dtype=np.int64)
    raw[first + count - 1] = (left - (count - 1) * FRAME_IDS) * width
    table["raw"][:-1] = raw
    seek = table.tobytes() + struct.pack("<IB", len(table), WITH_CHECKSUMS)
    return b"".join([*frames, index, struct.pack("<II", SEEK_TABLE, len(seek) + len(SEEKABLE_MAGIC)), seek])


def _packed(batches: Iterator[pa.RecordBatch], shard_ids: int) -> Iterator[pa.RecordBatch]:
    part, shards, held = TaskContext.get().partitionId(), 0, 0
    rows: list[tuple] = []

    def flush():
        ids, n, width, frames, sizes, sums = zip(*rows)
        data = shard_bytes(list(ids), list(n), width[0], list(frames), [x for s in sizes for x in s], [x for s in sums for x in s])
        return pa.RecordBatch.from_arrays([pa.array([f"s{part:07d}_{shards:05d}"]), pa.array([data], type=pa.binary())], names=["shard", "data"])

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            piece = batch.slice(at, 64)
            for row in zip(*(piece.column(i).to_pylist() for i in range(piece.num_columns))):
                if rows and held + row[1] > shard_ids:
                    yield flush()
                    rows, held, shards = [], 0, shards + 1
                rows.append(row)
                held += row[1]
    if rows:
        yield flush()


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write the token ids of all documents below ``path``, ``shard=<name>/`` by shard."""
    framed = framed_documents(docs, tokenizer_file, end_id, id_col, text_col)
    framed = shared_table(framed.withColumn("row", F.monotonically_increasing_id()), "framed")
    total = framed.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("row")]
    ranged = framed.repartitionByRange(max(1, -(-total // shard_ids)), *order).sortWithinPartitions(*order)
    shards = ranged.select("doc_id", "n_tokens", "width", "frames", "sizes", "sums").mapInArrow(
        lambda batches: _packed(batches, shard_ids), "shard string, data binary")
    shards.select("shard", F.col("data").cast("string").alias("value")).write.partitionBy("shard").option(
        "encoding", "ISO-8859-1").text(path, lineSep=SEEKABLE_MAGIC.decode("latin-1"))


class Shard:
    """Reader of one file's bytes; nothing is decompressed but the index until asked for."""

    def __init__(self, data: bytes):
        if data[-4:] != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end of the file")
        count, _ = struct.unpack("<IB", data[-9:-4])
        start = len(data) - 9 - count * ENTRY.itemsize
        self.data, self.entries = memoryview(data), np.frombuffer(data, dtype=ENTRY, count=count, offset=start)
        self.offsets = np.cumsum(self.entries["size"].astype(np.int64)) - self.entries["size"]
        at = int(self.offsets[-1])
        index = unpacker().decompress(self.data[at + 8:start - 8])
        self.width, n = struct.unpack_from("<BQ", index)
        missing = np.frombuffer(index, np.uint8, n, 9).astype(bool)
        ids = np.frombuffer(index, "<i8", n, 9 + n)
        self.ids = [None if m else int(i) for i, m in zip(ids, missing)]
        self.n_tokens = np.frombuffer(index, "<u8", n, 9 + 9 * n).astype(np.int64)
        frames = -(-self.n_tokens // FRAME_IDS)
        self.first, self.end = np.cumsum(frames) - frames, np.cumsum(frames)
        self.starts = np.cumsum(self.n_tokens) - self.n_tokens

    def frame(self, k: int) -> bytes:
        at, size = int(self.offsets[k]), int(self.entries["size"][k])
        raw = unpacker().decompress(self.data[at:at + size], max_output_size=int(self.entries["raw"][k]))
        if len(raw) != self.entries["raw"][k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries["sum"][k]:
            raise ValueError(f"frame {k} does not match its entry in the seek table")
        return raw

    def document(self, at: int) -> np.ndarray:
        """Ids of the document in place ``at``, from its own frames."""
        raw = b"".join(self.frame(k) for k in range(int(self.first[at]), int(self.end[at])))
        return np.frombuffer(raw, dtype=f"<u{self.width}")


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, content)`` of every file below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"shard=([^/]+)/", 1).alias("shard"), "content")


def _from_shards(files: DataFrame, schema: str, one) -> DataFrame:
    """``one(shard, places or None)`` yields batches of columns, for every file."""
    setup(files.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                shard = Shard(row["content"])
                for columns in one(row["shard"], shard, row.get("places")):
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return files.mapInArrow(run, out)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(shard, place, doc_id, n_tokens, start)`` of every document, ``start`` being the ids
    before it in its file; no data frame is decompressed."""
    def one(name, shard, _):
        n = len(shard.ids)
        yield {"shard": [name] * n, "place": range(n), "doc_id": shard.ids, "n_tokens": shard.n_tokens, "start": shard.starts}

    return _from_shards(token_files(spark, path), "shard string, place long, doc_id long, n_tokens long, start long", one)


def read_tokens(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """``(doc_id, ids)`` of all documents, or of those whose ``doc_id`` stands in ``wanted``:
    then only files with such a document are opened and only their frames decompressed."""
    files = token_files(spark, path)
    if wanted is not None:
        index = token_index(spark, path).join(wanted.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi")
        places = index.groupBy("shard").agg(F.sort_array(F.collect_list("place")).alias("places"))
        files = files.join(places, "shard")

    def one(_, shard, places):
        places = range(len(shard.ids)) if places is None else places
        for at in range(0, len(places), 64):
            some = places[at:at + 64]
            yield {"doc_id": [shard.ids[p] for p in some], "ids": [shard.document(p).astype(np.int64) for p in some]}

    return _from_shards(files, "doc_id long, ids array<long>", one)


def stored_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files:
    ids of all documents before it, its own ids, and the CRC-32 of them as
    little-endian unsigned 32-bit integers."""
    def one(name, shard, _):
        n = len(shard.ids)
        yield {"shard": [name] * n, "doc_id": shard.ids, "local": shard.starts, "n_tokens": shard.n_tokens,
               "ids_crc32": [zlib.crc32(shard.document(i).astype("<u4").tobytes()) for i in range(n)]}

    got = shared_table(_from_shards(token_files(spark, path), "shard string, doc_id long, local long, n_tokens long, ids_crc32 long", one), "read-back")
    # One row per file: its ids, and those of all files before it.
    sums = got.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = sums.select("shard", (F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("ids")).alias("before"))
    return got.join(before, "shard").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
