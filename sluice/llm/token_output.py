"""Token-id files with Elias-Fano document boundaries.

A shard holds the ids of its documents one after another in the narrowest of
two or four bytes, and the ends of the documents as an Elias-Fano sequence:
``l`` low bits of each end are packed, the high parts are set bits of a bitmap
at ``(end >> l) + rank``.  ``select`` finds the i-th set bit from a sampled
position, so an offset needs a few words of the bitmap and no 64-bit table.

Shard layout (little endian): magic, u32 header length, JSON header, then the
sections the header lists (ids, low, high, samples, keys, valid).
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import keep, open_folder, shared_folder, ship

MAGIC = b"EFIDS01\n"
END_ID = 2
#: Ids of a shard, at which the next one begins (a longer document has a shard to itself).
SHARD_IDS = 8_000_000
#: Set bits between two sampled positions of the bitmap.
SAMPLE = 256
#: Chunks whose ids a Python worker remembers; beyond that it starts anew.
CACHE = 1_000_000

MANIFEST = "path string, part int, seq int, n_docs long, n_tokens long"
INDEX = "name string, doc_id long, rel_start long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A non-decreasing sequence of n numbers up to u in about n * (2 + log2(u / n)) bits."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bits, self.low, self.high, self.samples = n, bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.int64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, int(math.log2(top / n))) if n and top > n else 0
        at = (v >> bits) + np.arange(n)
        ones = np.zeros((int(at[-1]) if n else 0) + 1, dtype=np.uint8)
        ones[at] = 1
        low = ((v[:, None] >> np.arange(bits)) & 1).astype(np.uint8) if bits else np.zeros((n, 0), np.uint8)
        return cls(n, bits, np.packbits(low.reshape(-1), bitorder="little"),
                   np.packbits(ones, bitorder="little"), at[::SAMPLE].astype(np.uint32))

    def _low(self, i: int) -> int:
        first, last = i * self.bits, (i + 1) * self.bits
        piece = int.from_bytes(self.low[first // 8:(last + 7) // 8].tobytes(), "little")
        return (piece >> (first % 8)) & ((1 << self.bits) - 1)

    def select(self, i: int) -> int:
        """The i-th number: from the sampled set bit before it, byte by byte to its own."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, mask = at // 8, 0xFF << (at % 8) & 0xFF
        while (here := int(self.high[byte]) & mask).bit_count() <= left:
            left -= here.bit_count()
            byte, mask = byte + 1, 0xFF
        for _ in range(left):
            here &= here - 1
        at = byte * 8 + (here & -here).bit_length() - 1
        return (at - i) << self.bits | self._low(i)

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        v = (at - np.arange(self.n)) << self.bits
        if self.bits:
            low = np.unpackbits(self.low, bitorder="little")[:self.n * self.bits].reshape(self.n, self.bits)
            v = v | (low.astype(np.int64) << np.arange(self.bits)).sum(axis=1)
        return v


def shard_bytes(ids: list[bytes], width: int, keys: list[int | None]) -> bytes:
    """The file of documents whose ids come as little-endian numbers of ``width`` bytes."""
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    ef = EliasFano.encode(ends)
    parts = {"ids": b"".join(ids), "low": ef.low.tobytes(), "high": ef.high.tobytes(),
             "samples": ef.samples.astype("<u4").tobytes(),
             "keys": np.array([k or 0 for k in keys], dtype="<i8").tobytes(),
             "valid": np.array([k is not None for k in keys], dtype=np.uint8).tobytes()}
    head = json.dumps({"n": ef.n, "bits": ef.bits, "width": width,
                       "sections": [[k, len(v)] for k, v in parts.items()]}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(parts.values())


def read_shard(data: bytes) -> tuple[np.ndarray, EliasFano, list[int | None]]:
    """(ids, ends, keys) of a shard."""
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a shard of token ids")
    at = len(MAGIC) + 4
    size = struct.unpack("<I", data[len(MAGIC):at])[0]
    head = json.loads(data[at:at + size])
    at += size
    got = {}
    for name, size in head["sections"]:
        got[name] = data[at:at + size]
        at += size
    u8 = lambda name: np.frombuffer(got[name], dtype=np.uint8)
    ef = EliasFano(head["n"], head["bits"], u8("low"), u8("high"), np.frombuffer(got["samples"], dtype="<u4"))
    keys = [k if ok else None for k, ok in zip(np.frombuffer(got["keys"], dtype="<i8").tolist(), u8("valid"), strict=True)]
    return np.frombuffer(got["ids"], dtype=f"<u{head['width']}"), ef, keys


class ChunkEncoder:
    """Ids of whole texts by a vocabulary whose tokens never span white space.

    A text is cut at white space and each distinct chunk is encoded once.  A
    chunk of plain Latin letters with ASCII marks behind (no apostrophe) goes straight to the
    merges (lower case, its bytes as the vocabulary writes them); any other
    chunk, and any text in which Python and the library disagree on white space,
    goes through the whole tokenizer.
    """

    PLAIN = re.compile(r'([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)')
    ODD = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        model = json.loads(self.whole.to_str())
        self.plain = model["model"]["type"] == "BPE" and model["model"]["end_of_word_suffix"] == "</w>" and "Lowercase" in str(model["normalizer"])
        # bytes over 0xA0 stand for themselves, those of 0x80..0xA0 and 0xAD are moved up behind 0xFF
        moved = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
        sign = {b: chr(256 + moved.index(b)) if b in moved else chr(b) for b in range(256)}
        self.signs = {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            got = self.words[word] = self._pack([t.id for t in self.whole.model.tokenize(word.translate(self.signs))])
        return got

    def _whole(self, text: str) -> bytes:
        return self._pack(self.whole.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> bytes:
        m = self.PLAIN.fullmatch(chunk) if self.plain else None
        if len(self.chunks) >= CACHE:
            self.chunks.clear()
        got = self.chunks[chunk] = self._whole(chunk) if m is None else self._word(m[1].lower()) + (self._word(m[2]) if m[2] else b"")
        return got

    def __call__(self, text: str) -> bytes:
        if not self.plain or self.ODD.search(text):
            return self._whole(text)
        get, chunk = self.chunks.get, self._chunk
        return b"".join([get(c) or chunk(c) for c in text.split()])


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One for each Python worker, which keeps it over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def write_token_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = END_ID,
                       shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``text`` of (doc_id, text) rows into shards in ascending doc_id; returns the manifest.

    The rows are range partitioned and sorted by doc_id, so the shards of one
    partition after those of the one before hold the whole corpus in order.  A
    task's files have names of their own and count only if the manifest, which
    Spark commits, lists them; a repeated or lost attempt leaves files that
    nothing reads.  Null ids come first; a null text is empty; rows with the
    same id are ordered by text.  Other columns are ignored.
    """
    ship(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = b"" if end_id is None else int(end_id).to_bytes(encode.width, "little")
        store = path = None
        ids, keys, size, seq = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal store, path, ids, keys, size, seq
            if store is None:
                store, path = open_folder(folder)
            name = f"ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.efids"
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(shard_bytes(ids, encode.width, keys))
            row = {"path": [name], "part": [part], "seq": [seq], "n_docs": [len(keys)], "n_tokens": [size]}
            ids, keys, size, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(
                [("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = encode(text.as_py() or "") + end
                if ids and size + len(got) // encode.width > shard_ids:
                    yield flush()
                ids.append(got)
                keys.append(key)
                size += len(got) // encode.width
        if ids:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return keep(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_shards(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files alone.

    ``start`` counts the ids of all documents before; the crc is over the ids as
    unsigned 32-bit little-endian numbers.
    """
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1), strict=True):
                ids, ef, keys = read_shard(data.as_py())
                ends = ef.all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "name": [os.path.basename(path.as_py())] * len(keys), "doc_id": pa.array(keys, pa.int64()),
                    "rel_start": starts, "n_tokens": ends - starts, "ids_crc32": pa.array(crc, pa.int64())})

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # a row a shard: as many as the corpus has ids / SHARD_IDS
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select(F.col("path").alias("name"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.efids").load(folder).select("path", "content")
    return (files.mapInArrow(read, INDEX).join(bases, "name")
            .select("doc_id", (F.col("base") + F.col("rel_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_shards(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards to the shared scratch folder and return what they hold for each document."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    return read_token_shards(spark, folder, write_token_shards(docs, tokenizer, folder, end_id, shard_ids))
