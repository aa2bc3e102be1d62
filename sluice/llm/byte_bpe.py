r"""Byte-level BPE by a shuffle of the distinct words of the corpus.

Pre-tokens (the matches of the vocabulary's pattern) are the words.  Exploding
each occurrence with its position would shuffle the corpus many times over, so
occurrences are pre-aggregated in blocks of documents:

1. ``pack``: a task cuts its documents into blocks; a block keeps for each
   pre-token position the number of its word (compressed) and lists its distinct
   words by bucket of the word's hash.
2. ``encode``: the lists are shuffled by bucket, where each distinct word is
   merged once, and its ids go back to the blocks that hold it.
3. ``assemble``: ids join the positions by block, and each document's ids are
   put together in the order of its positions.

Decoding joins the token-byte table (token id, bytes) in step 3: the table has as
many rows as the vocabulary, so every task holds it, and each distinct word's
ids are looked up once a block.

Buckets grow with the words of a partition's share (spark.sql.shuffle.partitions
of them), blocks are bounded by ``block_chars`` or one document.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import keep, ship

#: Characters of a block; a longer document is a block of its own.
BLOCK_CHARS = 32_000_000
#: Words whose ids a Python worker remembers; beyond that it starts anew.
CACHE = 300_000

BLOCKS = ("block string, keys binary, counts binary, positions binary, sizes binary, "
          "parts array<struct<bucket int, words binary>>")
ENCODED = "block string, bucket int, ids binary"
OUT = "doc_id long, ids binary, decoded binary"


def tiktoken_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}


_ENCODINGS: dict[tuple[str, str], object] = {}
_TABLES: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
_IDS: dict[bytes, bytes] = {}
_PATTERNS: dict[str, object] = {}


def encoding(path: str, pattern: str):
    import tiktoken

    if (path, pattern) not in _ENCODINGS:
        _ENCODINGS[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tiktoken_ranks(path), special_tokens={})
    return _ENCODINGS[path, pattern]


def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: (all bytes, start and length by token id)."""
    if path not in _TABLES:
        ranks = tiktoken_ranks(path)
        start, length = np.zeros(max(ranks.values()) + 1, np.int64), np.zeros(max(ranks.values()) + 1, np.int64)
        at = 0
        for piece, i in ranks.items():
            start[i], length[i], at = at, len(piece), at + len(piece)
        _TABLES[path] = np.frombuffer(b"".join(ranks), np.uint8), start, length
    return _TABLES[path]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices flat[start:start + length], one after another."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


#: Where a space that begins a pre-token may have another match: beside white space, or at an end.
_ODD_SPACE = re.compile(r"\s | \s|^ | $")


class Block:
    """Documents of one task whose pre-tokens are numbered together.

    A single space between two other characters always begins a pre-token of the
    usual pattern, so such a text is cut there and equal pieces are matched once.
    """

    def __init__(self, pattern: str):
        import regex

        if pattern not in _PATTERNS:
            _PATTERNS[pattern] = regex.compile(pattern)
        self.find = _PATTERNS[pattern].findall
        #: a pattern that takes one space before a run of letters, numbers or other signs
        self.cut = " ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+" in pattern
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.pieces: dict[str, list[int]] = {}
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.found: list[np.ndarray] = []
        self.chars = 0

    def _numbers(self, piece: str) -> list[int]:
        number = self.number
        return [number.setdefault(w, len(number)) for w in self.find(piece)]

    def add(self, key: int | None, text: str) -> None:
        if self.cut and not _ODD_SPACE.search(text):
            pieces, out = self.pieces, []
            for piece in text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]:
                got = pieces.get(piece)
                if got is None:
                    got = pieces[piece] = self._numbers(piece)
                out += got
        else:
            out = self._numbers(text)
        self.keys.append(key)
        self.counts.append(len(out))
        self.found.append(np.array(out, dtype=np.uint32))
        self.chars += len(text)

    def row(self, block: str, buckets: int) -> dict:
        """The block's row.

        Words are numbered by how often they come (in powers of two, falling), then
        by bucket, then by their bytes: frequent words get small numbers, whose
        upper bytes compress to almost nothing.
        """
        at = np.concatenate(self.found) if self.found else np.zeros(0, np.uint32)
        words = [w.encode() for w in self.number]
        n = len(words)
        spot = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, n)
        rank = np.empty(n, np.int64)
        rank[sorted(range(n), key=words.__getitem__)] = np.arange(n)
        times = np.bincount(at, minlength=n)
        level = np.log2(times.max(initial=1)).astype(np.int64) - np.log2(times).astype(np.int64) if n else rank
        order = np.lexsort((rank, spot, level))
        new = np.empty(n, np.uint32)
        new[order] = np.arange(n, dtype=np.uint32)
        at = new[at]
        sizes = np.zeros((int(level.max(initial=0)) + 1, buckets), "<u4")
        np.add.at(sizes, (level, spot), 1)
        by_bucket: dict[int, list[bytes]] = {}
        for i in np.lexsort((rank, level, spot)).tolist():
            by_bucket.setdefault(int(spot[i]), []).append(words[i])
        planes = b"".join((at >> 8 * k & 255).astype(np.uint8).tobytes() for k in range(4))
        return {"block": block, "keys": zstandard.compress(pack_keys(self.keys)), "counts": np.array(self.counts, "<i8").tobytes(),
                "positions": zstandard.compress(planes, 3), "sizes": zstandard.compress(sizes.tobytes()),
                "parts": [{"bucket": b, "words": pack_words(ws)} for b, ws in sorted(by_bucket.items())]}


def pack_keys(keys: list[int | None]) -> bytes:
    return np.array([k or 0 for k in keys], "<i8").tobytes() + np.array([k is not None for k in keys], np.uint8).tobytes()


def unpack_keys(data: bytes) -> list[int | None]:
    n = len(data) // 9
    return [k if ok else None for k, ok in zip(np.frombuffer(data[:8 * n], "<i8").tolist(), data[8 * n:], strict=True)]


def pack_words(words: list[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], "<u4").tobytes()
    return zstandard.compress(len(words).to_bytes(4, "little") + lengths + b"".join(words), 6)


def unpack_words(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(data[4:4 + 4 * n], "<u4").astype(np.int64))).tolist()
    return [data[a:b] for a, b in zip([4 + 4 * n, *ends[:-1]], ends, strict=True)]


def pack_ids(ids: list[bytes]) -> bytes:
    counts = np.array([len(x) // 4 for x in ids], "<u4").tobytes()
    return zstandard.compress(len(ids).to_bytes(4, "little") + counts + b"".join(ids), 3)


def unpack_ids(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each word)."""
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    return np.frombuffer(data[4 + 4 * n:], "<u4"), np.frombuffer(data[4:4 + 4 * n], "<u4").astype(np.int64)


def _blocks(docs: DataFrame, pattern: str, block_chars: int, buckets: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part, seq = Block(pattern), TaskContext.get().partitionId(), 0
        schema = pa.schema([("block", pa.string()), ("keys", pa.binary()), ("counts", pa.binary()), ("positions", pa.binary()),
                            ("sizes", pa.binary()), ("parts", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())])))])

        def done() -> pa.RecordBatch:
            nonlocal seq
            out = pa.RecordBatch.from_pylist([block.row(f"{part}-{seq}", buckets)], schema=schema)
            block.clear()
            seq += 1
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if block.keys and block.chars + len(text) > block_chars:
                    yield done()
                block.add(key, text)
        if block.keys:
            yield done()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, BLOCKS)


def _encode(lists: DataFrame, path: str, pattern: str) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = encoding(path, pattern)._encode_single_piece
        for batch in batches:
            for block, bucket, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                ids = []
                for w in unpack_words(data.as_py()):
                    got = _IDS.get(w)
                    if got is None:
                        if len(_IDS) >= CACHE:
                            _IDS.clear()
                        got = _IDS[w] = np.array(merge(w), "<u4").tobytes()
                    ids.append(got)
                yield pa.RecordBatch.from_pydict({"block": [block.as_py()], "bucket": pa.array([bucket.as_py()], pa.int32()),
                                                  "ids": [pack_ids(ids)]})

    return lists.mapInArrow(encode, ENCODED)


def _assemble(joined: DataFrame, path: str, buckets: int) -> DataFrame:
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat_bytes, byte_start, byte_length = token_bytes(path)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
        for batch in batches:
            for keys, counts, positions, sizes, parts in zip(*(batch.column(i) for i in range(5)), strict=True):
                got = [unpack_ids(x["ids"]) for x in sorted(parts.as_py() or [], key=lambda x: x["bucket"])]
                ids = np.concatenate([x[0] for x in got]) if got else np.zeros(0, "<u4")
                n_ids = np.concatenate([x[1] for x in got]) if got else np.zeros(0, np.int64)
                start = np.cumsum(n_ids) - n_ids
                # lists are by bucket and level, numbers by level and bucket
                each = np.frombuffer(zstandard.decompress(sizes.as_py()), "<u4").reshape(-1, buckets).astype(np.int64)
                before = (np.cumsum(each.T.reshape(-1)) - each.T.reshape(-1)).reshape(buckets, -1).T
                listed = gather(np.arange(len(n_ids)), before.reshape(-1), each.reshape(-1))
                n_ids, start = n_ids[listed], start[listed]
                # the join with the token-byte table, once for each word of the block
                n_bytes = byte_length[ids]
                raw = gather(flat_bytes, byte_start[ids], n_bytes)
                upto = np.concatenate([[0], np.cumsum(n_bytes)]).astype(np.int64)
                raw_start, raw_n = upto[start], upto[start + n_ids] - upto[start]
                planes = np.frombuffer(zstandard.decompress(positions.as_py()), np.uint8).reshape(4, -1)
                at = sum(planes[k].astype(np.int64) << 8 * k for k in range(4))
                a, rows = 0, []
                for key, n in zip(unpack_keys(zstandard.decompress(keys.as_py())), np.frombuffer(counts.as_py(), "<i8").tolist(), strict=True):
                    w, a = at[a:a + n], a + n
                    rows.append({"doc_id": key, "ids": gather(ids, start[w], n_ids[w]).astype("<u4").tobytes(),
                                 "decoded": gather(raw, raw_start[w], raw_n[w]).tobytes()})
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return joined.mapInArrow(assemble, OUT)


def encode_decode(docs: DataFrame, ranks: str, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids, decoded) of (doc_id, text) rows: ids little-endian unsigned 32-bit, decoded bytes.

    A null text is empty, an empty one has no ids; repeated ids and rows stay as
    they are, a row each; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = keep(_blocks(docs, pattern, block_chars, buckets), "bpe-blocks")
    lists = blocks.select("block", F.explode("parts").alias("p")).select("block", "p.bucket", "p.words").repartition(buckets, "bucket")
    encoded = _encode(lists, ranks, pattern)
    # a block's lists together are as large as its distinct words: bounded by block_chars
    back = encoded.groupBy("block").agg(F.collect_list(F.struct("bucket", "ids")).alias("parts"))
    joined = blocks.select("block", "keys", "counts", "positions", "sizes").join(back, "block", "left")
    return _assemble(joined.select("keys", "counts", "positions", "sizes", "parts"), ranks, buckets)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def token_table(spark: SparkSession, ranks: str) -> DataFrame:
    """The token-byte table as rows (id, bytes)."""
    return spark.createDataFrame([(i, bytearray(b)) for b, i in tiktoken_ranks(ranks).items()], "id int, bytes binary")


def decode(ids: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, decoded) of (doc_id, ids array<int>) rows by a join with the token-byte table.

    Positions and tokens are joined row by row; for ids from elsewhere than
    ``encode_decode``, which decodes on its way.  Ids outside the table raise no
    error: their bytes are left out.
    """
    keyed = ids.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids")
    spots = keyed.select("row", "doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    pieces = spots.join(table, "id", "left").groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.hex(F.coalesce("bytes", F.lit(b""))).alias("hex")))).alias("p"))
    return pieces.select("doc_id", F.unhex(F.array_join(F.col("p.hex"), "")).alias("decoded"))
