"""Prefix trie of conversations, from the longest common prefixes of sorted neighbours.

Distinct conversations, as sequences of turn hashes, are sorted and dealt out by
range.  In each partition a union-find takes the edges between sorted neighbours
in descending depth of their common prefix: the components that an edge joins
meet in the branching node of that depth, and the chain of nodes below it is
closed.  Only prefixes of a partition's first and last conversation can go on
beyond it; these two paths are what is left of its forest, and hold what has been
counted below them.  The paths of neighbouring partitions are merged by the same
union-find, GROUP partitions at a time, until one forest remains.  Turns are told
apart by 64-bit hashes of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import crc32_of, few, keep, ship

#: Partitions whose forests are merged in one task.
GROUP = 64
#: Ids of a conversation's copies that are joined to one text.
CHUNK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()

PATH = "path array<long>, chars array<long>, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
NODE = "node long, parent_node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
FOREST = f"pid int, side int, {NODE}, {PATH}"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in FOREST.split(", ")])


@dataclass
class Path:
    """A sequence of turns, and at each depth what has been counted there, without the path's own node below."""

    turns: list[int]
    chars: list[int]
    n: list[int]
    least: list[int | None]
    kids: list[int]
    leaves: list[int]
    saved: list[int]
    ends: list[str | None]
    many: bool = True  # not only at the last depth

    @staticmethod
    def empty(turns: list[int], chars: list[int]) -> Path:
        k = len(turns) + 1
        return Path(turns, chars, [0] * k, [None] * k, [0] * k, [0] * k, [0] * k, [None] * k)

    @staticmethod
    def of(turns: list[int], chars: list[int], n: int, least: int, ends: str) -> Path:
        p = Path.empty(turns, chars)
        p.n[-1], p.least[-1], p.ends[-1], p.many = n, least, ends, False
        return p


@dataclass
class Part:
    """A component: neighbouring paths, and the node at which they have met so far."""

    lo: int
    hi: int
    depth: int
    n: int
    least: int
    kids: int
    leaves: int
    saved: int
    ends: str | None
    inner: int = 0                                       # members that a path's node below has
    rows: list[int] = field(default_factory=list)        # closed children, to be told of their parent
    paths: list[int] = field(default_factory=list)       # that have counts at lower depths


def common(a: list[int], b: list[int]) -> int:
    most = min(len(a), len(b))
    return next((i for i in range(most) if a[i] != b[i]), most)


def names(turns: list[int]) -> list[int]:
    """Of each prefix of a sequence."""
    h = xxhash.xxh3_64()
    out = [h.intdigest() - (1 << 63)]
    for x in np.array(turns, np.int64):
        h.update(x.tobytes())
        out.append(h.intdigest() - (1 << 63))
    return out


def least_of(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def forest(paths: list[Path], whole: bool) -> tuple[list[list], list[Path]]:
    """Nodes that are closed, as rows of NODE, and the paths that stay open (none if ``whole``), of sorted paths."""
    if not paths:
        return [], []
    last, rows = len(paths) - 1, []
    left, right = (Path.empty(paths[i].turns, paths[i].chars) for i in (0, last))
    used = {0: False, 1: False}
    parts = [Part(i, i, len(p.turns), p.n[-1], p.least[-1], p.kids[-1], p.leaves[-1], p.saved[-1], p.ends[-1], paths=[i] if p.many else [])
             for i, p in enumerate(paths)]
    above, known = list(range(len(paths))), {}

    def name(i: int, depth: int) -> int:
        if i not in known:
            known[i] = names(paths[i].turns)
        return known[i][depth]

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    def lift(p: Part, depth: int) -> None:
        """Close the component's nodes below ``depth``."""
        some = paths[p.lo]
        while p.depth > depth:
            d, opened = p.depth, not whole and (p.lo == 0 or p.hi == last)
            if opened:
                side = 1 if p.hi == last else 0
                to, used[side] = (left, right)[side], True
                to.n[d], to.least[d], to.kids[d], to.leaves[d], to.saved[d], to.ends[d] = p.n - p.inner, p.least, p.kids, p.leaves, p.saved, p.ends
                for r in p.rows:
                    rows[r][1] = name(p.lo, d)
                p.rows, p.kids, p.leaves, p.saved, p.inner = [], 0, 0, 0, p.n
            else:
                p.leaves = p.leaves if p.kids else 1
                p.saved += (p.n - 1) * some.chars[d - 1] if d else 0
                for r in p.rows:
                    rows[r][4] = p.least
                rows.append([name(p.lo, d) if p.paths else None, None, p.least, d, None, p.n, p.kids, p.leaves, p.saved, p.ends or NOTHING])
                p.rows, p.kids, p.inner = [len(rows) - 1], 1, 0
            p.depth, p.ends = d - 1, None
            if d:
                for i in p.paths:
                    x = paths[i]
                    p.n, p.least, p.ends = p.n + x.n[d - 1], least_of(p.least, x.least[d - 1]), p.ends or x.ends[d - 1]
                    p.kids, p.leaves, p.saved = p.kids + x.kids[d - 1], p.leaves + x.leaves[d - 1], p.saved + x.saved[d - 1]

    edges = [common(paths[i].turns, paths[i + 1].turns) for i in range(last)]
    for i in sorted(range(last), key=lambda i: -edges[i]):
        a, b = parts[find(i)], parts[find(i + 1)]
        for p in (a, b):
            lift(p, edges[i])
        big, small = (a, b) if len(a.rows) + len(a.paths) >= len(b.rows) + len(b.paths) else (b, a)
        big.rows.extend(small.rows)
        big.paths.extend(small.paths)
        met = Part(a.lo, b.hi, edges[i], a.n + b.n, least_of(a.least, b.least), a.kids + b.kids, a.leaves + b.leaves, a.saved + b.saved,
                   a.ends or b.ends, a.inner + b.inner, big.rows, big.paths)
        above[find(i + 1)] = find(i)
        parts[find(i)] = met
    lift(parts[find(0)], -1)
    return rows, [p for k, p in enumerate((left, right)) if used[k]]


def _batch(pid: int, rows: list[list], left: list[Path]) -> Iterator[pa.RecordBatch]:
    """Rows of FOREST: closed nodes, then open paths."""
    empty = [None] * (len(_SCHEMA) - 12)
    for at in range(0, len(rows), 10_000):
        part = [[pid, None, *r, *empty] for r in rows[at:at + 10_000]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)
    for side, p in enumerate(left):
        one = [pid, side, *[None] * 10, p.turns, p.chars, p.n, p.least, p.kids, p.leaves, p.saved, p.ends]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(one, _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of a partition of sorted sequences (turns, chars, n, least, ends)."""
    paths = [Path.of(*row) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    yield from _batch(TaskContext.get().partitionId(), *forest(paths, False))


def _merge(whole: bool):
    def merge(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by([("pid", "ascending"), ("side", "ascending")])
        names = _SCHEMA.names[12:]
        paths = [Path(*(r[c] for c in names)) for r in group.select(names).to_pylist()]
        return pa.Table.from_batches(_batch(key[0].as_py(), *forest(paths, whole)), _SCHEMA)

    return merge


def rebuilt(conversations: DataFrame, turns_kept: Column, donor: Column) -> DataFrame:
    """(conv_id, turns, chars): of each conversation the turns after its first ``turns_kept``, behind as many of the conversation ``donor``'s first ones."""
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"), F.xxhash64(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("h"),
                    F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    own = conversations.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    own = keep(own.select("conv_id", F.col("t.h").alias("turns"), F.col("t.chars").alias("chars")), "trie-turns")
    most = own.agg(F.max(turns_kept)).first()[0] or 0
    heads = own.select(F.col("conv_id").alias("donor"), *(F.slice(c, 1, max(1, most)).alias(f"head_{c}") for c in ("turns", "chars")))
    both = own.select("conv_id", "turns", "chars", turns_kept.cast("int").alias("kept"), donor.alias("donor")).join(heads, "donor", "left")
    none = F.array().cast("array<long>")
    return both.select("conv_id", *(F.concat(F.coalesce(F.slice(f"head_{c}", F.lit(1), F.col("kept")), none), F.slice(c, F.col("kept") + 1, F.size(c))).alias(c)
                                    for c in ("turns", "chars")))


def _ends(copies: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the joined ids of each group's members (key, conv_id), which are read in order, a chunk at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if sha:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])], names=["key", "ends"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([sha.hexdigest()])], names=["key", "ends"])

    chunks = copies.groupBy("key", F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "ids").mapInArrow(digest, "key long, ends string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node of the
    trie of (conv_id, turns, chars), with conv_id unique: each distinct sequence of first turns, the empty one included.

    conv_id is the smallest of the conversations that start with the node, n_convs their number and
    parent_conv_id that of the node above (null for the root).  n_leaves counts the nodes without children in the
    node's subtree, itself included; saved_tokens adds up (n_convs - 1) * chars of the last turn over the subtree.
    ends_sha256 is the SHA-256 of the ids, in ascending order and comma-joined, of those that end at the node.
    Conversations without turns end at the root; equal ones share all nodes.  Without conversations there are no
    nodes.  A conversation's turn hashes are held whole by a task, and its copies' ids by chunks.
    """
    spark = sequences.sparkSession
    ship(spark)
    convs = keep(sequences.select("conv_id", "turns", "chars", F.xxhash64("turns").alias("key")), "trie-sequences")
    kinds = convs.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("turns").alias("turns"), F.first("chars").alias("chars"))
    kinds = keep(kinds, "trie-distinct")
    copied = convs.select("key", "conv_id").join(kinds.where("n > 1").select("key"), "key", "left_semi")
    ends = keep(_ends(copied), "trie-ends")
    alone = F.sha2(F.col("least").cast("string").cast("binary"), 256)
    kinds = kinds.join(ends, "key", "left").select("turns", "chars", "n", "least", F.coalesce("ends", alone).alias("ends"))
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = kinds.repartitionByRange(groups, "turns").sortWithinPartitions("turns").mapInArrow(_plant, FOREST)
    found, whole = [], False
    while True:
        part = keep(trees, "trie-forest")
        found.append(part.where("side is null"))
        if whole:
            break
        open_paths, groups = part.where("side is not null"), -(-groups // GROUP)
        whole = groups == 1
        trees = open_paths.groupBy(F.floor(F.col("pid") / GROUP).cast("int").alias("group")).applyInArrow(_merge(whole), FOREST)
    columns = [c.split()[0] for c in NODE.split(", ")]
    nodes = found[0].select(columns)
    for part in found[1:]:
        nodes = nodes.unionAll(part.select(columns))
    # a node whose parent was still open when it was closed asks for the parent, which was closed in a later round
    seam = found[1].select("node", "depth", "conv_id")
    for part in found[2:]:
        seam = seam.unionAll(part.select("node", "depth", "conv_id"))
    seam = few(seam.where("node is not null").select(F.col("node").alias("parent_node"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent")))
    asking, told = nodes.where("parent_node is not null"), nodes.where("parent_node is null")
    asked = asking.join(seam, ["parent_node", "depth"], "left").withColumn("parent_conv_id", F.col("parent"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return told.select(out).unionAll(asked.select(out))


def conversation_trie(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """The prefix trie of (conv_id, turn, role, text), of whose conversations each starts with the first turns of its
    block's first one: crc32(conv_id) % ``most`` of them, in place of as many of its own.

    Turns are in order of ``turn``, null first, equal ones in that of their hashes; null roles and texts are empty.
    Rows without conv_id belong to no conversation and are passed over; repeated rows are turns of their own; other
    columns are ignored; texts of any length count whole.  See prefix_trie for the result.
    """
    c = F.col("conv_id")
    return prefix_trie(rebuilt(conversations, crc32_of("conv_id") % most, c - c % block))
