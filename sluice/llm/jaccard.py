"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct word n-grams (as 64-bit hashes).  Documents
with equal sets are one class from the start.  Classes that may be similar are
partitioned into groups of bounded size; the matrix stores for each group the
union of its members' tokens.  The overlap of a set with a group's union bounds
its overlap with every member, so groups are opened, and members verified exactly,
only if the bound reaches the threshold.  Only links are wanted that join two
components: members of a large group of near copies are compared inside their
groups first, over a few rounds of cutting, and then only groups meet that hold
members of different components.  Pairs of documents are never rows.

Which sets and groups meet at all is decided exactly, without loss, by shared
signatures.  Sets that link differ in at most ``d`` tokens:

* ``buckets`` deals the tokens to more than ``d`` buckets by hash; some bucket has
  to hold the same tokens in both, and its sum is the signature.  A bucket holds
  several tokens, so chance matches are rare.  For thresholds of 0.85 and more.
* ``prefix`` takes the tokens that come first in one order of all; sets that link
  share one.  Tokens counted as frequent come last in that order.  For lower
  thresholds, where buckets would be many and small.  Before, twice as many first
  tokens by hash are counted over all sets: of two sets that link, a good part of
  these are the same, so sets of which too few were seen twice need none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import few, keep, ship, text_id
from sluice.llm.sequences import bits_of, passes

#: Members of a group, to which a large one is cut.
GROUP = 256
#: Rounds at most in which groups are cut anew among documents that aren't in one component yet; what is left
#: then, however much, is settled exactly by the matrix.
ROUNDS = 3
#: Set sizes from a band's least to its largest.
BAND = 1.5
#: Prefix tokens of more documents than this are frequent; so many of the most frequent are known to all tasks.
FREQUENT, FREQUENT_MOST = 50, 500_000
#: Distinct words a Python worker remembers; beyond that it starts anew.
CACHE = 200_000

_WORDS: dict[bytes, int] = {}
U = np.uint64
_ODD = [U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)]  # the constants of splitmix64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * _ODD[1]
    x = (x ^ (x >> U(27))) * _ODD[2]
    return x ^ (x >> U(31))


def tokens_of(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's words; a shorter text is one token."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, U)
    get, found = _WORDS.get, []
    for w in words:
        h = get(w)
        if h is None:
            if len(_WORDS) >= CACHE:
                _WORDS.clear()
            h = _WORDS[w] = xxhash.xxh3_64_intdigest(w)
        found.append(h)
    x = np.array(found, dtype=U)
    size = min(n, len(x))
    total = np.full(len(x) - size + 1, size, U) * _ODD[0]
    for i in range(size):
        total = mix(total + x[i:len(x) - size + 1 + i])
    return np.unique(total)


class Threshold:
    """Jaccard similarity of at least num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.buckets = num / den >= 0.85
        lo, self.bands = max(1, -(-num // (den - num))), []  # below, only equal sets link
        while lo < 1 << 40:
            hi = max(lo, int(lo * BAND))
            self.bands.append((lo, hi))
            lo = hi + 1
        self.edges = np.array([b[0] for b in self.bands])

    def bucket_numbers(self, band: int) -> tuple[int, int]:
        """(buckets, spare ones): with d tokens of difference, all buckets but d are equal; spare allows for empty ones."""
        lo, hi = self.bands[band]
        d, spare = hi * (self.den - self.num) // self.num, 1
        for _ in range(20):
            k = d + 1 + spare
            empty = k * math.exp(-lo / k)
            spare = max(spare, 1 + math.ceil(empty + 2.5 * math.sqrt(empty)))
        return d + 1 + spare, spare

    def least(self, n: int) -> int:
        """Size of the smallest set that links with one of n."""
        return -(-n * self.num // self.den)

    def wide(self, n: int) -> int:
        """Of a set of n, so many first tokens are counted over all sets."""
        return 2 * (n - self.least(n)) + 1

    def may_link(self, tokens: np.ndarray, repeated: np.ndarray) -> bool:
        """Whether enough of a set's first tokens are among the first ones of another set, too.

        At most n - least(n) tokens of a set of n are not in a set that it links with, so of the tokens
        they share the first n - least(n) + 1 lie among its own wide(n) first ones; the same holds for the
        other set, of least(n) tokens or more.
        """
        n = len(tokens)
        small = self.least(n)
        need = min(n - small, small - self.least(small)) + 1
        return n > 0 and int(passes(repeated, tokens[:self.wide(n)]).sum()) >= need

    def signatures(self, tokens: np.ndarray, frequent: np.ndarray | None = None) -> np.ndarray:
        n = len(tokens)
        if not n:
            return np.zeros(0, np.int64)
        if not self.buckets:
            late = tokens
            if frequent is not None and len(frequent):
                at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                late = np.concatenate([tokens[frequent[at] != tokens], tokens[frequent[at] == tokens]])
            return late[:n - self.least(n) + 1].view(np.int64)
        if n < self.bands[0][0]:
            return np.zeros(0, np.int64)
        out = []
        first, last = (max(0, int(np.searchsorted(self.edges, x, "right")) - 1) for x in (self.least(n), n))
        for band in range(first, last + 1):
            k, spare = self.bucket_numbers(band)
            spot = mix(tokens ^ _ODD[1]) % U(k)
            order = np.argsort(spot, kind="stable")
            filled, start = np.unique(spot[order], return_index=True)
            sums = np.add.reduceat(mix(tokens + _ODD[2])[order], start)
            out.append(mix(sums + (filled + U(1)) * _ODD[0] + np.array([band], U) * _ODD[1]))
            empty = np.setdiff1d(np.arange(k, dtype=U), filled)
            if len(empty) > spare:  # if all equal buckets are empty ones, more than spare of them are the same
                more = [[U(band), *c] for c in combinations(empty.tolist(), spare + 1)]
                out.append(np.array([xxhash.xxh3_64_intdigest(np.array(c, U).tobytes()) for c in more], U))
        return np.concatenate(out).view(np.int64)

    def links(self, same: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.den * same >= self.num * (a + b - same)


def _sets(docs: DataFrame, n: int, t: Threshold, frequent: np.ndarray | None, schema: str, first: bool = False, tokens: bool = False,
          repeated: np.ndarray | None = None) -> DataFrame:
    """doc_id, text_id, id (hash of the set), n and signatures, first tokens or all tokens, by a pass over the texts.
    Sets that can't link, by the filter of repeated first tokens, have no signatures."""
    known = docs.sparkSession.sparkContext.broadcast((frequent, repeated))

    def items(x: np.ndarray) -> np.ndarray:
        if tokens or first:
            return (x[:t.wide(len(x))] if first else x).view(np.int64)
        frequent, repeated = known.value
        return t.signatures(x, frequent) if repeated is None or t.may_link(x, repeated) else np.zeros(0, np.int64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [tokens_of(x.as_py(), n) for x in part.column(1)]
                ids = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) if len(x) else None for x in sets]
                lists = [items(x) for x in sets]
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                flat = pa.array(np.concatenate([*lists, np.zeros(0, np.int64)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(ids, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)],
                    names=["doc_id", "text_id", "id", "n", "items"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_id().alias("text_id")).mapInArrow(find, schema)


SETS = "doc_id long, text_id long, id long, n long, items array<long>"


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): comp is the smallest id reachable over edges (a, b).

    Each round every vertex takes the least label of its neighbours and its label's
    own label, and hands the former to the vertex its label names, so whole trees
    hook onto lower ones however the ids run along a chain.  Labels only fall; rounds
    go on until none moves, and then neighbours have equal ones.  The tables are
    written each round.
    """
    both = keep(edges.select("a", "b").where("a <> b").unionAll(edges.where("a <> b").select("b", "a")).distinct(), "cc-edges")
    label = keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("comp")), "cc-labels")
    while True:
        near = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        seen = keep(label.join(near, "id").select("id", "comp", F.least("comp", "near").alias("near")), "cc-near")
        up = label.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        hook = seen.groupBy(F.col("comp").alias("id")).agg(F.min("near").alias("hook"))
        new = seen.join(up, "comp").join(hook, "id", "left").select("id", F.least("near", "up", "hook").alias("new"), "comp")  # least() passes over null
        new = keep(new, "cc-labels")
        still = new.where("new <> comp").isEmpty()
        label = new.select("id", F.col("new").alias("comp"))
        if still:
            return label


def _groups(candidates: DataFrame, seed: int) -> DataFrame:
    """(id, g, chunk): each id with the pivot that shares most signatures, groups cut to about GROUP members."""
    best = candidates.groupBy("id", "pivot").agg(F.count("*").alias("c")).groupBy("id").agg(F.max(F.struct("c", F.negate(F.xxhash64("pivot", F.lit(seed))).alias("r"), "pivot")).alias("m"))
    member = best.select("id", F.col("m.pivot").alias("g"))
    size = member.groupBy("g").agg(F.ceil(F.count("*") / GROUP).alias("chunks"))
    cut = member.join(size, "g").select("id", "g", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("chunks")).cast("int").alias("chunk"))
    # the pivot is a member of each part of its group, so parts that contain its copies meet
    pivots = size.select(F.col("g").alias("id"), "g", F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))).alias("chunk"))
    return cut.unionAll(pivots).distinct()


def overlaps(lists: list[np.ndarray]) -> np.ndarray:
    """Tokens that each two of some sets share: products of blocks of their membership matrix."""
    n, sizes = len(lists), [len(x) for x in lists]
    rows = np.repeat(np.arange(n), sizes)
    union, col = np.unique(np.concatenate([*lists, np.zeros(0, np.int64)]), return_inverse=True)
    shared = np.bincount(col, minlength=len(union)) > 1
    place = np.cumsum(shared) - 1
    rows, col = rows[shared[col]], place[col[shared[col]]]
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    same = np.zeros((n, n), np.float64)
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(col, [start, start + 4096])
        m = np.zeros((n, 4096), np.float32)
        m[rows[a:b], col[a:b] - start] = 1
        same += m @ m.T
    same[np.diag_indices(n)] = sizes
    return same


def _open_groups(members: DataFrame, t: Threshold) -> DataFrame:
    """(g, chunk, id, root) per member: the least id it is linked with inside its group, over links."""
    schema = pa.schema([("g", pa.int64()), ("chunk", pa.int32()), ("id", pa.int64()), ("root", pa.int64())])
    none = np.iinfo(np.int64).max

    def each(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        lists = group.column("tokens").combine_chunks()
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        sizes = np.diff(at)
        link = t.links(overlaps(sets), sizes[:, None], sizes[None, :])
        root = np.minimum(np.where(link, ids[None, :], none).min(axis=1), ids)
        while True:
            new = np.minimum(root, np.where(link, root[None, :], none).min(axis=1))
            if (new == root).all():
                break
            root = new
        n = len(ids)
        return pa.table({"g": pa.array([key[0].as_py()] * n, pa.int64()), "chunk": pa.array([key[1].as_py()] * n, pa.int32()),
                         "id": pa.array(ids, pa.int64()), "root": pa.array(root, pa.int64())}, schema=schema)

    return members.groupBy("g", "chunk").applyInArrow(each, "g long, chunk int, id long, root long")


def jaccard_components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, text_id, n_shingles, component_id) for each row of (doc_id, text).

    component_id is the smallest doc_id that is reached over links of Jaccard
    similarity num / den or more, itself included.  Null and empty texts have no
    tokens, link with nothing and keep their own id; rows with equal texts or
    repeated ids keep a row each; a row without id takes its component's smallest
    id, null if there is none; other columns are ignored.  Tokens and sets are
    told apart by 64-bit hashes.
    """
    spark, t = docs.sparkSession, Threshold(num, den)
    ship(spark)
    frequent = repeated = None
    if not t.buckets:
        # every document's first tokens in hash order, twice as many as needed; one seen once links nothing
        seen = _sets(docs, n, t, None, SETS, first=True).select(F.explode("items").alias("key")).groupBy("key").count()
        seen = keep(seen.where("count > 1"), "jaccard-seen")
        often = seen.where(F.col("count") > FREQUENT).orderBy(F.desc("count"), "key").limit(FREQUENT_MOST).collect()
        frequent = np.sort(np.array([r["key"] for r in often], np.int64).view(U))
        repeated = bits_of(seen.select("key"))
    sets = keep(_sets(docs, n, t, frequent, SETS, repeated=repeated), "jaccard-sets")
    postings = sets.where("id is not null").select("id", F.explode("items").alias("sig"))
    live = postings.groupBy("sig").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot <> last")
    met = keep(postings.join(live, "sig").select("sig", "id", "pivot", "last").distinct(), "jaccard-met")

    # the token sets of documents that share a signature with another one
    wanted = met.select("id").distinct()
    copies = sets.select("id", "doc_id").join(wanted, "id").groupBy("id", "doc_id").agg(F.count("*").alias("c"))
    first = keep(copies.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.max("c").alias("c"), F.max(F.col("doc_id").isNull()).alias("no_id")), "jaccard-wanted")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = source.join(few(first.select("doc_id").where("doc_id is not null").distinct()), "doc_id")
    if not first.where("doc_id is null").isEmpty():
        rows = rows.unionAll(source.where("doc_id is null"))
    has = _sets(rows, n, t, None, SETS, tokens=True).join(few(first.select("id")), "id").select("id", "n", F.col("items").alias("tokens"))
    if not first.where("c > 1 or no_id").isEmpty():  # rows that repeat an id, or have none
        has = has.dropDuplicates(["id"])
    has = keep(has, "jaccard-tokens")

    alive, edges, comp, group = met, None, None, None
    for turn in range(ROUNDS):
        pivots = alive.select("id", "pivot") if turn % 2 == 0 else alive.select("id", F.col("last").alias("pivot"))
        group = keep(_groups(pivots, turn), "jaccard-groups")
        opened = _open_groups(has.join(few(group), "id").select("g", "chunk", "id", "tokens"), t)
        found = keep(opened.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct(), "jaccard-links")
        edges = found if edges is None else edges.unionAll(found)
        comp = components(edges)
        alive = _across(alive.drop("comp"), comp)
        if alive.isEmpty():
            break
    if not alive.isEmpty():
        comp = components(edges.unionAll(_ask(alive, group, has, t)))
    of = sets.select("doc_id", "text_id", "n", "id").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = of.where("id is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = of.join(least, "comp", "left")
    return out.select("doc_id", "text_id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _across(met: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of signatures whose members are in two components or more, with their components."""
    m = met.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    m = keep(m, "jaccard-comps")
    split = m.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("sig")
    return keep(m.join(split, "sig"), "jaccard-alive")


def _ask(alive: DataFrame, group: DataFrame, has: DataFrame, t: Threshold) -> DataFrame:
    """Links (a, b) between components, by the token-group matrix.

    Its rows are the groups' token unions.  Two groups are taken together if a
    signature has members of different components in them; the overlap of their
    unions bounds that of any two members, then each set's overlap with the other
    group's union bounds that with its members, and the rest is verified.
    """
    key = F.struct("g", "chunk").alias("k")
    spots = alive.select("sig", "id", "comp").join(group, "id").groupBy("sig", key).agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    a, b = spots.alias("a"), spots.alias("b")
    apart = (F.col("a.k") < F.col("b.k")) & ((F.col("a.x") != F.col("b.x")) | (F.col("a.y") != F.col("b.y")) | (F.col("a.x") != F.col("a.y")))
    pairs = keep(a.join(b, F.col("a.sig") == F.col("b.sig")).where(apart).select(F.col("a.k").alias("p"), F.col("b.k").alias("q")).distinct(), "jaccard-pairs")
    of = alive.select("id", "comp").distinct()
    member = has.join(few(group.join(of, "id")), "id").select(key, "id", "comp", "n", "tokens")
    # a group's sets, GROUP of them
    rows = keep(member.groupBy("k").agg(F.min("n").alias("least"), F.collect_list("id").alias("ids"), F.collect_list("comp").alias("comps"),
                                        F.collect_list("tokens").alias("sets")).withColumn("union", F.array_distinct(F.flatten("sets"))), "jaccard-matrix")
    slim = rows.select("k", "least", "union")
    left, right = (slim.select(F.col("k").alias(c), F.col("least").alias(f"least_{c}"), F.col("union").alias(f"union_{c}")) for c in "pq")
    reach = t.den * F.size(F.array_intersect("union_p", "union_q")) >= t.num * F.greatest("least_p", "least_q")
    asked = keep(pairs.join(left, "p").join(right, "q").where(reach).select("p", "q"), "jaccard-asked")
    sides = [rows.select(F.col("k").alias(c), *(F.col(n).alias(f"{n}_{c}") for n in ("ids", "comps", "sets"))) for c in "pq"]
    both = asked.join(sides[0], "p").join(sides[1], "q").select("ids_p", "comps_p", "sets_p", "ids_q", "comps_q", "sets_q")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, comps = ([np.array(batch.column(c)[i].as_py(), np.int64) for c in cs] for cs in ((0, 3), (1, 4)))
                sets = [[x.values.to_numpy() for x in batch.column(c)[i].values] for c in (2, 5)]
                unions = [np.unique(np.concatenate(x)) for x in sets]
                left, right = ([k for k, x in enumerate(sets[side]) if t.den * np.isin(x, unions[1 - side], assume_unique=True).sum() >= t.num * len(x)] for side in (0, 1))
                if not left or not right:
                    continue
                open_sets = [sets[0][k] for k in left] + [sets[1][k] for k in right]
                size = np.array([len(x) for x in open_sets])
                same = overlaps(open_sets)[:len(left), len(left):]
                link = t.links(same, size[:len(left), None], size[None, len(left):])
                link &= comps[0][left][:, None] != comps[1][right][None, :]
                x, y = np.nonzero(link)
                # one link is enough to join two components
                _, first = np.unique(np.c_[comps[0][left][x], comps[1][right][y]], axis=0, return_index=True) if len(x) else (None, np.zeros(0, np.int64))
                yield pa.RecordBatch.from_pydict({"a": pa.array(ids[0][left][x[first]], pa.int64()), "b": pa.array(ids[1][right][y[first]], pa.int64())})

    return keep(both.mapInArrow(verify, "a long, b long"), "jaccard-links")
