"""Line dedup across documents by a segment-partition edit join.

Two lines within ``edits`` character edits share one of ``edits + 1`` segments of
the shorter one whole, near its place.  Each distinct line indexes its segments
under (its length, segment number, text); it probes, for each length of up to
``edits`` less than its own, those of its substrings that can hold a segment
(their starts are bounded from both ends).  Where lines meet, each is compared with
two pivots of the key first, the earliest and the most frequent line; only lines
that are near none of them meet all others, if their letter counts can be that
near.  Lines are verified with banded bit-parallel edit distance over what
remains between their common beginning and end.

A line goes if an equal or near one comes earlier in the order of (doc_id, text
hash, line number).  That holds for equal lines of any length that have a word,
and for near ones with an edit for each CHARS_AN_EDIT characters of the shorter
line, ``edits`` at most: below that a line has only equal ones.  Where
``least_chars`` is given, shorter lines stay and all others have ``edits``.

The plan: equal lines are collapsed by 128-bit hashes with partial aggregation,
so frequent lines cost a row a task; only hashes of substrings are shuffled for
the join, whose hot keys adaptive execution splits; the hashes of lines that meet
or go join by broadcast while they are small (their bytes are bounded first) and
by shuffle beyond that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import BROADCAST, few, keep, text_id

EDITS = 2
CHARS_AN_EDIT = 8
#: Lines without a letter or digit go, too, from this length on.
WORDLESS_CHARS = 24
#: Characters of one byte of which lines' counts are compared.
PARITY = "abcdefghijklmnopqrstuvwxyz .,-01"


def segment(short: int, i: int, parts: int) -> tuple[Column, Column]:
    """(0-based start, length) of segment i of a line that is ``short`` characters shorter: the last ones are a character
    longer.  Read from the columns of ``with_sizes``."""
    start = F.lit(0)
    for j in range(i):
        start = start + F.col(f"size_{parts}_{j - short}")
    return start, F.col(f"size_{parts}_{i - short}")


def with_sizes(lines: DataFrame, edits: int, least_chars: int | None) -> DataFrame:
    """lines with size_<parts>_<d>, the characters of a part of n + d: segment i of a line of n has the i-th size.

    Columns of their own keep the keys' expressions small: generated methods of more
    than 8,000 bytes of bytecode are never compiled by the JVM, only interpreted.
    """
    return lines.select("*", *(F.floor((F.col("n") + d) / parts).cast("int").alias(f"size_{parts}_{d}")
                               for parts in {most + 1 for most in each_allowed(edits, least_chars)} for d in range(-edits, parts)))


def key(short: int, i: int, text: Column) -> Column:
    return F.xxhash64(F.col("n") - short, F.lit(i), text)


def allowed(length: Column, edits: int, least_chars: int | None) -> Column:
    """Edits within which a line is near one that isn't shorter."""
    return F.lit(edits) if least_chars is not None else F.least(F.lit(edits), F.floor(length / CHARS_AN_EDIT).cast("int"))


def each_allowed(edits: int, least_chars: int | None) -> list[int]:
    """The edits that lines are allowed, by their lengths; none needs no keys."""
    return [edits] if least_chars is not None else list(range(1, edits + 1))


def index_keys(edits: int, least_chars: int | None) -> Column:
    """Keys of a line's segments."""
    return by_allowed(0, edits, least_chars, lambda most: [
        key(0, i, F.substr("line", start + 1, size)) for i in range(most + 1) for start, size in [segment(0, i, most + 1)]])


def probe_keys(edits: int, least_chars: int | None) -> Column:
    """Keys of substrings that may be a segment of a line of the same length or up to its allowed edits less, but for
    the line's own segments."""
    def keys(less: int, most: int) -> list[Column]:
        found = []
        for i in range(most + 1 if less <= most else 0):
            start, size = segment(less, i, most + 1)
            for shift in range(max(-i, less - (most - i)), min(i, less + (most - i)) + 1):
                if less == shift == 0:
                    continue  # the line's own segment
                found.append(key(less, i, F.substr("line", F.greatest(start + (1 + shift), F.lit(1)), size)))
        return found

    return F.array_distinct(F.concat(*(by_allowed(less, edits, least_chars, lambda most, less=less: keys(less, most)) for less in range(edits + 1))))


def with_keys(lines: DataFrame, edits: int, least_chars: int | None) -> DataFrame:
    """(h1, h2, at, own, probes): the keys under which each line is indexed and asks, too."""
    return with_sizes(lines, edits, least_chars).select(
        "h1", "h2", "at", index_keys(edits, least_chars).alias("own"), probe_keys(edits, least_chars).alias("probes"))


def by_allowed(short: int, edits: int, least_chars: int | None, keys: Callable[[int], list[Column]]) -> Column:
    """The keys for the edits that a line ``short`` characters shorter is allowed; none without edits."""
    if least_chars is not None:
        return F.array(*keys(edits))
    out, length = F.array().cast("array<bigint>"), F.col("n") - short
    for most in each_allowed(edits, least_chars):
        if found := keys(most):
            enough = length >= most * CHARS_AN_EDIT
            out = F.when(enough if most == edits else enough & (length < (most + 1) * CHARS_AN_EDIT), F.array(*found)).otherwise(out)
    return out


def letter_parity(line: Column) -> Column:
    """A bit for each of some frequent characters: whether the line has an odd number of it.

    An edit turns at most two of them, so lines within some edits differ in at most
    twice as many bits.  Lines that share a segment but have other words differ in
    more, and needn't be compared.
    """
    size = F.octet_length(line)
    odd = [F.shiftleft(size.bitwiseXOR(F.octet_length(F.replace(line, F.lit(c), F.lit("")))).bitwiseAND(F.lit(1)).cast("long"), i) for i, c in enumerate(PARITY)]
    return reduce(Column.bitwiseOR, odd)


def common_start(a: Column, b: Column, most: Column) -> Column:
    """Characters that two strings begin with alike, by halving steps."""
    steps = F.transform(F.sequence(F.ceil(F.log2(F.greatest(most, F.lit(1)) + 1)).cast("int"), F.lit(0)), lambda i: F.pow(F.lit(2), i).cast("int"))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= most) & (F.substr(a, at + 1, step) == F.substr(b, at + 1, step)), at + step).otherwise(at))


def banded_distance(a: Column, b: Column, m: Column, edits: int) -> Column:
    """Edit distance of character arrays a (of m, not the shorter) and b, if it is at most ``edits``; else more.

    Column j of the matrix is kept as differences between neighbouring cells of
    the rows j - edits .. j + edits, a bit each, and a column's bits follow from
    the last one's by a few additions and shifts.  The band's lowest cell is
    followed down its diagonal, and along the last row once that is reached.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    long = lambda x: F.lit(x).cast("long")

    def column(s: Column, j: Column) -> Column:
        here = F.get(b, j - 1)
        bits = [F.when(F.get(a, j - edits + d - 1) == here, 1 << d).otherwise(0) for d in range(width)]
        equal = bits[0]
        for x in bits[1:]:
            equal = equal + x
        s1 = F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), s["dist"].alias("dist"), equal.cast("long").alias("x"))
        return F.transform(F.array(s1), lambda v: next_column(v, j))[0]

    def next_column(v: Column, j: Column) -> Column:
        d0 = (((v["x"].bitwiseAND(v["vp"]) + v["vp"]).bitwiseXOR(v["vp"])).bitwiseOR(v["x"]).bitwiseOR(v["vn"])).bitwiseAND(long(full))
        return F.transform(F.array(F.struct(v.alias("v"), d0.alias("d0"))), lambda w: finish(w, j))[0]

    def finish(w: Column, j: Column) -> Column:
        v, d0 = w["v"], w["d0"]
        hp = v["vn"].bitwiseOR(long(full) - d0.bitwiseOR(v["vp"]))
        hn = d0.bitwiseAND(v["vp"])
        down = F.shiftright(d0, 1)
        row = F.lit(width - 1) - (j + edits - m)
        bit = lambda x: F.pmod(F.floor(x / F.pow(F.lit(2), row)), F.lit(2)).cast("int")
        dist = F.when(j + edits <= m, v["dist"] + F.lit(1) - F.shiftright(d0, width - 1).cast("int")).otherwise(v["dist"] + bit(hp) - bit(hn))
        return F.struct(hn.bitwiseOR(long(full) - down.bitwiseOR(hp)).alias("vp"), down.bitwiseAND(hp).alias("vn"), dist.cast("int").alias("dist"))

    start = F.struct(long((full << edits) & full).alias("vp"), long(0).alias("vn"), F.least(F.lit(edits), m).cast("int").alias("dist"))
    columns = F.when(F.size(b) > 0, F.sequence(F.lit(1), F.size(b))).otherwise(F.array().cast("array<int>"))
    return F.when(F.size(b) == 0, m).otherwise(F.aggregate(columns, start, column, lambda s: s["dist"]))


def step(df: DataFrame, **columns: Column) -> DataFrame:
    """These columns, computed once: a filter further up can't be pushed through a
    generator, which would put the expressions of all steps into one another."""
    row = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(F.explode(F.array(row)).alias("s")).select("s.*")


def within(pairs: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b, and more columns) whose texts are within ``edits`` edits, and within ``most`` if there is such a column."""
    rest = {c: F.col(c) for c in pairs.columns if c not in ("a", "b")}
    a, b, la, lb, start, end = (F.col(c) for c in ("a", "b", "la", "lb", "start", "end"))
    p = step(pairs, **rest, a=a, b=b, la=F.length("a"), lb=F.length("b")).where(F.abs(la - lb) <= edits)
    p = step(p, **rest, a=F.when(la < lb, b).otherwise(a), b=F.when(la < lb, a).otherwise(b), la=F.greatest(la, lb), lb=F.least(la, lb))
    p = step(p, **rest, a=a, b=b, la=la, lb=lb, start=common_start(a, b, lb))
    p = step(p, **rest, a=F.reverse(F.substr(a, start + 1)), b=F.reverse(F.substr(b, start + 1)), la=la - start, lb=lb - start)
    p = step(p, **rest, a=a, b=b, la=la, lb=lb, end=common_start(a, b, lb))
    p = step(p, **rest, a=F.substr(a, end + 1), b=F.substr(b, end + 1), la=la - end, lb=lb - end)
    # without a limit the last of the split characters would be an empty string
    chars = lambda c, n: F.when(n > 0, F.split(c, "", n)).otherwise(F.array().cast("array<string>"))
    p = step(p, **rest, a=chars(a, la), b=chars(b, lb), m=la)
    p = step(p, **rest, distance=banded_distance(a, b, F.col("m"), edits))
    return p.where(F.col("distance") <= (F.col("most") if "most" in rest else edits)).select(*rest)


def lines_of(docs: DataFrame, least_chars: int | None) -> DataFrame:
    """(at, line, n, h1, h2) of each line that may go, n its characters; ``at`` orders all lines of the corpus."""
    size = F.col("n")
    may_go = size >= least_chars if least_chars is not None else (size >= WORDLESS_CHARS) | F.col("line").rlike(r"[\p{L}\p{N}]")
    d = docs.select("doc_id", text_id().alias("text_id"), F.split("text", "\n").alias("lines"))
    d = d.select("doc_id", "text_id", F.posexplode_outer("lines").alias("line_no", "line"))
    d = d.withColumn("n", F.length("line")).where(may_go)   # counted once: all keys start from it
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("doc_id"), "text_id", F.col("line_no").cast("int").alias("line_no"))
    return d.select(at.alias("at"), "line", "n", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _met(distinct: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Index and probe rows (key, h, first, times, early, often) of keys that two different lines meet at, with the pivots
    of the key's index and probe rows, the earliest line and the most frequent one; and the lines' hashes."""
    index = distinct.select(F.explode("own").alias("key"), F.col("h1").alias("h"))
    probe = distinct.select(F.explode(F.concat("own", "probes")).alias("key"), F.col("h1").alias("h"))
    # the large join has hashes only: each probe row meets its key's index rows as their least and greatest hash
    ends = index.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    probes = keep(probe.join(ends, "key").where("low <> h OR high <> h").select("key", "h").distinct(), "line-probes")
    index = keep(index.join(few(keep(probes.select("key").distinct(), "line-met")), "key").select("key", "h").distinct(), "line-index")
    who = keep(index.select("h").unionAll(probes.select("h")).distinct(), "line-who")
    known = keep(distinct.select(F.col("h1").alias("h"), "first", "times").join(few(who), "h").groupBy("h").agg(F.min("first").alias("first"), F.max("times").alias("times")), "line-known")
    index, probes = index.join(known, "h"), probes.join(known, "h")
    # index rows meet the pivots of the probe rows, and the other way round
    return (*(keep(a.join(b.groupBy("key").agg(*_pivots()), "key"), "line-members") for a, b in ((index, probes), (probes, index))), who)


def _pivots() -> list[Column]:
    return [F.min(F.struct("first", "h")).alias("early"), F.max(F.struct("times", "h", "first")).alias("often")]


def _with_pivots(rows: DataFrame) -> DataFrame:
    """Pairs (x, y) of each row's line and the pivots of its key that aren't itself."""
    pairs = rows.select("h", F.explode(F.array_distinct(F.array("early.h", "often.h"))).alias("p")).where("h <> p")
    return pairs.select(F.least("h", "p").alias("x"), F.greatest("h", "p").alias("y"))


def repeated_lines(docs: DataFrame, edits: int = EDITS, least_chars: int | None = None) -> DataFrame:
    """(doc_id, text_id, line_no): a row's lines that go."""
    lines = lines_of(docs, least_chars)
    distinct = keep(with_keys(lines, edits, least_chars).groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("times"), F.first("own").alias("own"), F.first("probes").alias("probes")), "line-keys")
    index, probes, who = _met(distinct)
    texts = lines.join(few(who.withColumnRenamed("h", "h1")), "h1").groupBy("h1", "h2").agg(F.min(F.struct("at", "line")).alias("l")).select("h1", "h2", "l.at", "l.line")
    texts = keep(texts.withColumn("odd", letter_parity(F.col("line"))), "line-texts")

    def later(pairs: DataFrame) -> DataFrame:
        """(h1, h2): the later lines of the pairs that are near."""
        side = lambda h, t, n: texts.select(F.col("h1").alias(h), F.col("h2").alias(n), F.col("at").alias(f"at_{t}"), F.col("line").alias(t), F.col("odd").alias(f"odd_{t}"))
        most = allowed(F.least(F.length("a"), F.length("b")), edits, least_chars)
        both = pairs.join(side("x", "a", "x2"), "x").join(side("y", "b", "y2"), "y").where(_alike("odd_a", "odd_b", edits)).drop("odd_a", "odd_b")
        near = within(both.withColumn("most", most), edits)
        z = F.when(F.col("at_a") < F.col("at_b"), F.struct(F.col("y").alias("h1"), F.col("y2").alias("h2"))).otherwise(F.struct(F.col("x").alias("h1"), F.col("x2").alias("h2")))
        return keep(near.select(z.alias("z")).select("z.h1", "z.h2").distinct(), "line-near")

    # a line that is near a pivot of one of its keys and comes after it is settled: the members of a large group of
    # near copies are compared with its pivots only
    by_pivot = later(keep(_with_pivots(index).unionAll(_with_pivots(probes)).distinct(), "line-pairs"))
    # the others meet every line that comes before them, but for the other side's pivots, which they have met
    settled = by_pivot.select(F.col("h1").alias("h")).distinct().withColumn("settled", F.lit(True))
    state = texts.groupBy(F.col("h1").alias("h")).agg(F.first("odd").alias("odd")).join(settled, "h", "left")
    state = keep(state.select("h", "odd", F.col("settled").isNull().alias("open")), "line-state")

    def member(rows: DataFrame, name: str) -> DataFrame:
        return rows.join(state, "h").select("key", F.struct("h", "first", "open", "odd", F.col("early.h").alias("early"), F.col("often.h").alias("often")).alias(name))

    x, y = (keep(member(rows, name), "line-members") for rows, name in ((index, "x"), (probes, "y")))
    rest = x.join(y, "key")
    turn = F.when(F.col("x.first") < F.col("y.first"), F.col("y.open")).otherwise(F.col("x.open"))
    new = ~F.col("x.h").isin(F.col("y.h"), F.col("y.early"), F.col("y.often")) & ~F.col("y.h").isin(F.col("x.early"), F.col("x.often"))
    rest = rest.where(new & turn & _alike("x.odd", "y.odd", edits))
    rest = rest.select(F.least("x.h", "y.h").alias("x"), F.greatest("x.h", "y.h").alias("y")).distinct()
    near = keep(by_pivot.unionAll(later(keep(rest, "line-pairs"))).distinct(), "line-near")
    out = distinct.select("h1", "h2", "first", "times").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("near or times > 1")
    gone = lines.select("at", "h1", "h2").join(few(keep(out.drop("times"), "line-out")), ["h1", "h2"]).where(F.coalesce("near", F.lit(False)) | (F.col("at") != F.col("first")))
    return keep(gone.select("at.doc_id", "at.text_id", "at.line_no").distinct(), "line-gone")


def _alike(odd_a: str, odd_b: str, edits: int) -> Column:
    return F.bit_count(F.col(odd_a).bitwiseXOR(F.col(odd_b))) <= 2 * edits


def dedup_lines(docs: DataFrame, edits: int = EDITS, least_chars: int | None = None) -> DataFrame:
    """docs with the repeated lines taken out of ``text``, and n_lines_gone.

    Null and empty texts stay as they are; rows with equal id and text keep and
    lose the same lines; rows without id come last in the order; a text whose
    lines all go becomes empty; other columns stay.
    """
    # a row's own lines, as many as its text has at most
    gone = keep(repeated_lines(docs, edits, least_chars).groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone")), "line-numbers")
    size = gone.agg(F.sum(F.size("gone") * 8 + 64)).first()[0] or 0
    d = docs.select(F.struct("*").alias("row"), text_id().alias("text_id"))
    g = (F.broadcast(gone) if size <= BROADCAST else gone).alias("g")
    d = d.alias("d").join(g, F.col("d.row.doc_id").cast("long").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_id") == F.col("g.text_id")), "left")
    text = F.col("d.row.text")
    lines = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("g.gone", i))
    out = {c: F.col(f"d.row.`{c}`") for c in docs.columns} | {
        "text": F.when(F.col("g.gone").isNull(), text).otherwise(F.array_join(lines, "\n")),
        "n_lines_gone": F.coalesce(F.size("g.gone"), F.lit(0)).cast("long")}
    return d.select(*(c.alias(name) for name, c in out.items()))
