"""Registered queries of this package and, where SQL can express them, the expected results.

Paths of tokenizer files are parameters of the operators; the queries take
them from the installed ``public_tokenizers`` package when they run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100).drop("text_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.warc import warc_round_trip

    return warc_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.line_dedup import dedup_lines

    docs = dedup_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_lines_gone", F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sluice.llm.token_output import token_shards

    return token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sluice.llm.byte_bpe import digests, encode_decode

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN))


#: Tools whose calls are validated.
TOOLS = {
    "search": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "required": ["query"], "additionalProperties": False},
    "fetch": {"properties": {"url": {"type": "string"}}, "required": ["url"]},
    "run": {"properties": {"code": {"type": "string"}, "language": {"enum": ["python", "sql", "shell"]}}, "required": ["code"]},
}


def op5_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.chat import link_tool_calls

    return link_tool_calls(table(spark, sf_dir, "conversations"), TOOLS)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.lm_score import pseudo_likelihood

    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.quality import quality

    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.decontaminate import decontaminate

    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.toxicity import held_out, toxicity, train

    docs = table(spark, sf_dir, "documents")
    machine = train(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity(docs, machine).select("doc_id", held_out().alias("held_out"), "score", "predicted", "word")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.prefix_trie import conversation_trie

    return conversation_trie(table(spark, sf_dir, "conversations"), block=100, most=6)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), most_words=3, least=10, share=50, top=2000)


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_output": op4_token_output,
    "op5_chat_tools": op5_chat_tools,
    "op6_lm_score": op6_lm_score,
    "op7_quality_rules": op7_quality_rules,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_decontaminate": op9_decontaminate,
    "op10_toxicity": op10_toxicity,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}

#: SHA-1 in base32: of each 20 bits (five hexadecimal digits) four letters.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
hashed AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS x, h FROM p),
bits AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(x, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS parts FROM hashed),
marked AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((parts[k // 4 + 1] >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest
  FROM bits)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to, true AS intact
FROM marked
"""

ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({ASCII_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + least(3, len(w))), ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(len(w) - least(3, len(w)) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, edges.b FROM reach r JOIN edges ON edges.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE a = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

#: The given conversations hold no calls: each message stands for itself.
OP5_SQL = """
SELECT conv_id, turn, role, CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_linked, CAST(0 AS BIGINT) AS n_invalid, CAST(0 AS BIGINT) AS n_cyclic, false AS orphan,
       '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || ',"turn":' || CAST(turn AS VARCHAR) || '}' AS json
FROM conversations
"""

OP9_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex({ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex({ASCII_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(len(w) - least(10, len(w)) + 1)) AS s FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, l, array_to_string(list_slice(w, s + 1, s + l), ' ') AS k FROM bs),
ds AS (SELECT doc_id, w, l, unnest(range(len(w) - l + 1)) AS s FROM d, (SELECT DISTINCT l FROM windows) WHERE len(w) >= l),
found AS (SELECT doc_id, s, l, item_id FROM (SELECT doc_id, s, l, array_to_string(list_slice(w, s + 1, s + l), ' ') AS k FROM ds) JOIN windows USING (l, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, s, md5(array_to_string(list_slice(w, s + 1, s + 20), ' ')) AS k FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
gone AS (SELECT doc_id, list_sort(list(DISTINCT p)) AS gone FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM later) GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d JOIN gone USING (doc_id)),
gaps AS (SELECT doc_id, unnest(gone) AS p FROM gone),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gaps USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(t, '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

#: DuckDB has no crc32: its bits are folded here.
OP12_SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
crc AS (SELECT conv_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
  lambda a, x: list_reduce(list_prepend(xor(a, x), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS r
  FROM (SELECT DISTINCT conv_id FROM conversations)),
h AS (SELECT conv_id, xor(r, 4294967295) % 6 AS h FROM crc),
turns AS (SELECT h.conv_id, i, role, text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 100 WHERE i <= h
  UNION ALL SELECT h.conv_id, h + i, role, text FROM h JOIN t USING (conv_id) WHERE i > h),
convs AS (SELECT h.conv_id, coalesce(list(sha256(role || chr(31) || text) ORDER BY i) FILTER (i IS NOT NULL), []) AS s, coalesce(list(length(text) ORDER BY i) FILTER (i IS NOT NULL), []) AS l
  FROM h LEFT JOIN turns USING (conv_id) GROUP BY h.conv_id),
steps AS (SELECT conv_id, d, md5(array_to_string(list_slice(s, 1, d), '')) AS k, md5(array_to_string(list_slice(s, 1, d - 1), '')) AS up, len(s) AS n, CASE WHEN d > 0 THEN l[d] ELSE 0 END AS c
  FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM convs)),
nodes AS (SELECT d, k, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n, min(c) AS c, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM steps GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (d, k)),
under AS (SELECT DISTINCT a.d AS d, a.k AS k, b.d AS below, b.k AS kb FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (SELECT under.d, under.k, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * c) AS saved FROM under JOIN full_nodes f ON f.d = below AND f.k = kb GROUP BY ALL)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, x.kids AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(x.ends, '')) AS ends_sha256
FROM full_nodes x JOIN sums USING (d, k) LEFT JOIN nodes p ON x.d > 0 AND p.d = x.d - 1 AND p.k = x.up
"""

OP13_SQL = r"""
WITH pieces AS (SELECT lang, p, row_number() OVER () AS piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
words AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, len, array_to_string(list_slice(w, s, s + len - 1), ' ') AS phrase FROM (SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS s FROM words, (SELECT unnest([1, 2, 3]) AS len) WHERE len(w) >= len)),
f AS (SELECT lang, len, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len = 1 GROUP BY lang),
cand AS (SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE len > 1 AND f >= 10),
cuts AS (SELECT lang, phrase, a, len, cut, array_to_string(list_slice(w, 1, cut), ' ') AS x, array_to_string(list_slice(w, cut + 1, len), ' ') AS y
  FROM (SELECT *, unnest(range(1, len)) AS cut FROM cand)),
scored AS (SELECT c.lang, c.phrase, a, c.len, cut, g.f AS l, h.f AS r, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(g.f AS HUGEINT) * h.f) AS BIGINT) AS score
  FROM cuts c JOIN f g ON g.lang = c.lang AND g.phrase = x JOIN f h ON h.lang = c.lang AND h.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, sub AS phrase, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS sub FROM cand WHERE len = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.phrase = best.phrase AND len = 2 WHERE most IS NULL OR 100 * most < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""

#: Of the others: 4, 6, 8 and 10 need a tokenizer or a trained model, 7 the estimation and 3 the edit distance of
#: characters, which SQL can't express; tests compare those with brute force, the libraries on whole texts, or
#: held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op5_chat_tools": OP5_SQL,
    "op9_decontaminate": OP9_SQL,
    "op11_substring_dedup": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
