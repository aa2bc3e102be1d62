"""Corpus pipeline: toxicity, line dedup, near-duplicate join, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import keep, table, without


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the kernel machine, trained on the labels that aren't held out, finds toxic go.

    Null and empty texts hold no toxic word and stay, as does every row if there are no labels of both kinds;
    rows that share an id or a text are judged alike, each by its text; long texts count whole; an empty table stays empty.
    """
    from sluice.llm.toxicity import held_out, train, without_toxic

    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels"), ~held_out()))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an equal or near line of an earlier document, or earlier in the same one, go.

    No row goes: null and empty texts stay as they are, a text whose lines all go becomes empty.  Rows without id come
    last in the order, those that share one come in the order of their texts' hashes, and rows equal in both keep and
    lose the same lines.  ``n_chars``, where there is such a column, follows the text.
    """
    from sluice.llm.line_dedup import dedup_lines

    fewer = dedup_lines(docs).drop("n_lines_gone")
    return fewer.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else fewer


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that five-word shingles link at 0.8 or more, that with the smallest doc_id stays.

    Rows that share an id are one document; rows without id have none to stay by and all stay.
    """
    from sluice.llm.jaccard import jaccard_components

    found = jaccard_components(docs, n=5, num=8, den=10)
    return without(docs, found.where("doc_id <> component_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts, and all texts if the benchmark is empty, hold none and stay; rows that share an id are judged
    by their own texts; rows without id too; long texts count whole.
    """
    from sluice.llm.decontaminate import decontaminate as find

    return without(docs, find(docs, table(spark, sf_dir, "benchmark")).where("contaminated"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document by the multilingual byte-level vocabulary, with digests of ids and decoded bytes.

    A row for each row of docs: null is an empty text, which has no ids; repeated rows and rows without id keep a row
    each; long texts count whole; an empty table gives no rows.
    """
    import public_tokenizers

    from sluice.llm.byte_bpe import digests, encode_decode

    return digests(encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]

#: Toxicity scores and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
