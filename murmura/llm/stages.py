"""The operators as stages of a corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""
from __future__ import annotations

from pyspark.sql import DataFrame

from murmura.llm import minhash, packing, quality, suffix_dedup


def drop_unlikely(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    A null or empty text goes, as it has no perplexity; repeated rows are judged each; a null doc_id or lang is judged like
    any other, by the threshold of all languages where it has none of its own. Without trusted texts every text that isn't
    empty stays. An empty table stays empty."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one of smallest doc_id.

    Null, empty and blank texts are linked with nothing and stay; so do rows with a null doc_id. Rows with the same doc_id are
    one document and stay or go together."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier.

    A null text stays null, an empty one empty, and a text that repeats others as a whole becomes empty; no row goes. A row
    with a null doc_id keeps its text. Rows with the same doc_id are one document."""
    return suffix_dedup.without_repeats(docs)


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their ids.

    A null or empty text packs as its end id alone, a null doc_id stays null, repeated rows are packed each, and an empty
    table gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("quality", drop_unlikely),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack),
]


def run(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each stage over what the one before it kept, written and read again in between."""
    from murmura.llm._store import table

    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
