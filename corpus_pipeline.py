"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes the documents its predecessor kept. Its result is written as Parquet to the folder
all machines share and read back, so a lost executor never costs an earlier stage.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.bpe import encode
from lakeops.llm.common import kept_table
from lakeops.llm.decontaminate import drop_contaminated
from lakeops.llm.jaccard import link_documents
from lakeops.llm.native import unused
from lakeops.llm.pii import mask_personal_data
from lakeops.llm.quality import keep_good
from lakeops.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Each row is judged by its own text, so repeated rows stay or go together; a null, empty or
    short text is rejected. An empty table stays empty; columns may have any names.
    """
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Groups are linked by sets of five-word shingles that are alike to 0.8 or more. Of rows that
    repeat an id and a text one stays. Rows without an id are told apart by their text. Texts that are
    null or without words are linked with nothing. An empty table stays empty; columns may have any
    names.
    """
    own_name, text_name = unused(docs.columns, "__id"), unused(docs.columns, "__text")
    own = F.coalesce(F.col("doc_id"), F.xxhash64("text").bitwiseOR(F.lit(-(1 << 63))))
    keyed = docs.withColumn(own_name, own)
    groups = link_documents(keyed.select(own_name, "text"), id_name=own_name, k=5, percent=80)
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias(own_name)).distinct()
    kept = keyed.join(stay, own_name, "left_semi").withColumn(text_name, F.xxhash64("text"))
    return kept.dropDuplicates([own_name, text_name]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    Each row is judged by its own text; a null text, and a null item, have no words, so such a
    document stays. Without items all stay. An empty table stays empty; columns may have any names.
    """
    return drop_contaminated(docs, read_table(spark, f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and ``n_chars`` counted anew.

    Repeated rows stay repeated; a null text stays null, with a null ``n_chars``. An empty table stays
    empty; other columns may have any names.
    """
    return mask_personal_data(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, one row per row; a null text has no tokens.

    An empty table gives an empty result; further columns are left out.
    """
    encoded = encode(docs, tokenizers.path(TOKENIZER))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

# Suffix arrays, masking and merges are beyond SQL; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
