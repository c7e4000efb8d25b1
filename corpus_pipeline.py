"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all
but the last return the columns of `documents`.

Defined cases, in every stage: columns beside doc_id, text and n_chars pass through, whatever
their names; an empty table gives an empty one, with the same columns.  A null or empty text is
not toxic, is nobody's copy and keeps its null; it is packed as one end mark.  A row without an
id is judged by its text and stays; as the representative of copies it comes after every id.  Of
rows that repeat both id and text one stays.  Texts are read and changed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm import chosen_path, packing, secret_scan, suffix_dedup, toxicity
from ratebook.llm.common import stored
from ratebook.llm.queries import categories, table, word_vocabulary


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain finds toxic go."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), categories())
    p = chain.column(F.coalesce("text", F.lit("")))[chain.categories.index("toxic")]
    empty = F.coalesce("text", F.lit("")) == ""
    return docs.where(empty | (p < 0.5))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each class of near copies stays."""
    return chosen_path.one_of_each(docs)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that an earlier text has are cut out."""
    return _counted(suffix_dedup.without_repeats(docs))


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _counted(secret_scan.without_secrets(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts, packed into sequences."""
    return packing.pack(packing.pieces(docs, word_vocabulary(), keep_ids=False))


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_copies_out),
    ("suffix_array", repeats_out),
    ("secrets", secrets_out),
    ("packing", packed),
]

#: Trained models, suffix arrays and token ids are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
