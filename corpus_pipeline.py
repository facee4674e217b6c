"""A corpus made ready for training: toxic documents go, copies and near copies go, sources are mixed, texts are packed.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before kept; all but the last return the columns of
``documents``. Between stages rows are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import exact, mixing, packing, simhash, toxicity
from lakeops.llm.queries import MIX_WEIGHTS, SEQUENCE, table, toxicity_model
from lakeops.llm.tokens import public_path
from lakeops.session import stored

# No SQL: scores, fingerprints and packing are beyond it.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by a model of the labelled ones."""
    return toxicity.drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints are linked, the row with the smallest id."""
    return simhash.keep_representatives(docs, words=4, max_bits=4)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, stored in the order in which their sources' blocks are scheduled."""
    return mixing.mixed(docs, MIX_WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed into sequences in stored order."""
    return packing.pack(docs, public_path("word_bpe_49k.json"), 1, SEQUENCE, order=packing.stored_order(docs))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("source_mixing", mixed_sources),
    ("sequence_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name)
    return rows
