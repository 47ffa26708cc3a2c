"""A training corpus from `documents`: quality, near duplicates, repeated passages, mixture, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns the next
stage's documents. All but the last keep the columns of documents, and columns beyond them, whatever their names.
run() applies them in order, each written as Parquet under the shared folder and read again.

In every stage an empty table gives an empty one, and null in any column crashes nothing; what each makes of
null texts and ids, repeated rows and ties stands with it. tests/llm/test_pipeline.py holds the stages against
brute force, each on its own input, and runs them over such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessarium.llm import curriculum, kneser_ney, minhash_odd, packing, suffix_levels
from tessarium.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the Kneser-Ney classifier rejects.

    Null, empty and blank texts stay; rows equal in text and language share their verdict, whatever their ids;
    a null language is judged by the limits over all languages.
    """
    return kneser_ney.filter_documents(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: shingles of five words, a similarity of 0.8 or more.

    The smallest doc_id of a group stays, one row of it; rows without an id stay where no row with one is near, one
    of each group. Different texts of one id are different documents. Texts without words are near nothing; of rows
    equal in id and text one stays.
    """
    return minhash_odd.deduplicate(docs, Scratch(spark, "near"), width=5)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 100 bytes and more that start earlier elsewhere, character by character; emptied documents go.

    Null and empty texts stay as they are. Earlier is the smaller doc_id (null first), of one id the smaller hash of the
    text; equal rows are one document. n_chars follows where a text is cut.
    """
    return suffix_levels.remove(docs, Scratch(spark, "passages"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents as often as the curriculum does, in training order.

    Texts without words have no size and are not taken; a null source is a source of its own. Repeated rows count one
    by one; equal positions are ordered by source, doc_id and the hash of the row.
    """
    return curriculum.mix(docs, Scratch(spark, "mixture"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' token ids into sequences, one row a piece.

    Null and empty texts are the end id alone; repeated rows and null ids are documents of their own.
    """
    scratch = Scratch(spark, "packed")
    return packing.pack(scratch.write(packing.pieces(docs)), scratch)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicate removal", near_duplicates),
    ("suffix-array dedup", passages),
    ("curriculum mixture", mixture),
    ("best-fit packing", packed),
]

#: Trained models and searches are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
