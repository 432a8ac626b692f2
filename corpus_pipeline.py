"""The corpus pipeline: quality filter, exact dedup, near dedup, substring
dedup and packing, each stage over all that its predecessor kept.

Defined results of every stage: null and empty texts, very long texts, rows that
repeat an id or a whole row, null ids, null languages and sources, empty tables
and further columns of any name pass without error; the first four stages
return the columns of their input, in order. What each does with such rows is
said below.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from corvid.llm import exact_dedup, near_dedup, packing, quality, suffix_tree
from corvid.llm.common import discard, small_batches, staged
from corvid.llm.queries import vocabulary
from corvid.sources.tables import table

NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps, every row judged by
    itself. Null text, language and source are judged as empty and returned as
    null; repeated rows are judged alike; without labels of both kinds every
    document stays."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (of the largest id) of each group of equal texts. Null
    counts as empty, so of all empty texts one stays; a null id is smaller than
    any other; of rows that repeat id and text any one stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (of the least id) of each group of near duplicates. Texts
    without words and rows with a null id are linked with nothing and stay; rows
    of one id stay or go together."""
    return near_dedup.drop_near(docs, NEAR_PERCENT)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of a smaller id has; no row
    goes. Null stays null; a text that loses all its words is empty; rows of one
    id count as one document; rows with a null id stay whole."""
    return suffix_tree.drop_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences. Null and empty texts are the end id
    alone; repeated rows and null ids are packed as documents of their own;
    further columns are not returned."""
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))


CODEC = "zstd"  # of texts that lie in the shared folder


def read_by_plan(stage):
    """The stage with its own jobs run with small Arrow batches. Its result is
    left to its reader: a plan that sends nothing to Python, so no copy of the
    texts is kept for it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run_stage


def written(stage):
    """The stage with its result written and read again, all of its jobs run
    with small Arrow batches: the setting holds when a plan is made, so it would
    not reach a result that is left to its reader."""

    @wraps(stage)
    def write_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return staged(stage(spark, docs, sf_dir), stage.__name__, CODEC)

    return read_by_plan(write_stage)


STAGES = [
    ("quality classifier", written(quality_stage)),
    ("exact dedup", read_by_plan(exact_stage)),
    ("MinHash near-dedup", read_by_plan(near_stage)),
    ("substring dedup", written(substring_stage)),
    ("best-fit packing", written(packing_stage)),
]

# A co-trained classifier, connected components and packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and
    deleted when the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        if "staged_path" not in vars(out):
            out = staged(out, stage.__name__, CODEC)
        if "staged_path" in vars(docs):
            discard(docs)
        docs = out
    return docs
