"""Exact dedup by content-defined chunk recipes.

A text is cut where its own content says so: after a line end or sentence
mark once a chunk has ``MIN_CHUNK`` characters, at ``MAX_CHUNK`` at the
latest. Each chunk gets a 64-bit identifier. The identifiers are verified
over the whole corpus: distinct (identifier, chunk) pairs are counted, with
the chunk's text in the key and combined before the shuffle, so a chunk's
text moves once per task however many documents hold it; texts that collide
on an identifier are told apart by their rank. A document's recipe is its
ordered list of verified identifiers, and documents are equal when their
recipes are: only recipes, never whole texts, are grouped and joined.

Defined results: texts compare after lower-casing A-Z; null counts as empty
and all empty texts are equal; of equal texts the largest id stays (a null id
is smaller than any other), of rows that repeat an id and text one stays;
an empty table gives no rows; further columns are kept by ``drop_copies`` and
ignored by ``find_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import lower_ascii, staged

MIN_CHUNK = 512
MAX_CHUNK = 4096


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """Content-defined chunks of a text, in order and without gaps."""
    cut = r"(?s).{%d,%d}?(?:(?<=[\n.!?;。])|\z)|.{1,%d}" % (least, most, most)
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def _row_id() -> Column:
    return F.monotonically_increasing_id()


def _identifier(bits: int):
    """64-bit content hash of a chunk; fewer bits only in tests of collisions."""
    return lambda c: F.xxhash64(c) if bits == 64 else F.pmod(F.xxhash64(c), F.lit(1 << bits))


def find_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = MIN_CHUNK,
    most: int = MAX_CHUNK,
    bits: int = 64,
) -> DataFrame:
    """One row per document.

    -> ``row_id`` (of the row in the scan), ``<id_col>, keep_id, group_size,
    kept, text_sha256``.
    """
    ident = _identifier(bits)
    cut = docs.select(
        _row_id().alias("row_id"),
        F.col(id_col).alias("id"),
        lower_ascii(F.col(text_col)).alias("norm"),
    ).withColumn("cut", chunks(F.col("norm"), least, most))
    recipes = staged(
        cut.select("row_id", "id", F.sha2("norm", 256).alias("sha"), F.transform("cut", ident).alias("recipe")),
        "recipes",
    )
    # Verification: chunks whose identifier another text has too.
    collided = staged(
        cut.select(F.explode("cut").alias("chunk"))
        .select(ident(F.col("chunk")).alias("ident"), "chunk")
        .distinct()
        .groupBy("ident")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("ident"),
        "collided",
    )
    if collided.isEmpty():
        recipes = recipes.withColumn("ranks", F.array().cast("array<struct<pos:int,rank:int>>"))
    else:
        recipes = recipes.join(_ranks(cut, collided, ident), "sha", "left").withColumn(
            "ranks", F.coalesce("ranks", F.array().cast("array<struct<pos:int,rank:int>>"))
        )
    groups = recipes.groupBy("recipe", "ranks").agg(
        F.max(F.struct("id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    return recipes.join(groups, ["recipe", "ranks"]).select(
        "row_id",
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _ranks(cut: DataFrame, collided: DataFrame, ident) -> DataFrame:
    """Per text (by its digest: rows are not matched across scans) the places
    and ranks of its chunks with a collided identifier. The rank of a chunk is
    its place among the distinct chunks of the identifier, so a frequent chunk
    is ranked as one row."""
    placed = (
        cut.select(F.sha2("norm", 256).alias("sha"), F.posexplode("cut").alias("pos", "chunk"))
        .withColumn("ident", ident(F.col("chunk")))
        .join(collided, "ident", "left_semi")
        .distinct()
    )
    texts = placed.select("ident", "chunk").distinct()
    other = texts.select("ident", F.sha2("chunk", 256).alias("chunk_sha")).groupBy("ident").agg(
        F.sort_array(F.collect_set("chunk_sha")).alias("shas")
    )
    return (
        placed.join(other, "ident")
        .select(
            "sha",
            F.struct("pos", F.array_position("shas", F.sha2("chunk", 256)).cast("int").alias("rank")).alias("r"),
        )
        .groupBy("sha")
        .agg(F.sort_array(F.collect_list("r")).alias("ranks"))
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies, all columns kept.

    Rows are matched by their id and the digest of their text, never by their
    place in a scan, which changes with the cores. Of rows that repeat both, any
    one stays.
    """
    found = find_copies(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), F.col("text_sha256").alias("sha"), F.col(id_col).eqNullSafe(F.col("keep_id")).alias("best")
    )
    seen = found.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("n"), F.first("best").alias("best"))
    marked = staged(seen.filter("n > 1 OR NOT best"), "copies")
    # The whole row travels in one field: its columns may have any names.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), F.sha2(lower_ascii(F.col(f"`{text_col}`")), 256).alias("sha")
    )
    same = rows["id"].eqNullSafe(marked["id"]) & (rows["sha"] == marked["sha"])
    kept = rows.join(marked, same, "left_anti")
    repeated = marked.filter("best")
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(repeated, same, "left_semi").dropDuplicates(["id", "sha"]))
    return kept.select("row.*")
