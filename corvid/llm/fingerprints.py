"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text's paragraphs are its lines, cut after sentence ends and at ``LONGEST``
characters at the latest; each distinct one has a 64-bit digest. A sketch has
three tables of ``w`` cells. A digest is added to one cell of each: the cell
counts its digests and holds the XOR of the digests and of their checks. Two
sketches subtract cell by cell; a cell that holds one digest (count of 1 or -1
and a matching check) gives that digest up, which is taken out of its other
cells, and so on. When all cells are empty in the end, the digests found are
the paragraphs in which the texts differ, and their numbers give the Jaccard
likeness. Pairs that do not come out are sketched again with larger tables,
sized for all their paragraphs, then twice that, and at last compared digest
by digest.

Everything is DataFrame operations. Texts are dealt by row once, and their
next documents' beginnings are sent to them; the digests are written as a
table bucketed by row, so that building, subtracting and peeling (one
aggregation for each table and sweep) shuffle nothing.

Defined results: null text is empty; a text without paragraphs has the empty
fingerprint, and two of them the likeness 1; a table of one row is its own
next document; null ids come last in descending order; rows that repeat an id
and text are one document, returned as often, and texts of one id follow each
other in any fixed order; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import discard, parts_for, shared_dir, staged

LONGEST = 200
TABLES = 3
CELLS = 8  # of each table of the published fingerprint
SWEEPS = 3
ROOM = 1.6  # cells per digest when sketching larger
BUCKET_DIGESTS = 1_000_000
A, EDITED, NEXT = 0, 1, 2


def paragraphs(text: Column, longest: int = LONGEST) -> Column:
    """The text in pieces, without gaps: lines and sentences."""
    cut = r"(?s).{1,%d}?(?:\n|[.!?]\s|\z)|.{1,%d}" % (longest, longest)
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(-1))


def cell_of(key: Column, table: int | Column, width: Column, salt: int) -> Column:
    t = F.lit(table) if isinstance(table, int) else table
    return (t * width + F.pmod(F.xxhash64(key, t, F.lit(salt)), width)).cast("int")


def successors(ids: DataFrame) -> DataFrame:
    """``row, id`` -> ``row, next_row``: by descending id, the first after the
    last. Rows are dealt by ranges of the id; a range's last row is followed
    by the first of the next range, taken from a table of one row a range."""
    order = [F.col("id").desc_nulls_last(), F.col("row").asc()]
    dealt = staged(
        ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    inside = Window.partitionBy("part").orderBy(*order)
    ranges = dealt.groupBy("part").agg(
        F.min_by("row", F.struct((F.col("id").isNull()).cast("int"), -F.col("id"), "row")).alias("head")
    )
    over = Window.orderBy("part")
    every = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = ranges.select("part", F.coalesce(F.lead("head").over(over), F.first("head").over(every)).alias("after"))
    return (
        dealt.withColumn("next_row", F.lead("row").over(inside))
        .join(after, "part")
        .select("row", F.coalesce("next_row", "after").alias("next_row"))
    )


def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, text`` -> (``row, id, n_chars, copies``, written; ``row, text`` of
    the same rows).

    A document is an id with a text; ``copies`` counts its rows. Its number is
    a 64-bit hash of the digest of both, drawn again (salted) until no two
    documents share one. Numbers taken from a scan would differ in the next
    scan when the cores change.
    """
    key = F.sha2(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("text")), 256)
    for salt in itertools.count():
        row = F.xxhash64(key, F.lit(salt))
        ids = staged(
            rows.select(key.alias("key"), row.alias("row"), "id", F.length("text").cast("long").alias("n_chars"))
            .groupBy("key", "row")
            .agg(F.first("id").alias("id"), F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies")),
            "ids",
        )
        if ids.groupBy("row").count().filter("count > 1").isEmpty():
            break
        discard(ids)
    texts = rows.select(row.alias("row"), "text")
    if not ids.filter("copies > 1").isEmpty():
        texts = texts.dropDuplicates(["row"])
    return ids.drop("key"), texts


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``row, id, n_chars, copies, text, edited, next_digests``: the edited
    text has the last half of the characters replaced by the next document's
    first as many (or all). Both uses of the texts read one exchange by row."""
    ids, texts = numbered(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    follow = staged(successors(ids.select("row", "id")), "follow")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    wants = follow.join(ids.select("row", half.alias("take")), "row").select(
        F.col("next_row").alias("row"), F.col("row").alias("to"), "take"
    )
    given = texts.join(wants, "row").select(
        F.col("to").alias("row"),
        F.substr("text", F.lit(1), F.col("take")).alias("head"),
        digests(F.col("text")).alias("next_digests"),
    )
    return (
        texts.join(ids, "row")
        .join(given, "row")
        .select(
            "row",
            "id",
            "n_chars",
            "copies",
            "text",
            F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), "head").alias("edited"),
            "next_digests",
        )
    )


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder as a table bucketed by ``key``."""
    name = f"fingerprints_{uuid.uuid4().hex}"
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    out = df.sparkSession.table(name)
    # The frame knows its files; the name is no longer needed.
    df.sparkSession.sql(f"DROP TABLE {name}")
    return out


def _cells(keys: DataFrame, by: list[str], salt: int) -> DataFrame:
    """``key, sign, w`` and the columns ``by`` -> cells ``c, k, x``."""
    return (
        keys.select(*by, "w", "key", "sign", F.explode(F.array(*[F.lit(t) for t in range(TABLES)])).alias("t"))
        .select(*by, "w", cell_of(F.col("key"), F.col("t"), F.col("w"), salt).alias("cell"), "key", "sign")
        .groupBy(*by, "w", "cell")
        .agg(F.sum("sign").alias("c"), F.bit_xor("key").alias("k"), F.bit_xor(check(F.col("key"))).alias("x"))
    )


NOT_EMPTY = "c <> 0 OR k <> 0 OR x <> 0"
FOUND = {1: -1, -1: -2}  # cell numbers that count the digests found, by sign


def peel(cells: DataFrame, salt: int, sweeps: int = SWEEPS) -> DataFrame:
    """Difference cells ``row, pair, w, cell, c, k, x`` -> ``row, pair, plus,
    minus, left``: digests found on either side and cells that stay. A sweep
    goes through the tables one by one: a digest is in one cell of a table, so
    none is found twice."""
    by = ["row", "pair", "w", "cell"]
    for n in range(sweeps * TABLES):
        t = n % TABLES
        w, k = F.col("w"), F.col("k")
        pure = (
            (F.abs("c") == 1) & (F.col("x") == check(k)) & (F.col("cell") == cell_of(k, t, w, salt))
        )

        def row(cell, c, k_, x):
            return F.struct(
                cell.cast("int").alias("cell"), c.cast("long").alias("c"), k_.cast("long").alias("k"),
                x.cast("long").alias("x"),
            )

        others = [
            row(cell_of(k, u, w, salt), -F.col("c"), k, F.col("x")) for u in range(TABLES) if u != t
        ]
        found = row(F.when(F.col("c") > 0, F.lit(FOUND[1])).otherwise(F.lit(FOUND[-1])), F.lit(1), F.lit(0), F.lit(0))
        itself = row(F.col("cell"), F.col("c"), k, F.col("x"))
        cells = (
            cells.select("row", "pair", "w", F.explode(F.when(pure, F.array(found, *others)).otherwise(F.array(itself))).alias("u"))
            .select("row", "pair", "w", "u.cell", "u.c", "u.k", "u.x")
            .groupBy(*by)
            .agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("x").alias("x"))
            .filter(NOT_EMPTY)
        )
    count = lambda cell: F.sum(F.when(F.col("cell") == cell, F.col("c")).otherwise(0)).cast("long")
    return cells.groupBy("row", "pair").agg(
        count(FOUND[1]).alias("plus"),
        count(FOUND[-1]).alias("minus"),
        F.sum((F.col("cell") >= 0).cast("long")).alias("left"),
    )


def _pair_keys(table: DataFrame, failed: DataFrame) -> DataFrame:
    """-> ``row, pair, key, sign, n``: the digests of both sides of each pair
    (EDITED, NEXT) in ``failed``; ``n`` is their number. The join is by row
    alone, so the table stays as it is bucketed."""
    wanted = failed.groupBy("row").agg(F.collect_set("pair").alias("pairs"))
    side = lambda keys, sign: F.transform(
        keys, lambda k: F.struct(k.alias("key"), F.lit(sign).cast("long").alias("sign"))
    )
    pair = lambda name, number: F.struct(
        F.lit(number).alias("pair"),
        (F.size("own") + F.size(name)).alias("n"),
        F.concat(side(F.col("own"), 1), side(F.col(name), -1)).alias("keys"),
    )
    return (
        table.join(wanted, "row")
        .select("row", "pairs", F.explode(F.array(pair("edited", EDITED), pair("next", NEXT))).alias("p"))
        .filter(F.array_contains("pairs", F.col("p.pair")))
        .select("row", "p.pair", "p.n", F.explode("p.keys").alias("k"))
        .select("row", "pair", "n", "k.key", "k.sign")
    )


def differences(table: DataFrame, base: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """``table``: ``row, own, edited, next`` digests; ``base``: its sketches
    ``row, side, w, cell, c, k, x``. -> ``row, pair, plus, minus`` for every
    pair that differs."""
    sign = F.when(F.col("side") == A, F.col("c")).otherwise(-F.col("c"))
    pairs = F.when(F.col("side") == A, F.array(F.lit(EDITED), F.lit(NEXT))).otherwise(F.array("side"))
    less = (
        base.select("row", F.explode(pairs).alias("pair"), "w", "cell", sign.alias("c"), "k", "x")
        .groupBy("row", "pair", "w", "cell")
        .agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("x").alias("x"))
        .filter(NOT_EMPTY)
    )
    tried = staged(peel(less, 0, sweeps), "peeled")
    done = tried.filter("left = 0")
    for salt, room in ((1, ROOM), (2, 2 * ROOM)):
        failed = tried.filter("left > 0").select("row", "pair")
        if failed.isEmpty():
            return done.drop("left")
        keys = _pair_keys(table, failed)
        width = (F.ceil(F.col("n") * room / TABLES) + 2).cast("int")
        tried = staged(
            peel(_cells(keys.withColumn("w", width), ["row", "pair"], salt).filter(NOT_EMPTY), salt, sweeps), "peeled"
        )
        done = done.unionByName(tried.filter("left = 0"))
    failed = tried.filter("left > 0").select("row", "pair")
    exact = (
        _pair_keys(table, failed)
        .groupBy("row", "pair", "key")
        .agg(F.sum("sign").alias("s"))
        .groupBy("row", "pair")
        .agg(
            F.sum((F.col("s") > 0).cast("long")).alias("plus"),
            F.sum((F.col("s") < 0).cast("long")).alias("minus"),
            F.lit(0).cast("long").alias("left"),
        )
    )
    return done.unionByName(exact).drop("left")


def _printed(base: DataFrame) -> DataFrame:
    """Sketches as strings: ``row, fingerprint, edited_fingerprint`` (cells
    that are not empty: number, count, digests, checks)."""
    text = F.concat_ws(":", F.col("cell"), F.col("c"), F.hex("k"), F.hex("x"))
    side = lambda s: F.array_join(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("side") == s, F.struct("cell", text.alias("t"))))), lambda z: z.t
        ),
        ",",
    )
    return base.filter(F.col("side") != NEXT).groupBy("row").agg(
        side(A).alias("fingerprint"), side(EDITED).alias("edited_fingerprint")
    )


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, sweeps: int = SWEEPS
) -> DataFrame:
    """-> ``<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``."""
    edits = with_edits(docs, id_col, text_col).select(
        "row",
        "id",
        "n_chars",
        "copies",
        F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("edited"),
        F.col("next_digests").alias("next"),
    )
    chars = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()[0]
    buckets = parts_for(chars, 40 * BUCKET_DIGESTS / 2)
    # No fewer buckets than shuffle partitions, or joins would deal them anew.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = bucketed(edits, "row", max(least, buckets))
    sides = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(c).alias("keys")) for s, c in ((A, "own"), (EDITED, "edited"), (NEXT, "next"))]
    )
    keys = (
        table.select("row", F.explode(sides).alias("s"))
        .select("row", "s.side", F.explode("s.keys").alias("key"))
        .withColumn("sign", F.lit(1).cast("long"))
        .withColumn("w", F.lit(cells))
    )
    base = _cells(keys, ["row", "side"], 0)
    found = differences(table, base, sweeps).groupBy("row").agg(
        *[
            F.sum(F.when(F.col("pair") == p, F.col(s)).otherwise(0)).alias(f"{s}_{p}")
            for p in (EDITED, NEXT)
            for s in ("plus", "minus")
        ]
    )

    def near(pair: int) -> Column:
        plus, minus = (F.coalesce(f"{s}_{pair}", F.lit(0)) for s in ("plus", "minus"))
        union = F.size("own") + minus
        return F.when(union == 0, 1.0).otherwise((F.size("own") - plus) / union).cast("double")

    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return (
        table.join(_printed(base), "row", "left")
        .join(found, "row", "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            F.col("id").alias(id_col),
            "n_chars",
            "edited_sha256",
            empty("fingerprint"),
            empty("edited_fingerprint"),
            near(EDITED).alias("near_edited"),
            near(NEXT).alias("near_next"),
        )
    )
