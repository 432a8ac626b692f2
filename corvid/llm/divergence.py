"""How far the sources of a language diverge in their choice of terms.

Terms are runs of letters ``A-Z a-z`` and of characters beyond ASCII, with only
``A-Z`` lower-cased. They are counted in chunks of texts by length-bucketed
packing (``term_runs``): one Arrow pass over the table, no loop over rows or
terms. Partial counts are summed by (language, source, term); a language keeps
the terms of at least ``least_docs`` of its documents.

All arithmetic is on integers: ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` is
an exact decimal division, and the divergence of a term between two
distributions is ``floor((p - q)^2 / (p + q))``.

Pairs of sources never become rows per term. The kept terms of a language are
dealt to lots by hash; a lot is a (terms x sources) matrix in one task, which
yields one partial sum for each pair. Terms that no source of a block has add
the same to a pair each, so only their number counts. Languages of more than
``BLOCK`` sources are cut into pairs of blocks, which bounds the matrix.

Defined results: null text, language and source are ``''``; a (language,
source) without terms is a group all the same; a language that keeps no term has
value 0 for each pair and no ``term`` rows; a language with one source has no
``pair`` rows; ids are not read, so repeated rows are documents of their own;
texts beyond ``CHUNK`` bytes are counted in slices cut between terms; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm import term_runs
from corvid.llm.common import parts_for, staged

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 10**9
CHUNK = 8 << 20
LOT_TERMS = 20_000
BLOCK = 256


def _slices(data: np.ndarray, low: int, high: int) -> Iterator[np.ndarray]:
    """One long text in slices of about ``CHUNK`` bytes that cut no term."""
    while low < high:
        cut = min(low + CHUNK, high)
        outside = ~term_runs.TERM[data[cut:high]]
        cut = cut + int(outside.argmax()) if outside.any() else high
        yield data[low:cut]
        low = cut


def _counts(codes: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """Term counts of texts in the order of their group codes."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + CHUNK, side="right")) - 1)
        low, high = int(ends[row]), int(ends[stop])
        if high - low <= CHUNK:
            yield from term_runs.counted(data[low:high], ends[row : stop + 1] - low, codes[row:stop])
        else:  # one long text
            found = []
            for part in _slices(data, low, high):
                found += term_runs.counted(part, np.array([0, len(part)]), codes[row:stop])
            if found:
                yield term_runs.of_one_text(found)
        row = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """-> ``lang, source, term, n, docs``: partial counts, several rows a key."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, source, text = batch.columns
            groups = pd.DataFrame({"lang": lang.to_pandas(), "source": source.to_pandas()})
            codes = groups.groupby(["lang", "source"], sort=False).ngroup().to_numpy()
            heads = pa.array(np.flatnonzero(~groups.duplicated().to_numpy()))
            order = np.argsort(codes, kind="stable")
            for found in _counts(codes[order], text.take(pa.array(order))):
                first = heads.take(found.column(0))
                columns = [lang.take(first), source.take(first), found.column(1).cast(pa.string()), *found.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """-> ``lang, source, term, n, lang_n, head``: the terms that each language
    keeps where they occur; ``head`` marks one row of each (lang, term)."""
    sums = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A (language, term) has a row for each source at most.
    term = Window.partitionBy("lang", "term")
    first = F.row_number().over(term.orderBy("source")) == 1
    every = sums.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term), "head": first})
    return every.filter(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE (n + 2) / (total + 2 terms))``, exact."""
    whole = (n + F.lit(2)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", whole, (total + 2 * terms).cast("decimal(20,0)"))


def _apart(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; shares stay below 2^30, so it fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """-> ``lang, source, number, sources, total, lang_total, terms, p0``: every
    (language, source); ``p0`` is the share of a kept term that it lacks."""
    empty = F.lit("")
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source"))).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("head").alias("terms"))
    lang = Window.partitionBy("lang")  # of groups, not of rows
    none = F.lit(0).cast("long")
    out = (
        every.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .withColumns({c: F.coalesce(c, none) for c in ("total", "lang_total", "terms")})
        .withColumns({
            "number": F.row_number().over(lang.orderBy("source")) - 1,
            "sources": F.count(F.lit(1)).over(lang).cast("int"),
        })
    )
    share = _share(none, F.col("total"), F.col("terms"))
    return out.withColumn("p0", F.when(F.col("terms") > 0, share).otherwise(none))


def _pair_sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """One lot of terms (``number, term, p``) of the sources of two blocks
    (``number, p0, a_side, b_side, base``): partial sums of each ordered pair."""
    numbers = right.column("number").to_numpy()
    order = np.argsort(numbers)
    numbers, p0 = numbers[order], right.column("p0").to_numpy()[order]
    base = int(right.column("base")[0].as_py())
    lang, low, high = (right.column(c)[0].as_py() for c in ("lang", "low", "high"))
    terms = left.column("term").combine_chunks().dictionary_encode()
    shares = np.repeat(p0[None, :], len(terms.dictionary), axis=0)
    at = np.searchsorted(numbers, left.column("number").to_numpy())
    shares[terms.indices.to_numpy(), at] = left.column("p").to_numpy()
    rows = np.flatnonzero(numbers // BLOCK == low)
    columns = np.flatnonzero(numbers // BLOCK == high)
    a, b, value = [], [], []
    for i in rows.tolist():
        others = columns[columns > i] if low == high else columns
        p, q = p0[i], p0[others]
        none = (p - q) ** 2 // np.maximum(p + q, 1)
        mine = shares[:, i : i + 1]
        theirs = shares[:, others]
        some = ((mine - theirs) ** 2 // np.maximum(mine + theirs, 1)).sum(axis=0)
        a.append(np.full(len(others), numbers[i]))
        b.append(numbers[others])
        value.append(some + none * (base - len(shares)))
    cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    a, b, value = cat(a), cat(b), cat(value)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": value})


def pair_values(kept: DataFrame, groups: DataFrame, lots: int) -> DataFrame:
    """-> ``lang, a, b, value``: numbers of the sources, ``a < b``."""
    lot = F.pmod(F.xxhash64("term"), F.lit(lots)).cast("int")
    mine = (F.col("number") / F.lit(BLOCK)).cast("int")
    blocks = F.sequence(F.lit(0), ((F.col("sources") - 1) / F.lit(BLOCK)).cast("int"))
    # A source goes to every pair of blocks that has its own.
    ends = F.explode(F.transform(blocks, lambda o: F.struct(F.least(o, mine).alias("low"), F.greatest(o, mine).alias("high"))))
    spread = groups.select("*", ends.alias("x")).select("*", "x.low", "x.high").drop("x")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    shares = shares.select("*", ends.alias("x")).select("lang", lot.alias("lot"), "x.low", "x.high", "number", "term", "p")
    # The terms of a lot as counted in the language, met by a block or not.
    sizes = kept.filter("head").groupBy("lang", lot.alias("lot")).agg(F.count(F.lit(1)).alias("base"))
    lot_zero = groups.select("lang", F.lit(0).alias("lot"), F.lit(0).cast("long").alias("base")).distinct()
    sizes = sizes.unionByName(lot_zero).groupBy("lang", "lot").agg(F.sum("base").alias("base"))
    sides = spread.join(sizes, "lang").select("lang", "lot", "low", "high", "number", "p0", "base")
    key = ["lang", "lot", "low", "high"]
    # Numbers travel as longs.
    sides = sides.withColumn("number", F.col("number").cast("long"))
    shares = shares.withColumn("number", F.col("number").cast("long"))
    parts = shares.groupBy(key).cogroup(sides.groupBy(key)).applyInArrow(_pair_sums, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))


OUTPUT = ("lang", "source", "part", "item", "value", "rank")


def diverging(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """-> ``lang, source, part, item, value, rank``."""
    kept = staged(kept_terms(docs, least_docs), "kept_terms")
    lots = parts_for(kept.filter("head").count(), LOT_TERMS)
    groups = staged(source_groups(docs, kept), "source_groups")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    pairs = pair_values(kept, groups, lots)
    names = groups.select("lang", F.col("number").cast("long").alias("number"), "source")
    one = names.select("lang", F.col("number").alias("a"), F.col("source").alias("one"))
    two = names.select("lang", F.col("number").alias("b"), F.col("source").alias("two"))
    named = pairs.join(one, ["lang", "a"]).join(two, ["lang", "b"])
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")),
                             F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    sources = named.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    sources = sources.withColumn("rank", F.row_number().over(by_value))

    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    over = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", _apart(F.col("p"), F.col("q")).alias("value"))
    terms = over.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return sources.unionByName(terms).select(*OUTPUT)
