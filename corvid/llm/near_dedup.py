"""Near-duplicate groups by a chosen-path set similarity join.

1. A document's set is its distinct 5-word shingles (64-bit hashes). Documents
   with equal sets (by a 128-bit digest) form a class; one of them goes on.
2. Each set has ``HASHES`` minwise tokens. In each of ``TREES`` independent
   trees a document branches to the nodes of the tokens that the tree's hash
   selects, 1 / (threshold * HASHES) of them, so two documents over the
   threshold share one node or more in expectation. A node with more than
   ``NODE`` documents branches again, ``DEPTH`` levels at most.
3. Small nodes compare their documents' tokens exhaustively and link those
   whose estimated similarity is at most ``BELOW`` under the threshold (more
   than five standard deviations) as stars; nodes still large after the last
   level link all they hold. Components of these candidate links are clusters.
4. Links are confirmed on full sets. Every member meets its cluster's first
   document in a join (large clusters are dealt over many tasks); clusters with
   members that this does not link are compared exhaustively, in blocks of
   bounded size and all pairs of blocks. Only spanning links are emitted, never
   all pairs of a group.

A pair over the threshold shares no node in any tree with a probability of
about 0.4 ** TREES (0.53, 0.63 for nodes of the second and third level).

Defined results: null and blank texts have the empty set and link with
nothing; a document with fewer words than a shingle has one shingle of all of
them; rows that repeat an id share a component; rows with a null id link with
nothing and are kept; an empty table gives no rows; further columns are
ignored by ``near_groups`` and kept by ``drop_near``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import discard, staged
from corvid.llm.components import components
from corvid.llm.shingles import Words, mix, run_hashes, text_slices

WORDS = 5
HASHES = 128
TREES = 20
NODE = 200
DEPTH = 3
BELOW = 0.19  # candidates are estimated down to this far under the threshold
BLOCK = 1 << 21  # set elements of a block
_U = np.uint64


def _seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(salt))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for a, b in text_slices(texts):
        w = Words(texts[a:b], lower=True)
        runs = run_hashes(w.hashes, words)
        for i in range(b - a):
            lo, hi = int(w.first[i]), int(w.first[i + 1]) if i + 1 < len(w.first) else len(w.hashes)
            n = hi - lo
            if n >= words:
                out.append(np.unique(runs[lo : hi - words + 1]))
            elif n:
                out.append(run_hashes(w.hashes[lo:hi], n))
            else:
                out.append(np.zeros(0, _U))
    return out


def minwise(found: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, one for each multiplier (32 bits)."""
    low = np.full(len(multipliers), np.iinfo(_U).max, _U)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096, None] * multipliers
        low = np.minimum(low, (part ^ (part >> _U(29))).min(axis=0))
    return mix(low) >> _U(32)


def _chosen(path: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(path index, child key) of the tokens that each path selects. ``tokens``
    is one row of numbered tokens; the same token is selected by every document."""
    h = mix(path[:, None] ^ mix(tokens * _U(0xD1342543DE82EF95) + np.arange(tokens.shape[-1], dtype=_U)))
    limit = _U(int(2.0**64 / (threshold * tokens.shape[-1])))
    at, _ = np.nonzero(h < limit)
    return at, mix(h[h < limit])


SKETCH = "id long, n_shingles long, digest binary, tokens binary, keys array<long>"


def sketches(docs: DataFrame, id_col: str, text_col: str, threshold: float, trees: int) -> DataFrame:
    """-> ``id, n_shingles, digest, tokens`` (a byte each), ``keys`` of the
    tree nodes; digest, tokens and keys are null for the empty set."""
    multipliers = _seeds(HASHES, 11) | _U(1)
    roots = _seeds(trees, 77)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            n, digests, tokens, keys = [], [], [], []
            for found in shingle_sets(texts):
                n.append(len(found))
                if not len(found):
                    digests.append(None), tokens.append(None), keys.append(None)
                    continue
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                low = minwise(found, multipliers)
                tokens.append(low.astype(np.uint8).tobytes())
                keys.append(_chosen(roots, low, threshold)[1].view(np.int64))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            columns = [pa.array(c, k) for c, k in zip((n, digests, tokens, keys), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", "n_shingles", "digest", "tokens", "keys"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).mapInArrow(run, SKETCH)


def _branch(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows ``key, id, tokens`` of large nodes -> the rows of their children."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            paths = np.asarray(batch.column(0)).view(_U)
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, HASHES)
            owner, keys = [], []
            for i in range(len(paths)):
                _, k = _chosen(paths[i : i + 1], tokens[i].astype(_U), threshold)
                keys.append(k), owner.append(np.full(len(k), i))
            at = pa.array(np.concatenate(owner))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), batch.column(1).take(at)], names=["key", "id"]
            )

    return rows.select("key", "id", "tokens").mapInArrow(run, "key long, id long")


def _stars(labels: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each id to the least id with its label."""
    order = np.lexsort((ids, labels))
    first = np.concatenate([[True], np.diff(labels[order]) != 0])
    low = ids[order][np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))]
    keep = low != ids[order]
    return ids[order][keep], low[keep]


def _reach(n: int, near) -> np.ndarray:
    """Component labels of ``n`` items; ``near(i, rest)`` tells which of the
    unlabelled items ``rest`` are linked with ``i``. Each item is compared with
    the unlabelled ones only."""
    labels, rest = np.full(n, -1), np.arange(n)
    for seed in range(n):
        if labels[seed] >= 0:
            continue
        queue = [seed]
        labels[seed] = seed
        rest = rest[rest != seed]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            found = rest[hit]
            labels[found] = seed
            queue.extend(found.tolist())
            rest = rest[~hit]
        if not len(rest):
            break
    return labels


def _compare_nodes(leaves: DataFrame, tasks: int, estimate: float) -> DataFrame:
    """Rows ``key, id, tokens`` of small nodes -> candidate links ``a, b``."""
    least = int(np.ceil(estimate * HASHES))

    def run(batches):
        table = pa.Table.from_batches(list(batches)) if not isinstance(batches, pa.Table) else batches
        keys, ids = table["key"].to_numpy(), table["id"].to_numpy()
        tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), np.uint8).reshape(-1, HASHES)
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        a, b = [], []
        for node in np.split(order, cuts):
            if len(node) < 2:
                continue
            t = tokens[node]
            labels = _reach(len(node), lambda i, rest, t=t: (t[rest] == t[i]).sum(axis=1) >= least)
            x, y = _stars(labels, ids[node])
            a.append(x), b.append(y)
        a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b))
        pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    dealt = leaves.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(run, "a long, b long")


def candidate_links(
    classes: DataFrame, threshold: float, node: int = NODE, depth: int = DEPTH
) -> tuple[DataFrame, list[DataFrame]]:
    """``classes``: ``id, tokens, keys`` -> candidate links ``a, b``, and the
    staged tables that they are read from."""
    tokens = classes.select("id", "tokens")
    rows = classes.select(F.explode("keys").alias("key"), "id")
    links, used = None, []
    for level in range(depth):
        rows = staged(rows.distinct(), "paths")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
        shared = staged(rows.join(sizes.filter("n > 1"), "key"), "nodes")
        discard(rows)
        used.append(shared)
        leaves = shared.filter(F.col("n") <= node).select("key", "id").join(tokens, "id")
        n = shared.filter(F.col("n") <= node).count()
        found = _compare_nodes(leaves, max(1, n // 50_000 + 1), threshold - BELOW)
        large = shared.filter(F.col("n") > node)
        if level == depth - 1:
            found = found.unionByName(large.filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")))
        links = found if links is None else links.unionByName(found)
        if large.isEmpty():
            break
        rows = _branch(large.join(tokens, "id"), threshold)
    return links, used


def _sets(docs: DataFrame) -> DataFrame:
    """``cluster, id, text`` -> ``cluster, id, elements``."""

    def run(batches):
        for batch in batches:
            found = [x.view(np.int64) for x in shingle_sets(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
                names=["cluster", "id", "elements"],
            )

    return docs.select("cluster", "id", "text").mapInArrow(run, "cluster long, id long, elements array<long>")


def _linked(inter, n, m, percent: int):
    return F.lit(100) * inter >= F.lit(percent) * (n + m - inter)


def _compare_blocks(rest: DataFrame, percent: int, block: int) -> DataFrame:
    """Exhaustive comparison of clusters ``cluster, id, elements`` -> links.
    A cluster of several blocks is compared in all pairs of blocks."""
    size = rest.groupBy("cluster").agg(F.sum(F.size("elements")).alias("total"))
    dealt = rest.join(
        size.select("cluster", F.ceil(F.col("total") / F.lit(block)).cast("int").alias("blocks")), "cluster"
    ).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")),
    )
    dealt = dealt.withColumn("pair", F.explode(pairs)).select("cluster", "pair.i", "pair.j", "id", "elements")

    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        column = table["elements"].combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        values = column.flatten().to_numpy()
        sizes = np.diff(column.offsets.to_numpy())
        order = np.argsort(sizes, kind="stable")  # only sets of like size can link
        ids, starts, sizes = ids[order], column.offsets.to_numpy()[:-1][order] - column.offsets[0].as_py(), sizes[order]
        _, codes = np.unique(values, return_inverse=True)
        mark = np.zeros(codes.max(initial=-1) + 1, bool)

        def near(i: int, rest: np.ndarray) -> np.ndarray:
            hit = np.zeros(len(rest), bool)
            lo, hi = np.searchsorted(sizes[rest], [percent * sizes[i] / 100, 100 * sizes[i] / percent + 1])
            own = codes[starts[i] : starts[i] + sizes[i]]
            mark[own] = True
            for k in range(lo, hi):
                r = rest[k]
                inter = int(np.count_nonzero(mark[codes[starts[r] : starts[r] + sizes[r]]]))
                hit[k] = 100 * inter >= percent * (sizes[i] + sizes[r] - inter)
            mark[own] = False
            return hit

        a, b = _stars(_reach(len(ids), near), ids)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def confirmed_links(sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Clusters ``cluster, id, elements`` (the cluster is its least id) ->
    links ``a, b`` that connect exactly the documents that true links connect."""
    pivot = sets.filter("id = cluster").select("cluster", F.col("elements").alias("first"))
    inter = F.size(F.array_intersect("elements", "first"))
    met = staged(
        sets.join(pivot, "cluster").select(
            "cluster",
            "id",
            _linked(inter, F.size("elements"), F.size("first"), percent).alias("linked"),
        ),
        "met",
    )
    stars = met.filter("linked and id <> cluster").select(F.col("id").alias("a"), F.col("cluster").alias("b"))
    unlinked = met.filter("not linked").select("cluster").distinct()
    rest = sets.join(unlinked, "cluster", "left_semi")
    return stars.unionByName(_compare_blocks(rest, percent, block))


def near_groups(
    docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    trees: int = TREES, node: int = NODE, depth: int = DEPTH, block: int = BLOCK,
) -> DataFrame:
    """-> ``<id_col>, n_shingles, component_id, kept``."""
    return _near_groups(docs, percent, id_col, text_col, trees, node, depth, block)[0]


def _near_groups(
    docs: DataFrame, percent: int, id_col: str, text_col: str,
    trees: int = TREES, node: int = NODE, depth: int = DEPTH, block: int = BLOCK,
) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of ``near_groups``, and the large staged tables that they are
    read from."""
    threshold = percent / 100
    sketch = staged(sketches(docs, id_col, text_col, threshold, trees), "sketches")
    known = sketch.filter("digest is not null and id is not null")
    classes = staged(
        known.groupBy("digest").agg(
            F.min("id").alias("id"), F.first("tokens").alias("tokens"), F.first("keys").alias("keys")
        ),
        "classes",
    )
    candidates, used = candidate_links(classes, threshold, node, depth)
    clusters = components(candidates).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    discard(*used)
    clusters = staged(
        clusters.unionByName(clusters.select(F.col("cluster").alias("id"), "cluster").distinct()), "clusters"
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Rows that repeat an id and text would meet themselves; one is enough.
    sets = staged(_sets(texts.join(clusters, "id")), "sets")
    links = components(confirmed_links(sets, percent, block))
    discard(sets, clusters)
    found = classes.select("digest", F.col("id").alias("node")).join(links, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component")
    )
    groups = sketch.join(found, "digest", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )
    return groups, [sketch, classes]


def drop_near(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, all columns kept."""
    groups, used = _near_groups(docs, percent, id_col, text_col)
    dropped = staged(groups.filter("not kept").select(id_col), "near")
    discard(*used)
    return docs.join(dropped, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
