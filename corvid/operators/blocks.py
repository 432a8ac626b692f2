"""Pairs of blocks of rows: all-pairs distance work spread over tasks.

A point set is dealt to blocks of about ``BLOCK_ROWS`` rows; a block is
one row of a DataFrame, its arrays packed as bytes. Work on all pairs of points
becomes work on pairs of blocks: a row for each pair meets its two blocks
through equi-joins on their numbers, one task holds two blocks at a
time, and what a pair yields is summed per block before the next step.

Blocks are dealt by hash (``packed``), or by place (``near_packed``): then a
block's box of coordinates tells which others can matter to it, and only those
pairs are made (``some_pairs``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import kcenter_kernels as kk

BLOCK_ROWS = 4096
BLOCK = "block long, rows int, dim int, ids binary, w binary, v binary"
SUB_ROWS = 512  # rows of a distance matrix at a time
LEAF_ROWS = 64  # rows that lie together within a block


@dataclass
class Block:
    """Rows with ``ids[0]`` as their order key."""

    order: np.ndarray
    point_id: np.ndarray
    w: np.ndarray
    X: np.ndarray


def block_of(row: dict) -> Block:
    """A packed row of ``BLOCK`` as arrays."""
    ids = np.frombuffer(row["ids"], np.int64).reshape(2, row["rows"])
    X = np.frombuffer(row["v"], np.float64).reshape(row["rows"], row["dim"])
    return Block(ids[0], ids[1], np.frombuffer(row["w"], np.int64), X)


def _packed_rows(blocks: list[tuple[int, np.ndarray]], table: pa.Table, X: np.ndarray) -> pa.Table:
    """``BLOCK`` rows of (block, its rows in the table, in their order)."""
    order, point_id, w = (table.column(c).to_numpy() for c in ("ord", "point_id", "w"))
    ids = [np.stack([order[at], point_id[at]]).astype(np.int64).tobytes() for _, at in blocks]
    return pa.table(
        {
            "block": pa.array([b for b, _ in blocks], pa.int64()),
            "rows": pa.array([len(at) for _, at in blocks], pa.int32()),
            "dim": pa.array([X.shape[1]] * len(blocks), pa.int32()),
            "ids": pa.array(ids, pa.binary()),
            "w": pa.array([w[at].astype(np.int64).tobytes() for _, at in blocks], pa.binary()),
            "v": pa.array([np.ascontiguousarray(X[at]).tobytes() for _, at in blocks], pa.binary()),
        }
    )


def _pack(table: pa.Table) -> pa.Table:
    X = kk.matrix(table.column("v"))
    at = kk.order_rows(table.column("ord").to_numpy(), X)
    return _packed_rows([(table.column("block")[0].as_py(), at)], table, X)


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """``ord, point_id, v, w`` -> one row a block (``BLOCK``)."""
    number = F.pmod(F.xxhash64("ord", "v"), F.lit(blocks)).cast("long").alias("block")
    return rows.select(number, "ord", "point_id", "v", "w").groupBy("block").applyInArrow(_pack, BLOCK)


CELLS = 1024
CELL_SAMPLE = 32  # rows that place a cell's cuts
GROUP_BLOCKS = 16  # blocks that one task cuts out of its rows
GROUP_NUMBERS = 1 << 24


def _cuts(X: np.ndarray, cells: int) -> list[tuple[int, float, int, int] | None]:
    """A tree of cuts (axis, value, lower child, upper child) along the widest
    spread; leaves are None. At most ``cells`` leaves."""
    nodes: list = [None]
    todo = [(0, X, cells)]
    while todo:
        at, own, most = todo.pop()
        if most < 2 or len(own) < 2:
            continue
        spread = own.max(axis=0) - own.min(axis=0)
        axis = int(np.argmax(spread))
        if not spread[axis] > 0:
            continue
        value = float(np.median(own[:, axis]))
        lower = own[:, axis] <= value
        if lower.all():
            lower = own[:, axis] < value
            value = float(own[lower, axis].max())
        nodes[at] = (axis, value, len(nodes), len(nodes) + 1)
        nodes += [None, None]
        todo += [(nodes[at][2], own[lower], most - most // 2), (nodes[at][3], own[~lower], most // 2)]
    return nodes


def _cell_of(X: np.ndarray, nodes: list) -> np.ndarray:
    """The leaf of each row."""
    inner = [n is not None for n in nodes]
    axis, value, lower, upper = (np.array([n[k] if n else 0 for n in nodes]) for k in range(4))
    at, rows = np.zeros(len(X), np.int64), np.arange(len(X))
    inner = np.array(inner)
    while len(rows := rows[inner[at[rows]]]):
        node = at[rows]
        at[rows] = np.where(X[rows, axis[node]] <= value[node], lower[node], upper[node])
    return at


def near_packed(rows: DataFrame, n: int, block_rows: int) -> DataFrame:
    """``ord, point_id, v, w`` (written, ``n`` rows) -> ``BLOCK`` rows of at most
    ``block_rows`` rows that lie together, in the order of ``kk.spatial_order``.

    Cells come from cuts through a bounded number of rows, which the driver
    sees; they only say where rows go. A cell with many rows is dealt by hash to
    groups of about ``GROUP_BLOCKS`` blocks, so that no task holds more, and
    each group is cut into blocks.
    """
    cells = min(CELLS, -(-n // block_rows))
    seen = rows.select("v").orderBy(F.xxhash64("ord", "v")).limit(cells * CELL_SAMPLE).toArrow() if cells > 1 else None
    nodes = _cuts(kk.matrix(seen.column("v")), cells) if cells > 1 else [None]

    def placed(batches):
        for batch in batches:
            cell = _cell_of(kk.matrix(batch.column("v")), nodes) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", *batch.schema.names])

    some = rows.select("ord", "point_id", "v", "w")
    at = some.mapInArrow(placed, "cell long, ord long, point_id long, v array<double>, w long")
    sizes = {r["cell"]: r["count"] for r in at.groupBy("cell").count().collect()}  # a row a cell
    lanes = [max(1, -(-sizes.get(c, 0) // (GROUP_BLOCKS * block_rows))) for c in range(len(nodes))]
    first = np.cumsum([0, *lanes[:-1]]).tolist()
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cell").cast("int"))
    group = (of(first) + F.pmod(F.xxhash64("ord", "v"), of(lanes))).cast("long").alias("group")

    def cut(table: pa.Table) -> pa.Table:
        X = kk.matrix(table.column("v"))
        start = table.column("group")[0].as_py() * GROUP_NUMBERS
        at = kk.order_rows(table.column("ord").to_numpy(), X)
        # As few blocks as can be, of nearly equal sizes, in whole leaves.
        size = -(-len(at) // (-(-len(at) // block_rows)))
        size = min(block_rows, -(-size // LEAF_ROWS) * LEAF_ROWS)
        at = at[kk.spatial_order(X[at], size)]
        own = [at[low : low + size] for low in range(0, len(at), size)]
        return _packed_rows([(start + i, a[kk.spatial_order(X[a], LEAF_ROWS)]) for i, a in enumerate(own)], table, X)

    return at.select(group, "ord", "point_id", "v", "w").groupBy("group").applyInArrow(cut, BLOCK)


def some_pairs(which: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``a, b`` and further columns -> with ``left`` and ``right``, the blocks of
    those numbers. A right block is sent once, to where its pairs meet it."""
    one = left.select(F.col("block").alias("a"), F.struct("*").alias("left"))
    two = right.select(F.col("block").alias("b"), F.struct("*").alias("right"))
    return one.join(which, "a").join(two, "b")


def pairs(left: DataFrame, right: DataFrame, blocks: int, ordered: bool = False) -> DataFrame:
    """-> ``a, b, left, right``: every block of ``left`` with every one of
    ``right``, numbered below ``blocks`` (``ordered``: only where ``a <= b``).
    Each block goes to its pairs by their numbers, which spread over the tasks."""
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    one = left.select(F.col("block").alias("a"), F.struct("*").alias("left"), F.explode(every).alias("b"))
    two = right.select(F.col("block").alias("b"), F.struct("*").alias("right"), F.explode(every).alias("a"))
    if ordered:
        one, two = one.filter("a <= b"), two.filter("a <= b")
    return one.join(two, ["a", "b"])


def map_rows(df: DataFrame, run: Callable[[dict], Iterator[dict] | list[dict]], schema: str) -> DataFrame:
    """``run`` for each row of packed arrays, one at a time."""
    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    names = spark_schema.names

    def each(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                found = list(run(row))
                if found:
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in found], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark_schema)
    return df.mapInArrow(each, schema)


def strips(X: np.ndarray, Y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, distances of some rows of ``X`` to all of ``Y``)."""
    for low in range(0, len(X), SUB_ROWS):
        yield low, kk.pairwise(X[low : low + SUB_ROWS], Y)


def boxes(packed_rows: DataFrame) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Numbers and boxes of the blocks: one row of a few numbers a block."""

    def run(row: dict) -> list[dict]:
        X = block_of(row).X
        return [{"block": row["block"], "low": X.min(axis=0).tolist(), "high": X.max(axis=0).tolist()}]

    found = map_rows(packed_rows.select("block", "rows", "dim", "ids", "w", "v"), run, "block long, low array<double>, high array<double>")
    rows = sorted(found.collect(), key=lambda r: r["block"])
    return [r["block"] for r in rows], np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])


def least_positive(packed_rows: DataFrame) -> float | None:
    """The least distance above 0 of two rows in blocks of ``near_packed``:
    within blocks first, then between those whose boxes can hold a smaller one."""
    numbers, low, high = boxes(packed_rows)
    spark = packed_rows.sparkSession
    least = np.inf
    for own in (True, False):
        which = [(a, a) for a in numbers] if own else []
        for i in range(0 if own else len(numbers)):
            near, _ = kk.box_distances(low[i : i + 1], high[i : i + 1], low[i + 1 :], high[i + 1 :])
            which += [(numbers[i], numbers[i + 1 + j]) for j in np.flatnonzero(near[0] < least).tolist()]
        if which:
            pairs = some_pairs(spark.createDataFrame(which, "a long, b long"), packed_rows, packed_rows)
            found = _least(pairs).first()["positive"]
            least = min(least, np.inf if found is None else found)
    return float(least) if least < np.inf else None


def least_distances(packed_rows: DataFrame, blocks: int) -> DataFrame:
    """-> one row ``least, positive``: the least distance of two rows and the
    least above 0 (null where there is none)."""
    return _least(pairs(packed_rows, packed_rows, blocks, ordered=True))


def _least(some: DataFrame) -> DataFrame:
    def run(pair: dict) -> list[dict]:
        a, b = block_of(pair["left"]), block_of(pair["right"])
        least, positive = np.inf, np.inf
        for low, d in strips(a.X, b.X):
            if pair["a"] == pair["b"]:
                d[np.arange(len(d))[:, None] + low >= np.arange(d.shape[1])[None, :]] = np.inf
            least = min(least, float(d.min(initial=np.inf)))
            positive = min(positive, float(d[d > 0].min(initial=np.inf)))
        return [{"least": least, "positive": positive}]

    every = map_rows(some, run, "least double, positive double")
    finite = lambda c: F.when(F.min(c) < F.lit(float("inf")), F.min(c)).alias(c)
    return every.agg(finite("least"), finite("positive"))
