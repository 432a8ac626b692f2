"""Windows of ``width`` items that repeat across a corpus: the steps shared by
the substring dedup operators.

Windows are found through anchors. Each window's least ``gram``-item hash (its
minimizer) depends on the window alone, so equal windows share it and hold it
at the same place; a corpus has about ``2 / (width - gram + 2)`` anchors per
item.

1. Anchor values are counted (partially aggregated, one row per task for a
   frequent one); values that occur once cannot lie in a repeated window.
2. Runs of windows with a repeated value become contexts, the items from the
   first window's start to the last one's end. Within a task, of contexts with
   equal items only the earliest goes on to be compared: the others are repeats
   for certain and are dealt in small lots by document, not by key. So of a passage
   that a third of all documents share, each task that reads documents sends
   its key's group a context or, where ids do not ascend, a few.
   Values that occur more than ``frequent`` times send every window by itself,
   keyed by all its items: a group then holds equal windows only. Windows that
   are known to be repeats go out as runs whichever way they are keyed.
3. Contexts are grouped by key; the operator orders each group's windows and
   tells which have an earlier equal (``judge``). Of equal contexts a group
   keeps the earliest as it unpacks them, and numbers alone of the others.
4. Repeated windows return to their documents, which remove what they cover.

Steps 2 and 4 read the documents dealt by id; Spark reuses that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import slices, staged
from corvid.llm.shingles import mix, run_hashes

_U = np.uint64
LONGEST_RUN = 4096  # windows in one context
FREQUENT = 20_000
CONTEXTS = 6_000  # repeated anchors in one group
BATCH_ROWS = 2_500  # documents whose contexts a task holds at a time
TOGETHER = 1_000  # contexts without codes that are dealt to one task


@dataclass
class Items:
    """The items of several texts: ``codes`` (what contexts carry), the hashes
    of each ``gram`` of them, and where each text's items begin."""

    codes: np.ndarray
    grams: np.ndarray
    first: np.ndarray

    def bounds(self, i: int) -> tuple[int, int]:
        return int(self.first[i]), int(self.first[i + 1])


@dataclass
class Method:
    """What the two operators differ in."""

    width: int
    gram: int
    items: Callable[[list], Iterator[tuple[int, int, Items]]]  # texts -> (from, to, Items)
    inside: bool  # repeats within one document count
    judge: Callable  # (keys, doc, start, windows, codes, offsets) -> earlier-equal flags per window


def sliding(values: np.ndarray, w: int, fold) -> np.ndarray:
    """``fold`` (np.minimum or np.maximum) of each ``w`` consecutive values:
    folds from block starts and block ends, met in the middle."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % w
    full = np.concatenate([values, np.full(pad, values[-1], values.dtype)]).reshape(-1, w)
    ahead = fold.accumulate(full, axis=1).reshape(-1)
    back = fold.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return fold(back[:n], ahead[w - 1 : w - 1 + n])


def least_grams(items: Items, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(least gram hash of each window, owner text of each window or -1 where
    the window would leave its text)."""
    n = len(items.codes) - width + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    least = sliding(items.grams, width - gram + 1, np.minimum)[:n]
    # Windows of text i start in first[i] .. first[i + 1] - width.
    size = np.diff(items.first)
    starts = np.maximum(size - width + 1, 0)
    owner = np.repeat(
        np.stack([np.arange(len(size)), np.full(len(size), -1)], axis=1).reshape(-1),
        np.stack([starts, size - starts], axis=1).reshape(-1),
    )
    return least, owner[:n]


def anchors(items: Items, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, value) of each anchor position."""
    least, owner = least_grams(items, width, gram)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    w = width - gram + 1
    shown = np.where(owner >= 0, least, _U(0))
    most = sliding(np.concatenate([np.zeros(w - 1, _U), shown, np.zeros(w - 1, _U)]), w, np.maximum)
    at = np.flatnonzero((items.grams[: len(most)] == most) & (most > 0))
    return np.searchsorted(items.first, at, side="right") - 1, items.grams[at]


def text_of(row: pa.StructArray) -> pa.Array:
    """The field ``text`` of a column of structs."""
    return pc.struct_field(row, "text")


def _occurrences(docs: DataFrame, m: Method) -> DataFrame:
    """-> ``value, id, n``: anchors per document."""

    def run(batches):
        for batch in slices(batches):
            ids = batch.column(0)
            for a, _, items in m.items(batch.column(1).to_pylist()):
                text, value = anchors(items, m.width, m.gram)
                order = np.lexsort((value, text))
                text, value = text[order], value[order]
                new = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (np.diff(value) != 0)])) if len(text) else np.zeros(0, int)
                counts = np.diff(np.concatenate([new, [len(text)]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[new].view(np.int64)), ids.take(pa.array(text[new] + a)), pa.array(counts.astype(np.int32))],
                    names=["value", "id", "n"],
                )

    return docs.mapInArrow(run, "value long, id long, n int")


CONTEXT = "task int, packed binary"


def _packed(keys: np.ndarray, ids: np.ndarray, starts: np.ndarray, windows: np.ndarray, codes: list[bytes]) -> bytes:
    """Contexts as one compressed string; those without codes have their
    number of windows negated."""
    counts = np.where([c is None for c in codes], -windows, windows).astype(np.int32)
    parts = [keys.astype(np.int64), ids.astype(np.int64), starts.astype(np.int32), counts]
    raw = b"".join([p.tobytes() for p in parts] + [c for c in codes if c is not None])
    head = np.array([len(keys), len(raw)], np.int64).tobytes()
    return head + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpacked(packed: bytes, width: int, itemsize: int) -> tuple:
    """(keys, ids, starts, windows, codes) of the contexts with codes in a
    packed string, as lists, and (ids, starts, windows) of the others."""
    n, size = np.frombuffer(packed[:16], np.int64).tolist()
    raw = pa.Codec("zstd").decompress(packed[16:], size, asbytes=True)
    keys, ids = (np.frombuffer(raw, np.int64, n, 8 * n * k) for k in (0, 1))
    starts, counts = (np.frombuffer(raw, np.int32, n, 16 * n + 4 * n * k) for k in (0, 1))
    live = counts > 0
    known = [ids[~live], starts[~live], -counts[~live]]
    keys, ids, starts, counts = (c[live] for c in (keys, ids, starts, counts))
    ends = np.cumsum((counts.astype(np.int64) + width - 1) * itemsize) + 24 * n
    begin = np.concatenate([[24 * n], ends])[:-1]
    codes = [raw[a:b] for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
    return keys.tolist(), ids.tolist(), starts.tolist(), counts.tolist(), codes, known


def _runs(least: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, windows) of runs of windows with one value in one text."""
    cut = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    at = np.concatenate([[0], np.flatnonzero(cut) + 1])
    size = np.diff(np.concatenate([at, [len(least)]]))
    return at[owner[at] >= 0], size[owner[at] >= 0]


def _shortened(at: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs in pieces of at most ``most`` windows."""
    pieces = -(-size // most)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    end = np.repeat(at + size, pieces)
    at = np.repeat(at, pieces) + nth * most
    return at, np.minimum(most, end - at)


def _joined(contexts: list[tuple]) -> list[tuple]:
    """Contexts in the order of their places; those known to be repeats (codes
    None) become one run where they meet, whatever their keys: a run of windows
    is one entry, however long the passage and however its windows are keyed."""
    out: list[tuple] = []
    end = None  # (document, window behind) of the last entry, if it is known
    for context in contexts:
        key, doc, start, n, codes = context
        if codes is None and end == (doc, start):
            last = out[-1]
            out[-1] = (last[0], doc, last[2], last[3] + n, None)
        else:
            out.append(context)
        end = (doc, start + n) if codes is None else None
    return out


def _contexts(rows: DataFrame, m: Method, tasks: int) -> DataFrame:
    """``id, row, cand`` (repeated values: value, frequent), by id -> contexts,
    packed by the task that compares their keys. A context without codes is
    already known to be repeated; its task follows the document and place of the
    first of at most ``TOGETHER``, so that a key's repeats spread. What repeats in a batch is remembered for the
    task's next ones."""

    def run(batches):
        before: dict[tuple, tuple[int, int]] = {}
        for batch in (b.slice(low, BATCH_ROWS) for b in batches for low in range(0, b.num_rows, BATCH_ROWS)):
            order = np.argsort(batch.column(0).to_numpy(), kind="stable")
            batch = batch.take(pa.array(order))
            ids = batch.column(0).to_numpy()
            cand = batch.column(2).to_pylist()
            texts = text_of(batch.column(1)).to_pylist()
            seen: dict[tuple, tuple[int, int]] = {}
            again: set[tuple] = set()
            out: list[tuple] = []
            for a, b, items in m.items(texts):
                least, owner = least_grams(items, m.width, m.gram)
                if not len(least):
                    continue
                at, size = _runs(least, owner)
                of, value = owner[at], least[at]
                repeated, frequent = np.zeros(len(at), bool), np.zeros(len(at), bool)
                edges = np.searchsorted(of, np.arange(b - a + 1))
                for i in range(a, b):
                    lo, hi = edges[i - a], edges[i - a + 1]
                    if hi <= lo or not cand[i]:
                        continue
                    for flag, into in ((False, repeated), (True, frequent)):
                        known = np.array([c["value"] for c in cand[i] if c["frequent"] == flag], np.int64)
                        into[lo:hi] = np.isin(value[lo:hi], known.view(_U))
                alone, _ = _shortened(at[frequent], size[frequent], 1)
                at, size = _shortened(at[repeated], size[repeated], LONGEST_RUN)
                keys = least[at]
                if len(alone):
                    windows = np.lib.stride_tricks.sliding_window_view(items.codes, m.width)[alone]
                    whole = np.zeros(len(alone), _U)
                    for j in range(m.width):
                        whole = mix(whole * _U(0x9E3779B97F4A7C15) + windows[:, j].astype(_U))
                    at, size = np.concatenate([at, alone]), np.concatenate([size, np.ones(len(alone), size.dtype)])
                    keys = np.concatenate([keys, whole])
                    order = np.argsort(at, kind="stable")
                    at, size, keys = at[order], size[order], keys[order]
                text = owner[at]
                begin = items.first[text]
                for s, n, k, t, f in zip(at.tolist(), size.tolist(), keys.view(np.int64).tolist(), text.tolist(), begin.tolist(), strict=True):
                    codes = items.codes[s : s + n + m.width - 1].tobytes()
                    doc = int(ids[t + a])
                    # Texts come by id and position, so what was seen is earlier,
                    # but for rows that repeat an id.
                    here = (doc, s - f)
                    first = seen.setdefault((k, codes), here)
                    if first is not here:
                        again.add((k, codes))
                    first = min(first, before.get((k, codes), first))
                    known = first[0] != doc or (m.inside and first[1] < s - f)
                    out.append((k, doc, s - f, n, None if known else codes))
            for c in again | (before.keys() & seen.keys()):
                before[c] = min(seen[c], before.get(c, seen[c]))
            if not out:
                continue
            out = _joined(out)
            key, doc, start, windows, codes = zip(*out, strict=True)
            key, doc, start, windows = (np.array(c, np.int64) for c in (key, doc, start, windows))
            known = np.array([c is None for c in codes])
            at = np.flatnonzero(known)
            lead = at[np.arange(len(at)) // TOGETHER * TOGETHER]
            by = key.view(_U).copy()
            by[at] = mix(doc[lead].view(_U)) + start[lead].view(_U)
            task = (mix(by) % _U(tasks)).astype(np.int32)
            order = np.argsort(task, kind="stable")
            cuts = np.flatnonzero(np.diff(task[order])) + 1
            groups = np.split(order, cuts)
            packed = [_packed(key[g], doc[g], start[g], windows[g], [codes[i] for i in g]) for g in groups]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task[g[0]] for g in groups], pa.int32()), pa.array(packed, pa.binary())],
                names=["task", "packed"],
            )

    return rows.select("id", "row", "cand").mapInArrow(run, CONTEXT)


def _collapsed(keys: list, ids: list, starts: list, windows: list, codes: list, m: Method) -> tuple[list, list]:
    """(contexts known to be repeats, contexts to compare), as places: of
    equal contexts the earliest goes on, and of keys with one context none
    that cannot repeat itself."""
    first: dict[tuple, int] = {}
    known, go_on = [], []
    for i in sorted(range(len(keys)), key=lambda i: (ids[i], starts[i])):
        j = first.setdefault((keys[i], codes[i]), i)
        if j == i:
            go_on.append(i)
        elif ids[j] != ids[i] or (m.inside and starts[j] != starts[i]):
            known.append(i)
        elif not m.inside and starts[j] != starts[i]:
            go_on.append(i)  # a repeat in one document shares the first one's fate
    count: dict[int, int] = {}
    for i in go_on:
        count[keys[i]] = count.get(keys[i], 0) + 1

    def repeats_itself(i: int) -> bool:
        """Windows that are equal begin with the same items."""
        step = len(codes[i]) // (windows[i] + m.width - 1)
        heads = {codes[i][k * step : (k + m.gram) * step] for k in range(windows[i])}
        return len(heads) < windows[i]

    return known, [i for i in go_on if count[keys[i]] > 1 or m.inside and repeats_itself(i)]


def _judged(contexts: DataFrame, m: Method, dtype) -> DataFrame:
    """-> ``id, start, windows``: runs of windows that have an earlier equal."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int32()), ("windows", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        lists: list[list] = [[], [], [], [], []]
        numbers: list[list] = [[], [], []]
        held: dict[tuple, int] = {}  # place in the lists of the earliest of equal contexts
        for packed in table["packed"]:
            *more, gone = _unpacked(packed.as_py(), m.width, np.dtype(dtype).itemsize)
            for into, column in zip(numbers, gone, strict=True):
                into.append(column)
            late: list[tuple[int, int, int]] = []
            for context in zip(*more, strict=True):
                key, doc, start, n, codes = context
                j = held.setdefault((key, codes), len(lists[0]))
                if j < len(lists[0]) and lists[1][j] != doc:
                    earlier = (lists[1][j], lists[2][j])
                    late.append((max(doc, earlier[0]), start if doc > earlier[0] else earlier[1], n))
                    if doc < earlier[0]:
                        lists[1][j], lists[2][j] = doc, start
                    continue
                for into, value in zip(lists, context, strict=True):
                    into.append(value)
            for into, k in zip(numbers, range(3), strict=True):
                into.append(np.array([x[k] for x in late], np.int64))
        keys, ids, starts, windows, codes = lists
        known, live = _collapsed(keys, ids, starts, windows, codes, m)
        for into, column in zip(numbers, (ids, starts, windows), strict=True):
            into.append(np.array([column[i] for i in known], np.int64))
        done = pa.table([pa.array(np.concatenate(c).astype(f.type.to_pandas_dtype())) for c, f in zip(numbers, schema, strict=True)], schema=schema)
        if not live:
            return done
        key, doc, start, n = (np.array([c[i] for i in live], np.int64) for c in (keys, ids, starts, windows))
        items = np.frombuffer(b"".join([codes[i] for i in live]), dtype)
        # Every window of every context, and where its codes begin.
        size = n + m.width - 1
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        place = (np.cumsum(size) - size)[row] + nth
        again = m.judge(items, place, key[row], doc[row], start[row] + nth)
        at = np.flatnonzero(again)
        if not len(at):
            return done
        cut = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row[at]) != 0)])
        head = at[cut]
        length = np.diff(np.concatenate([np.flatnonzero(cut), [len(at)]]))
        found = [doc[row[head]], (start[row] + nth)[head].astype(np.int32), length.astype(np.int32)]
        return pa.concat_tables([done, pa.table(found, schema=schema)])

    return contexts.groupBy("task").applyInArrow(run, "id long, start int, windows int")


def repeated_windows(docs: DataFrame, m: Method, dtype, frequent: int = FREQUENT, tasks: int | None = None) -> DataFrame:
    """``docs``: ``id`` (not null) and ``row``, a struct with a field ``text``
    -> the same and ``spans``: for every document its runs of windows
    (``start, windows``) with an earlier equal. The texts stay inside ``row``
    so that both joins read one exchange of the documents."""
    # The counts are partially aggregated; several anchors in one document
    # count as repeats only where the method looks inside documents.
    seen = _occurrences(docs.select("id", F.col("row.text").alias("text")), m)
    n = F.sum("n") if m.inside else F.count(F.lit(1))
    known = staged(seen.groupBy("value").agg(n.alias("n")).filter("n > 1"), "anchors")
    cand = seen.select("value", "id").join(known, "value").groupBy("id").agg(
        F.collect_list(F.struct("value", (F.col("n") > frequent).alias("frequent"))).alias("cand")
    )
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Sorted, a task run again sends the same contexts (the join mostly sorts).
    rows = docs.join(cand, "id").sortWithinPartitions("id")
    contexts = _contexts(rows, m, tasks or max(1, total // CONTEXTS + 1))
    spans = (
        _judged(contexts, m, dtype)
        .groupBy("id")
        .agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    )
    return docs.join(spans, "id", "left")


def covered(n: int, spans: list[dict] | None, width: int) -> np.ndarray:
    """Flags of the items that the windows of ``spans`` cover."""
    if not spans:
        return np.zeros(n, bool)
    edge = np.zeros(n + 1, np.int64)
    start = np.array([s["start"] for s in spans])
    np.add.at(edge, start, 1)
    np.add.at(edge, start + np.array([s["windows"] for s in spans]) + width - 1, -1)
    return np.cumsum(edge[:n]) > 0


def sequence_ranks(codes: np.ndarray, width: int, place: np.ndarray) -> np.ndarray:
    """Rank in lexical order of the ``width`` codes that start at each of the
    places: codes are packed into 64 bits, then ranks are doubled in length.
    Every place is followed by ``width`` codes."""
    have = min(8 // codes.itemsize, width)
    bits = _U(8 * codes.itemsize % 64)
    packed = codes.astype(_U) if have == 1 else np.zeros(len(codes), _U)
    for j in range(have if have > 1 else 0):
        packed <<= bits
        packed[: len(codes) - j] |= codes[j:].astype(_U)
    while have < width:
        step = min(have, width - have)
        rank = np.unique(packed, return_inverse=True)[1].astype(_U)
        if have + step == width:
            packed = (rank[place] << _U(32)) | rank[place + step]
            return np.unique(packed, return_inverse=True)[1]
        packed = rank << _U(32)
        packed[: len(rank) - step] |= rank[step:] + _U(1)
        have += step
    return np.unique(packed[place], return_inverse=True)[1]


__all__ = ["Items", "Method", "covered", "repeated_windows", "run_hashes", "sequence_ranks"]
