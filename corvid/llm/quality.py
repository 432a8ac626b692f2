"""Quality classifier by co-training.

Two views of a document are classified apart: its text (presence of words and
word beginnings chosen by log odds, repetition of words) and its metadata
(language, source, length, layout ratios). Over ``ROUNDS`` rounds each view
labels pool documents it is sure of for the other, which is then trained
again; sure is a logit beyond which ``SURE`` of the held-out rows have the
label, so a view that cannot tell stays silent. Held-out labelled rows calibrate each view (Platt scaling); a document
is good when neither view finds it bad, so the score is the product of the
calibrated views over the share of wanted labels. It is taken for every
document in one narrow pass.

Only fitting is bounded: at most about ``LABELLED`` labelled documents and
``POOL`` others, picked by a hash of the id, and ``FEATURES`` chosen words. The
model (some 100 KB) goes to the tasks with the function; every document is
scored over its whole text.

A document is wanted when its label has quality 1 and toxic 0. Defined
results: null texts, languages and sources count as empty; several labels of
one id are rows of their own; without wanted or without unwanted labels every
document is kept with the score of the label share (1 without labels); repeated
rows score alike; an empty table gives no rows; further columns are ignored by
``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import slices, staged

LABELLED = 15_000
POOL = 6_000
FEATURES = 2048
LEAST_DOCS = 4
LEAST_G2 = 20.0  # log-likelihood ratio of a chosen word
ROUNDS = 3
SURE = 0.98
KEEP = 0.3
HELD_OUT = 4  # every fourth labelled row calibrates
PREFIXES = (4, 5, 6)
BUCKETS = 40
_WORD = re.compile(r"[^\W\d_]+")
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_features(words: set[str]) -> set[str]:
    """The words and, marked, their beginnings."""
    out = set(words)
    for n in PREFIXES:
        out.update([f"{w[:n]}*" for w in words if len(w) >= n])
    return out


def repetition(words: list[str], distinct: int) -> list[float]:
    """Text shape: new words per square root of words, share of words equal
    to the word before, mean word length."""
    n = max(1, len(words))
    same = sum(map(str.__eq__, words, words[1:]))
    return [distinct / n**0.5, distinct / n, same / n, sum(map(len, words)) / n]


def layout(text: str) -> list[float]:
    """Metadata shape: length and shares of capitals, symbols, digits and
    repeated lines, mean line length."""
    raw = text.encode()
    n = max(1, len(raw))
    lines = [x for x in text.split("\n") if x]
    return [
        float(len(text)),
        1 - len(raw.translate(None, _UPPER)) / n,
        1 - len(raw.translate(None, _SYMBOL)) / n,
        1 - len(raw.translate(None, _DIGIT)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        len(text) / max(1, len(lines)),
    ]


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


@dataclass
class View:
    """A logistic model over sparse 0/1 features: names, and bucketed numbers."""

    names: dict[str, int]
    edges: list[np.ndarray]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def size(self) -> int:
        return len(self.names) + sum(len(e) + 1 for e in self.edges) + 1

    def row(self, names, numbers: list[float]) -> list[int]:
        out = [self.names[x] for x in names if x in self.names]
        at = len(self.names)
        for e, v in zip(self.edges, numbers, strict=True):
            out.append(at + int(np.searchsorted(e, v)))
            at += len(e) + 1
        out.append(at)
        return out

    def logit(self, row: list[int]) -> float:
        return float(np.clip(self.weights[row].sum(), -9.0, 9.0))


def fit(
    rows: list[np.ndarray], y: np.ndarray, start: np.ndarray, steps: int = 250, l2: float = 1e-4
) -> np.ndarray:
    """Logistic regression by Adam over all rows at once, from ``start``."""
    size = len(start)
    at = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    w, m, v = start, np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        z = np.bincount(owner, weights=w[at], minlength=len(rows))
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(at, weights=err[owner], minlength=size) / len(rows) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _edges(column: np.ndarray) -> np.ndarray:
    most = max(4, min(BUCKETS, len(column) // 25))
    return np.unique(np.quantile(column, np.linspace(0, 1, most + 1)[1:-1]))


@dataclass
class Model:
    """``constant`` is the score of all documents when there was nothing to learn."""

    text: View | None = None
    meta: View | None = None
    scale: tuple = ()  # of each view: slope and shift of its logit
    constant: float = 1.0  # share of wanted labels

    def scores(self, text: str, lang: str, source: str) -> tuple[float, float, float]:
        if self.text is None:
            return self.constant, self.constant, self.constant
        words = words_of(text)
        distinct = set(words)
        t = self.text.logit(self.text.row(word_features(distinct), repetition(words, len(distinct))))
        m = self.meta.logit(self.meta.row([f"lang={lang}", f"source={source}"], layout(text)))
        p, q = (_sigmoid(a * z + b) for (a, b), z in zip(self.scale, (t, m), strict=True))
        return p, q, min(1.0, p * q / self.constant)


def _inputs(docs: DataFrame) -> DataFrame:
    none = F.lit("")
    return docs.select(
        "doc_id", *[F.coalesce(F.col(c).cast("string"), none).alias(c) for c in ("text", "lang", "source")]
    )


def _sample(docs: DataFrame, labels: DataFrame, labelled: int, pool: int) -> DataFrame:
    """Bounded sample by a hash of the id: label 1 (wanted), 0, null (pool)."""
    y = labels.select(
        "doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("y")
    ).filter("y is not null and doc_id is not null")
    n_docs, n_labels = docs.count(), y.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    text_words = F.split(F.lower("text"), r"\s+")
    least = F.array_min(  # near copies mostly share it: they count once
        F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.xxhash64(F.slice(F.col("w"), i, 3)))
    )
    few = max(labelled / max(1, n_labels), pool / max(1, n_docs))
    picked = docs.filter(share < few).join(y, "doc_id", "left")
    return picked.filter(
        (F.col("y").isNotNull() & (share < labelled / max(1, n_labels)))
        | (F.col("y").isNull() & (share < pool / max(1, n_docs)))
    ).withColumn("w", text_words).withColumn("least", least).drop("w").dropDuplicates(["least", "y"])


def _chosen_words(sample: DataFrame, features: int) -> list[str]:
    """Words and beginnings that tell the classes apart best, over the labelled
    sample: counted per task, summed by Spark."""

    def count(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in word_features(set(words_of(text))):
                    seen.setdefault(f, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string())]
                + [pa.array([c[k] for c in seen.values()], pa.int64()) for k in (0, 1)],
                names=["f", "bad", "good"],
            )

    known = sample.filter("y is not null")
    bad, good = known.filter("y = 0").count(), known.filter("y = 1").count()
    counts = known.select("text", "y").mapInArrow(count, "f string, bad long, good long")
    counts = counts.groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    n = F.col("bad") + F.col("good")

    def part(seen: str, of: int):
        c = F.col(seen)
        return F.when(c > 0, c * F.log(c * (bad + good) / (n * of))).otherwise(0.0)

    top = counts.filter(n >= LEAST_DOCS).withColumn("gain", 2 * (part("bad", bad) + part("good", good)))
    top = top.filter(F.col("gain") >= LEAST_G2)
    return [r["f"] for r in top.orderBy(F.desc("gain"), "f").limit(features).select("f").collect()]


def train(
    docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL, features: int = FEATURES
) -> Model:
    """Co-train on a bounded sample."""
    sample = staged(_sample(_inputs(docs), labels, labelled, pool), "quality-sample")
    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not classes.get(0) or not classes.get(1):
        n = classes.get(0, 0) + classes.get(1, 0)
        return Model(constant=classes.get(1, 0) / n if n else 1.0)
    chosen = {w: i for i, w in enumerate(_chosen_words(sample, features))}

    def view_rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for doc, text, lang, source, y in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = words_of(text)
                    distinct = set(words)
                    ids = [chosen[f] for f in word_features(distinct) if f in chosen]
                    out.append((doc, ids, repetition(words, len(distinct)), lang, source, layout(text), y))
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(out, columns=["doc_id", "ids", "rep", "lang", "source", "lay", "y"]), schema=schema,
                    preserve_index=False,
                )

    schema = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("rep", pa.list_(pa.float64())), ("lang", pa.string()),
         ("source", pa.string()), ("lay", pa.list_(pa.float64())), ("y", pa.int32())]
    )
    got = (
        sample.select(F.col("doc_id").cast("long"), "text", "lang", "source", "y")
        .mapInArrow(view_rows, "doc_id long, ids array<int>, rep array<double>, lang string, source string, lay array<double>, y int")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    rep, lay = np.array(got["rep"].tolist()), np.array(got["lay"].tolist())
    text = View(chosen, [_edges(c) for c in rep.T])
    kinds = [f"lang={x}" for x in got["lang"].value_counts().index[:64]] + [
        f"source={x}" for x in got["source"].value_counts().index[:256]
    ]
    meta = View({x: i for i, x in enumerate(kinds)}, [_edges(c) for c in lay.T])
    back = list(chosen)
    t_rows = [np.array(text.row([back[i] for i in ids], r), np.int32) for ids, r in zip(got["ids"], rep, strict=True)]
    m_rows = [
        np.array(meta.row([f"lang={a}", f"source={b}"], r), np.int32)
        for a, b, r in zip(got["lang"], got["source"], lay, strict=True)
    ]
    got = got[["y"]]
    y = got["y"].to_numpy(float)  # nan: pool
    known = np.flatnonzero(~np.isnan(y))
    held = known[np.arange(len(known)) % HELD_OUT == 0]
    if not 0 < y[held].sum() < len(held):
        held = known
    learn = np.setdiff1d(known, held) if len(held) < len(known) else known
    if not 0 < y[learn].sum() < len(learn):
        learn = known
    free = np.flatnonzero(np.isnan(y))
    given = {"text": (learn, y[learn]), "meta": (learn, y[learn])}
    for number in range(ROUNDS + 1):
        for name, view, rows in (("text", text, t_rows), ("meta", meta, m_rows)):
            at, target = given[name]
            start = np.zeros(view.size) if number == 0 else view.weights
            view.weights = fit([rows[i] for i in at], target, start, steps=250 if number == 0 else 100)
        if number == ROUNDS or not len(free):
            break
        for name, view, rows in (("meta", text, t_rows), ("text", meta, m_rows)):
            z = np.array([view.logit(rows[i]) for i in free])
            low, high = _sure(np.array([view.logit(rows[i]) for i in held]), y[held])
            sure = (z <= low) | (z >= high)
            given[name] = (
                np.concatenate([learn, free[sure]]),
                np.concatenate([y[learn], (z[sure] >= high).astype(float)]),
            )
    scale = tuple(
        _platt(np.array([v.logit(r[i]) for i in held]), y[held]) for v, r in ((text, t_rows), (meta, m_rows))
    )
    return Model(text, meta, scale, float(y[known].mean()))


def _sure(z: np.ndarray, y: np.ndarray, least: int = 20) -> tuple[float, float]:
    """Logits up to the first and from the second on, ``SURE`` of the rows are
    unwanted and wanted (infinite where no ``least`` rows are)."""
    order = np.argsort(z, kind="stable")
    z, y, n = z[order], y[order], np.arange(1, len(z) + 1)
    low = np.flatnonzero((np.cumsum(1 - y) / n >= SURE) & (n >= least))
    high = np.flatnonzero((np.cumsum(y[::-1]) / n >= SURE) & (n >= least))
    return (
        float(z[low[-1]]) if len(low) else -np.inf,
        float(z[::-1][high[-1]]) if len(high) else np.inf,
    )


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of logits, by damped Newton steps towards (1, 0)."""
    x, w = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1.0 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - y) + 1.0 * (w - np.array([1.0, 0.0])))
        w = w - np.clip(step, -0.5, 0.5)
    return float(max(w[0], 0.05)), float(w[1])


SCORES = "doc_id long, p_text double, p_meta double, score double, kept boolean"


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """-> ``doc_id, p_text, p_meta, score, kept``, a row per document."""

    def run(batches):
        for batch in slices(batches):
            docs_, texts, langs, sources = (c for c in batch.columns)
            out = [
                model.scores(t, a, b)
                for t, a, b in zip(texts.to_pylist(), langs.to_pylist(), sources.to_pylist(), strict=True)
            ]
            s = [pa.array([o[k] for o in out], pa.float64()) for k in range(3)]
            kept = pa.array([o[2] >= keep or model.text is None for o in out], pa.bool_())
            yield pa.RecordBatch.from_arrays([docs_, *s, kept], names=["doc_id", "p_text", "p_meta", "score", "kept"])

    rows = _inputs(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, SCORES)


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """``docs`` (``doc_id, text, lang, source``, further columns kept) without
    the rejected ones: one narrow pass after the fit, no join."""
    model = train(docs, labels)
    # Columns go by place: their names may be any.
    at = [docs.columns.index(c) for c in ("text", "lang", "source")]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches):
        for batch in slices(batches):
            rows = zip(*(batch.column(i).to_pylist() for i in at), strict=True)
            good = [model.text is None or model.scores(t or "", a or "", b or "")[2] >= keep for t, a, b in rows]
            yield batch.filter(pa.array(good, pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
