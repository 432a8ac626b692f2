"""Tables for the tests of this folder."""

import random
from functools import lru_cache

SMALL = "/root/testdata/sf0.001"
# Further columns have names that the operators use inside.
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, spans string, row long,"
    " key string, rest string"
)
VOCABULARY = "the of and a river stone light over under winter garden old new seven paper house blue".split()


def make_docs(spark, texts, ids=None, partitions=3):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), 7, "x", 9, "k", "r") for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, DOCS)
    return df.repartition(partitions, "doc_id") if rows else df


@lru_cache(maxsize=1)
def sample():
    """(id, text) rows of the smallest documents table, by id."""
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"])
    return sorted(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))


@lru_cache(maxsize=1)
def awkward():
    """Null, empty, blank and long texts, copies and near copies, shared
    passages, texts without spaces, repeated words, several scripts."""
    r = random.Random(5)
    words = lambda n: " ".join(r.choice(VOCABULARY) + str(r.randrange(400)) for _ in range(n))
    base, passage, long = words(120), words(60), words(9000)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", "   \n\t ", "x", base, base, base.upper(), " ".join(near), long, long + " tail", "ab" * 900]
    texts += [words(30) + " " + passage + " " + words(20) for _ in range(4)]
    texts += ["again " * 200, "日本語テキスト。" * 60, "é ß 🎉\x0b" + passage, passage, "same same", "same same"]
    return texts
