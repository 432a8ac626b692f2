"""Randomised checks of the tokenizer and line splitter against plain-Python
models written from the rules (one Spark job per generated batch)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvid.functions import split_on_blank, text_lines


def blank_split_model(line: str) -> list[str]:
    """Split on each blank; trailing empty tokens are dropped; '' -> ['']."""
    if line == "":
        return [""]
    parts, cur = [], ""
    for ch in line:
        if ch == " ":
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    parts.append(cur)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def lines_model(text: str) -> list[str]:
    """LF, CRLF and CR end a line; a final terminator adds no line."""
    out, cur, i = [], "", 0
    ended = False
    while i < len(text):
        ch = text[i]
        if ch in "\r\n":
            out.append(cur)
            cur = ""
            if ch == "\r" and i + 1 < len(text) and text[i + 1] == "\n":
                i += 1
            ended = True
        else:
            cur += ch
            ended = False
        i += 1
    if text and not ended:
        out.append(cur)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=" ab", max_size=8), min_size=1, max_size=40))
def test_blank_split_matches_model(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: r.t for r in df.select("i", split_on_blank(F.col("line")).alias("t")).collect()}
    assert [got[i] for i in range(len(lines))] == [blank_split_model(s) for s in lines]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="a\r\n ", max_size=10), min_size=1, max_size=40))
def test_text_lines_matches_model(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, text string")
    got = {r.i: r.l for r in df.select("i", text_lines(F.col("text")).alias("l")).collect()}
    assert [got[i] for i in range(len(texts))] == [lines_model(s) for s in texts]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "a", "b", "ab", "B"]), max_size=12), min_size=1, max_size=30))
def test_term_counts_match_counter(spark, docs):
    from collections import Counter

    from corvid.functions import term_counts

    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "k int, t array<string>")
    got = {}
    for r in term_counts(df, "t", ["k"]).collect():
        got.setdefault(r.k, {})[r.word] = r.cnt
    want = {i: dict(Counter(d)) for i, d in enumerate(docs) if d}
    assert got == want
