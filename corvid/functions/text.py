"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line terminators of a text file (LF, CRLF, CR) and the token
# separator (one blank).
LINE_BREAK = r"\r\n|\n|\r"
TRAILING_LINE_BREAK = r"(\r\n|\n|\r)\z"
TOKEN_SEPARATOR = " "


def text_lines(text: Column) -> Column:
    """Lines of a text body as a text-file reader yields them.

    Lines end at LF, CRLF or CR; a terminator at the very end does not start
    another line, and an empty body has no lines at all. Bodies without CR
    (the common case) take a literal split on LF; only bodies with a CR pay
    for the regular expression.
    """
    no_trailing_lf = F.when(
        F.endswith(text, F.lit("\n")), F.left(text, F.length(text) - F.lit(1))
    ).otherwise(text)
    any_break = F.split(F.regexp_replace(text, TRAILING_LINE_BREAK, ""), LINE_BREAK, -1)
    return (
        F.when(text == F.lit(""), F.array().cast("array<string>"))
        .when(F.contains(text, F.lit("\r")), any_break)
        .otherwise(F.split(no_trailing_lf, "\n", -1))
    )


def split_on_blank(line: Column) -> Column:
    """Words of a line: split on every single blank, drop trailing empties.

    Leading and inner empty tokens are kept, an empty line is one empty
    token, and a line of blanks only has no tokens.
    """
    trimmed = F.rtrim(line)
    return (
        F.when(line == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, TOKEN_SEPARATOR, -1))
    )


def run_starts(s: Column) -> Column:
    """Start positions of the runs of equal values in a sorted array.

    ``s`` should be a column reference (materialised by an earlier
    projection): it is read once per element.
    """
    n = F.size(s)
    idx = F.sequence(F.lit(0), F.greatest(n - F.lit(1), F.lit(0)))
    return F.filter(
        idx, lambda i: (i < n) & ((i == F.lit(0)) | (F.get(s, i) != F.get(s, i - F.lit(1))))
    )


def run_counts(s: Column, starts: Column) -> Column:
    """``array<struct<word, cnt>>`` from a sorted array and its run starts.

    Both arguments should be column references; see ``term_counts``.
    """
    n = F.size(s)
    return F.transform(
        starts,
        lambda st, j: F.struct(
            F.get(s, st).alias("word"),
            (F.coalesce(F.get(starts, j + F.lit(1)), n) - st).cast("long").alias("cnt"),
        ),
    )


def term_counts(df: DataFrame, tokens: str, keep: list[str]) -> DataFrame:
    """Each distinct token of the array column ``tokens`` with its count,
    computed inside the row -> ``*keep, word, cnt``.

    The tokens are sorted so equal ones sit together; a run starts where a
    token differs from its predecessor, and its length is the distance to
    the next start: O(t log t) per row, no shuffle, no Python. The sorted
    array and the run starts are projected as columns first, so the
    optimizer evaluates each once per row instead of once per element.
    """
    cols = [F.col(c) for c in keep]
    sorted_df = df.select(*cols, F.sort_array(F.col(tokens)).alias("_s"))
    with_starts = sorted_df.select(*cols, "_s", run_starts(F.col("_s")).alias("_st"))
    return with_starts.select(*cols, F.inline(run_counts(F.col("_s"), F.col("_st"))))
