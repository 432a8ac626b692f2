"""Column expressions shared by the operators (JVM-side, no UDFs)."""

from corvid.functions.text import split_on_blank, term_counts, text_lines
from corvid.functions.vectors import distances_to, euclidean, nearest, to_double_vector

__all__ = [
    "distances_to",
    "euclidean",
    "nearest",
    "split_on_blank",
    "term_counts",
    "text_lines",
    "to_double_vector",
]
