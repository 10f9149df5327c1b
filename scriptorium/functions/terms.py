"""Search terms of a text: lower-cased runs of letters and digits; runs of CJK characters also give their bigrams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BREAK = r"[^\p{L}\p{N}]+"
CJK = r"[㐀-䶿一-鿿぀-ヿ가-힯]"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAK), lambda w: w != "")


def terms(text: Column) -> Column:
    """Words, and for each CJK run of two characters or more its overlapping pairs."""
    runs = F.filter(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({CJK}{{2,}})"), F.lit(1)), lambda r: F.length(r) > 1)
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))))
    return F.concat(words(text), pairs)
