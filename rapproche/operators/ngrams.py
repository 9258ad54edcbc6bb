"""Character n-grams of tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def character_ngrams(token: Column, min_n: int = 3, max_n: int = 6) -> Column:
    """Distinct substrings of min_n to max_n characters of the token in angle brackets."""
    marked = F.concat(F.lit("<"), token, F.lit(">"))

    def of_size(n: int) -> Column:
        starts = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))))
        return F.coalesce(F.transform(starts, lambda i: F.substring(marked, i, F.lit(n))), F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of_size(n) for n in range(min_n, max_n + 1)]))
