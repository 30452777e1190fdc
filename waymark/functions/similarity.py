"""Token-set similarity of names, vectorised over distinct pairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .binding import let


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 and more columns at a time in one integer."""
    spots: dict[str, int] = {}
    for k, c in enumerate(a):
        spots[c] = spots.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & spots.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 0.0


def token_set_ratio(a: str | None, b: str | None) -> float:
    """100 when one name's words are all among the other's; else the best ratio of shared and differing words."""
    left, right = set((a or "").split()), set((b or "").split())
    if not left or not right:
        return 0.0
    shared = " ".join(sorted(left & right))
    if shared and (left <= right or right <= left):
        return 100.0
    ours, theirs = (" ".join(filter(None, [shared, " ".join(sorted(x))])) for x in (left - right, right - left))
    best = indel_ratio(ours, theirs)
    return max(best, indel_ratio(shared, ours), indel_ratio(shared, theirs)) if shared else best


def bound(a: Column, b: Column) -> Column:
    """No less than the ratio of two names, from their words' letters as bags: what is common in order is common in bags.

    Where one name's words are all among the other's it is 100, and the parts of the ratio that compare
    the shared words with either name are exact; a millionth more than rounding can take away.
    """

    def of(words: Column) -> Column:
        x, y = words["x"], words["y"]
        shared = F.array_intersect(x, y)
        whole = lambda w: F.length(F.array_join(w, " "))
        inside = (F.size(shared) > 0) & ((F.size(shared) == F.size(x)) | (F.size(shared) == F.size(y)))
        n, m, s = whole(x), whole(y), whole(shared)
        common = F.size(F.array_intersect(_bag(x), _bag(y)))
        parts = F.greatest(200.0 * common / (n + m), F.when(s > 0, 200.0 * s / (s + n)).otherwise(0.0), F.when(s > 0, 200.0 * s / (s + m)).otherwise(0.0))
        return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).when(inside, 100.0).otherwise(parts + 1e-6)

    words = lambda c: F.filter(F.array_distinct(F.split(F.coalesce(c, F.lit("")), r"\s+")), lambda w: w != "")
    return let(F.struct(words(a).alias("x"), words(b).alias("y")), of)


def _bag(words: Column) -> Column:
    """The letters of words with blanks between, each with its number among equal ones, so that sets of them intersect as bags do."""
    letters = F.array_sort(F.split(F.array_join(words, " "), ""))
    return let(letters, lambda cs: F.transform(cs, lambda c, k: F.concat(c, (k + 1 - F.array_position(cs, c)).cast("string"))))


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(a, b, strict=True):
        if pair not in known:
            known[pair] = token_set_ratio(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def ratio(a: Column, b: Column) -> Column:
    """Similarity of two name keys from 0 to 100."""
    return _ratio(a, b)
