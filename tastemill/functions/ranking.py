"""Per-user ranking metrics over a sorted array of hit positions.

``hits`` holds the 1-based positions of relevant items in one prediction list,
ascending; ``n_relevant`` is the user's number of distinct relevant items. Both
are all the metrics need, and ``hits`` is never longer than the list itself.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def average_precision(hits: Column, n_relevant: Column) -> Column:
    """Mean over relevant items of the precision at each hit; whole list, no cut at k."""
    precisions = F.transform(hits, lambda pos, i: (i + F.lit(1)).cast("double") / pos)
    total = F.aggregate(precisions, F.lit(0.0), lambda acc, p: acc + p)
    return total / n_relevant


def ndcg(hits: Column, n_relevant: Column, k: int) -> Column:
    """Binary-gain DCG of the first k positions over that of an ideal list."""
    gains = F.transform(
        F.filter(hits, lambda pos: pos <= k),
        lambda pos: F.lit(1.0) / F.log((pos + F.lit(1)).cast("double")),
    )
    dcg = F.aggregate(gains, F.lit(0.0), lambda acc, g: acc + g)
    ideal = F.array(*map(F.lit, accumulate(1.0 / math.log(i + 1) for i in range(1, k + 1))))
    return dcg / F.element_at(ideal, F.least(n_relevant, F.lit(k)).cast("int"))


def precision(hits: Column, k: int) -> Column:
    """Hits in the first k positions over k, also when the list is shorter."""
    return F.size(F.filter(hits, lambda pos: pos <= k)) / F.lit(float(k))
