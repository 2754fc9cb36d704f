"""Search-quality measures over rating arrays, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A rating of 4 or 5 stars is relevant; targets of the report.
RELEVANT_FROM = 4
TARGETS = {"precision_at_1": 0.70, "precision_at_3": 0.80, "precision_at_5": 0.85,
           "precision_at_10": 0.75, "ndcg_at_5": 0.85, "mrr": 0.80}


def relevance(ratings: Column) -> Column:
    return F.transform(ratings, lambda r: F.when(r >= RELEVANT_FROM, 1).otherwise(0))


def precision_at(ratings: Column, k: int) -> Column:
    """Share of relevant results in the first k; 0 with fewer than k ratings."""
    hits = F.aggregate(F.slice(relevance(ratings), 1, k), F.lit(0), lambda a, x: a + x)
    return F.when(F.size(ratings) >= k, hits / F.lit(float(k))).otherwise(F.lit(0.0))


def dcg_at(ratings: Column, k: int) -> Column:
    gains = F.transform(F.slice(ratings, 1, k),
                        lambda r, i: (F.pow(F.lit(2.0), r) - 1) / F.log2(i + 2))
    return F.aggregate(gains, F.lit(0.0), lambda a, x: a + x)


def ndcg_at(ratings: Column, k: int = 5) -> Column:
    """Gain 2^r - 1, discount log2(i + 2); the ideal order sorts the same k."""
    first = F.slice(ratings, 1, k)
    ideal = dcg_at(F.sort_array(first, asc=False), k)
    return F.when(ideal > 0, dcg_at(first, k) / ideal).otherwise(F.lit(0.0))


def reciprocal_rank(ratings: Column) -> Column:
    first = F.array_position(relevance(ratings), 1)
    return F.when(first > 0, 1 / first).otherwise(F.lit(0.0))


def average_precision(ratings: Column) -> Column:
    """Mean of precision at each relevant position; 0 if there is none."""
    folded = F.aggregate(
        relevance(ratings),
        F.struct(F.lit(0).alias("seen"), F.lit(0).alias("hits"), F.lit(0.0).alias("total")),
        lambda a, x: F.struct(
            (a["seen"] + 1).alias("seen"), (a["hits"] + x).alias("hits"),
            (a["total"] + F.when(x == 1, (a["hits"] + 1) / (a["seen"] + 1)).otherwise(0.0)
             ).alias("total")),
        lambda a: F.when(a["hits"] > 0, a["total"] / a["hits"]).otherwise(F.lit(0.0)))
    return folded


def recall_at(found: Column, expected: Column, k: int) -> Column:
    wanted = F.array_distinct(expected)
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(F.slice(found, 1, k), wanted))
                  / F.size(wanted)).otherwise(F.lit(0.0))


def overlap_precision(found: Column, expected: Column, k: int = 5) -> Column:
    return F.size(F.array_intersect(F.slice(found, 1, k), expected)) / F.lit(float(k))
