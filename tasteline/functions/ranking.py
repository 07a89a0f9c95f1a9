"""Ranking metrics as expressions over the hit positions of one user.

``hits`` is the ascending array of 1-based places in the predicted list that
hold a truth item, ``n_truth`` the number of distinct truth items. A user with
an empty truth set scores 0 everywhere.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def _up_to(hits: Column, k: int) -> Column:
    return F.filter(hits, lambda place: place <= k)


def _or_zero(n_truth: Column, value: Column) -> Column:
    return F.when(n_truth > 0, value).otherwise(F.lit(0.0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def _precision_sum(hits: Column) -> Column:
    return _sum(F.transform(hits, lambda place, i: (i + 1) / place))


def precision_at(hits: Column, n_truth: Column, k: int) -> Column:
    """Hits in the first ``k`` places over ``k``, however short the list is."""
    return _or_zero(n_truth, F.size(_up_to(hits, k)) / F.lit(float(k)))


def precision_of_list(hits: Column, n_truth: Column, n_predicted: Column) -> Column:
    """Hits over the length of the list itself; 0 for an empty list."""
    return F.when((n_truth > 0) & (n_predicted > 0), F.size(hits) / n_predicted).otherwise(F.lit(0.0))


def recall_at(hits: Column, n_truth: Column, k: int) -> Column:
    return _or_zero(n_truth, F.size(_up_to(hits, k)) / n_truth)


def average_precision(hits: Column, n_truth: Column) -> Column:
    return _or_zero(n_truth, _precision_sum(hits) / n_truth)


def average_precision_at(hits: Column, n_truth: Column, k: int) -> Column:
    return _or_zero(n_truth, _precision_sum(_up_to(hits, k)) / F.least(n_truth, F.lit(k)))


def ndcg_at(hits: Column, n_truth: Column, k: int) -> Column:
    gain = _sum(F.transform(_up_to(hits, k), lambda place: 1.0 / F.log(place + 1.0)))
    ideal = list(accumulate(1.0 / math.log(place + 1.0) for place in range(1, k + 1)))
    best = F.element_at(F.lit(ideal), F.least(n_truth, F.lit(k)).cast("int"))
    return _or_zero(n_truth, gain / best)
