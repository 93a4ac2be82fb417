"""The k best rows over stored postings, reading only the tiers that can hold one of them.

Postings carry a tier, a coarse step of what they can add to a score, and lie sorted by term and
tier, so that a predicate on both prunes pages. A small table beside them holds the number of postings and
the extremes of every (term, tier). A search has three steps.

1. The highest tiers of each term are read until they hold some multiple of k postings. The exact
   scores of the k best rows found give a bar: the k-th score is at least the least of them.
2. The bar is shared among the terms in proportion to the most that each can add. A row whose terms
   all add less than their share stays below the bar, so only tiers that reach the share are read.
   What a row can still get from the unread tiers bounds its score.
3. The other postings of the rows whose bound reaches the bar are looked up, and the scores are exact.

Rows reach the driver k at a time, tiers by the terms of the query.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.session import materialise

# Tiers for each doubling, postings read for each wanted row in step 1, slack for sums of floats, keys that become a predicate.
STEPS, HEAD, SLACK, PUSHED_KEYS = 4, 4, 1e-6, 1000


class Tier(NamedTuple):
    term: object
    tier: int
    n: int
    bound: float  # the most that one of its postings adds to the score


def step(value: Column) -> Column:
    """The tier of a positive value; larger values have no smaller tier."""
    return F.floor(F.log2(value.cast("double")) * STEPS).cast("int")


def heads(tiers: Sequence[Tier], rows: int) -> list[Tier]:
    """The highest tiers of each term that hold ``rows`` postings, or all."""
    out, held = [], {}
    for t in sorted(tiers, key=lambda t: -t.bound):
        if held.get(t.term, 0) < rows:
            out.append(t)
        held[t.term] = held.get(t.term, 0) + t.n
    return out


def needed(tiers: Sequence[Tier], bar: float) -> list[Tier]:
    """The tiers of which a row needs one to reach the bar."""
    most = {}
    for t in tiers:
        most[t.term] = max(most.get(t.term, 0.0), t.bound)
    share = bar * (1 - SLACK) / sum(most.values())
    return [t for t in tiers if t.bound >= most[t.term] * share and t.bound > 0]


def of_tiers(tiers: Sequence[Tier]) -> Column:
    """The postings of some tiers, as ranges of tiers by term."""
    runs: dict = {}
    for t in tiers:
        runs.setdefault(t.term, []).append(t.tier)
    tests = [(F.col("term") == F.lit(term)) & F.col("tier").between(min(own), max(own)) for term, own in runs.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def best(rows: DataFrame, tiers: Sequence[Tier], adds: Column, k: int, key: str) -> DataFrame | None:
    """``(<key>, score)`` of at least all rows that can be among the k best by the sum of ``adds``.

    ``rows`` are the postings of the query's terms, one a term and key. None where no bar can be found: fewer
    than k rows have a term, or the k-th score is not positive.
    """
    def exact(of: DataFrame) -> DataFrame:
        return of.groupBy(key).agg(F.sum(adds).alias("score"))

    if k < 1 or not tiers:
        return None
    first = exact(rows.where(of_tiers(heads(tiers, HEAD * k)))).orderBy(F.desc("score"), key).limit(k)
    keys = [r[0] for r in first.select(key).collect()]
    if len(keys) < k:
        return None
    bar = exact(rows.where(F.col(key).isin(keys))).agg(F.min("score")).first()[0]
    if bar is None or bar <= 0:
        return None
    read = needed(tiers, bar)
    inside, rest = of_tiers(read), {}
    for t in set(tiers) - set(read):
        rest[t.term] = max(rest.get(t.term, 0.0), t.bound)
    unread = F.lit(0.0)
    for term, bound in rest.items():
        unread = F.when(F.col("term") == F.lit(term), bound).otherwise(unread)
    found = rows.where(inside).groupBy(key).agg(F.sum(adds).alias("part"), F.sum(unread).alias("met"))
    reach = F.col("part") + F.lit(sum(rest.values())) - F.col("met")
    found = materialise(found.where(reach >= bar * (1 - SLACK)).select(key), "impact")
    few = [r[0] for r in found.limit(PUSHED_KEYS + 1).collect()]
    if len(few) <= PUSHED_KEYS:
        return exact(rows.where(F.col(key).isin(few)))
    return exact(rows.join(found, key, "left_semi"))
