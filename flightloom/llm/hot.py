"""Joins of rows with what is known about their key, where one key may hold any share of the rows.

An aggregate by key is combined on the map side, so hot keys do not hurt it; a join back to the rows sends all rows of a key to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than one in so many of all rows are hot, so there are fewer of them than this: their facts can be broadcast.
MOST_HOT = 10_000
#: Keys with no more rows than this are never hot.
LEAST_HOT = 2_000


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], places: str = "places") -> DataFrame:
    """``rows`` with the columns of ``facts`` (written, one row per key, ``places`` its number of rows); rows of other keys go.

    The facts of hot keys are broadcast, so their rows stay where they are. All others meet by a shuffle, in which no key has more than
    ``LEAST_HOT`` rows or a ``MOST_HOT``-th of all. Null keys meet nothing.
    """
    total = facts.agg(F.sum(places)).first()[0] or 0
    hot = F.col(places) > max(LEAST_HOT, total // MOST_HOT)
    few = F.broadcast(facts.where(hot).drop(places))
    others = rows.join(F.broadcast(facts.where(hot).select(keys)), keys, "left_anti").join(facts.where(~hot).drop(places), keys)
    return rows.join(few, keys).unionByName(others)
