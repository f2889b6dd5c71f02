"""Counters that ride on a write: one scan makes the table and its figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from ..staging import staged


def counted(df: DataFrame, label: str, **counters: Column) -> tuple[DataFrame, dict]:
    """(the staged table, {counter: value}): aggregates over the rows, taken while they are written.

    A task that is run again counts its rows once; a counter over no rows has its aggregate's
    value of nothing.
    """
    seen = Observation()
    table = staged(df.observe(seen, *[c.alias(n) for n, c in counters.items()]), label)
    return table, dict(seen.get)
