"""Aggregates with an accumulator of the user's own, merged in phases.

An accumulator says how to create, add, merge and give a result, in Python. Rows are added inside the
Arrow batch they lie in, in one pass without a frame per key, so a batch sends one accumulator per key;
these are merged per key and part of the input (``FAN`` parts), and the parts then per key. Each phase
reads its rows sorted by key and holds one accumulator at a time, so no group meets in a task, however
hot its key is.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

FAN = 64
PART, STATE = "__part", "__state"


class Accumulator(Protocol):
    """A bounded state that can be pickled; ``merge`` must not depend on the order of its parts."""

    def create(self) -> Any: ...

    def add(self, state: Any, *values: Any) -> Any: ...

    def merge(self, a: Any, b: Any) -> Any: ...

    def result(self, state: Any) -> Any: ...


class LargestMean:
    """Mean of the ``n`` largest values; a null value counts for nothing."""

    def __init__(self, n: int) -> None:
        self.n = n

    def create(self) -> list[float]:
        return []

    def add(self, state: list[float], value: float | None) -> list[float]:
        return state if pd.isna(value) else sorted([*state, value], reverse=True)[: self.n]

    def merge(self, a: list[float], b: list[float]) -> list[float]:
        return sorted([*a, *b], reverse=True)[: self.n]

    def result(self, state: list[float]) -> float | None:
        return sum(state) / len(state) if state else None


Frames = Iterable[pd.DataFrame]


def _partial(keys: list[str], values: list[str], acc: Accumulator) -> Callable[[Frames], Iterator[pd.DataFrame]]:
    def run(batches: Frames) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() % FAN
        for batch in batches:
            states: dict[int, Any] = {}
            codes = batch.groupby(keys, dropna=False, sort=False).ngroup()
            for code, *row in zip(codes, *(batch[v] for v in values)):
                states[code] = acc.add(states[code] if code in states else acc.create(), *row)
            # Groups lie in the order of their first rows, as ``states`` does.
            out = batch.loc[~codes.duplicated(), keys]
            yield out.assign(**{PART: part, STATE: [pickle.dumps(s) for s in states.values()]})

    return run


def _merged(group: list[str], acc: Accumulator, finish: str | None) -> Callable[[Frames], Iterator[pd.DataFrame]]:
    """Rows come sorted by ``group``; one row for each, with its state or, to ``finish``, its result."""

    def run(batches: Frames) -> Iterator[pd.DataFrame]:
        at = state = None
        for batch in batches:
            rows = []
            names = zip(*(batch[g].astype(object).where(batch[g].notna(), None) for g in group))
            for name, held in zip(names, batch[STATE]):
                if name != at and at is not None:
                    rows.append((*at, acc.result(state) if finish else pickle.dumps(state)))
                state = pickle.loads(held) if name != at else acc.merge(state, pickle.loads(held))
                at = name
            yield pd.DataFrame(rows, columns=[*group, finish or STATE])
        if at is not None:
            yield pd.DataFrame([(*at, acc.result(state) if finish else pickle.dumps(state))], columns=[*group, finish or STATE])

    return run


def accumulate(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], accumulator: Accumulator, name: str, kind: str
) -> DataFrame:
    """One row per key with the accumulator's result as the column ``name`` of the type ``kind``."""
    keys, values = list(keys), list(values)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    partial = df.select(*keys, *values).mapInPandas(
        _partial(keys, values, accumulator), f"{kinds}, {PART} int, {STATE} binary")
    by_part = partial.repartition(*keys, PART).sortWithinPartitions(*keys, PART)
    parts = by_part.mapInPandas(_merged([*keys, PART], accumulator, None), f"{kinds}, {PART} int, {STATE} binary")
    whole = parts.repartition(*keys).sortWithinPartitions(*keys)
    return whole.mapInPandas(_merged(keys, accumulator, name), f"{kinds}, `{name}` {kind}")
