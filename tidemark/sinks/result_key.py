"""The columns that tell the rows of a query's result apart, read off its analyzed plan."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

#: A part of a key: the ids of the attributes that carry it, under whatever name.
Part = set[int]
_SAME_ROWS = {"Filter", "Sort", "SubqueryAlias", "View", "GlobalLimit", "LocalLimit", "EventTimeWatermark", "ResolvedHint"}


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _source(expression) -> int | None:
    """The attribute that an expression passes on unchanged: itself, a cast of it, or a bound of a window."""
    while _kind(expression) in ("Cast", "GetStructField", "Alias"):
        expression = expression.child()
    return expression.exprId().id() if _kind(expression) == "AttributeReference" else None


def _carried(parts: list[Part], expressions) -> list[Part]:
    for e in _items(expressions):
        if _kind(e) == "Alias" and (source := _source(e.child())) is not None:
            for part in parts:
                if source in part:
                    part.add(e.exprId().id())
    return parts


def _parts(plan) -> list[Part] | None:
    kind = _kind(plan)
    if kind == "Aggregate":
        parts = []
        for g in _items(plan.groupingExpressions()):
            part = {source} if (source := _source(g)) is not None else set()
            part |= {
                e.exprId().id() for e in _items(plan.aggregateExpressions())
                if _kind(e) == "Alias" and e.child().semanticEquals(g)}
            parts.append(part)
        return _carried(parts, plan.aggregateExpressions())
    if kind == "Window":
        ranks = [
            e.exprId().id() for e in _items(plan.windowExpressions())
            if _kind(e.child()) == "WindowExpression" and _kind(e.child().windowFunction()) == "RowNumber"]
        if not ranks:
            return _parts(plan.child())
        groups = [_source(p) for p in _items(plan.partitionSpec())]
        return None if None in groups else [*({g} for g in groups), {ranks[0]}]
    if kind == "Project":
        parts = _parts(plan.child())
        return parts and _carried(parts, plan.projectList())
    return _parts(plan.child()) if kind in _SAME_ROWS else None


def result_key(df: DataFrame) -> list[str] | None:
    """Group columns of an aggregate, or partition and rank of a ranking; None if the plan shows no key.

    A time window counts by either of its bounds. The aggregate of all rows has the empty key.
    """
    plan = df._jdf.queryExecution().analyzed()
    parts = _parts(plan)
    if parts is None:
        return None
    key = []
    for part in parts:
        names = [a.name() for a in _items(plan.output()) if a.exprId().id() in part]
        if not names:
            return None
        key.append(names[-1])
    return key
