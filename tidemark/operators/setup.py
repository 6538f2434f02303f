"""Row functions that need a set-up step in each task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.schemas import struct


def map_with_setup(
    df: DataFrame,
    open_task: Callable[[], object],
    fn: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Apply ``fn`` to batches of rows with what ``open_task`` made once in each task.

    For work that columns cannot express, such as a model or a client; use columns otherwise.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = open_task()
        for batch in batches:
            yield fn(opened, batch)

    return df.mapInPandas(run, struct(schema))
