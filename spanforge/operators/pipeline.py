"""User-function surface (U1–U5): opaque row/batch functions and named,
ordered DataFrame components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def row_map(df: DataFrame, fn: Callable[[dict], dict], schema: str, cols: list[str] | None = None) -> DataFrame:
    """Apply an opaque per-row Python function (Arrow batches in, rows out).
    Column expressions are preferred; this is for functions Spark cannot see."""
    src = df.select(*cols) if cols else df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([fn(r) for r in pdf.to_dict("records")])

    return src.mapInPandas(run, schema)


def batch_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a batched (vectorised) pandas function to Arrow batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


class Pipeline:
    """Named ``DataFrame -> DataFrame`` components with placement
    (``first``, ``last``, ``before=``, ``after=``), chained by ``df.transform``."""

    def __init__(self):
        self._steps: list[tuple[str, Callable[[DataFrame], DataFrame]]] = []

    def add(self, name: str, fn: Callable[[DataFrame], DataFrame], first: bool = False, last: bool = False,
            before: str | None = None, after: str | None = None) -> "Pipeline":
        if name in self.names:
            raise ValueError(f"component {name!r} exists")
        if first:
            pos = 0
        elif before is not None:
            pos = self.names.index(before)
        elif after is not None:
            pos = self.names.index(after) + 1
        else:
            pos = len(self._steps)
        self._steps.insert(pos, (name, fn))
        return self

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self._steps]

    def __call__(self, df: DataFrame) -> DataFrame:
        for _, fn in self._steps:
            df = df.transform(fn)
        return df
