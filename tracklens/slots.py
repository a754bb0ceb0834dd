"""Model slots: vectorised row functions that a caller registers.

A slot takes and returns pandas Series inside an iterator UDF, so a model is
loaded once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOTS: dict[str, tuple[Callable, str]] = {}


def register(name: str, make: Callable[[], Callable[[list], list]], returns: str) -> None:
    """``make`` builds, once per task, a function of a list of inputs to a list of outputs."""
    _SLOTS[name] = (make, returns)


def apply(name: str, value: Column, batch: int = 32) -> Column:
    """The slot's output for each row; null inputs stay null."""
    make, returns = _SLOTS[name]

    def run(parts):
        model = make()
        for values in parts:
            out = []
            for at in range(0, len(values), batch):
                rows = list(values[at : at + batch])
                known = [i for i, x in enumerate(rows) if x is not None]
                results = [None] * len(rows)
                for i, y in zip(known, model([rows[i] for i in known]) if known else [], strict=True):
                    results[i] = y
                out += results
            yield pd.Series(out, index=values.index)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, returns)(value)


def apply_isolated(name: str, value: Column, batch: int = 32) -> Column:
    """``value`` and ``error`` of each row: a failing batch is halved until the bad rows stand alone.

    All other rows get their outputs; a bad row costs about ``log2(batch)`` more calls
    of the model. Null inputs stay null without an error.
    """
    make, returns = _SLOTS[name]

    def outputs(model: Callable[[list], list], rows: list) -> list[tuple]:
        if not rows:
            return []
        try:
            found = list(model(rows))
            if len(found) != len(rows):
                raise ValueError(f"{len(found)} outputs for {len(rows)} inputs")
            return [(x, None) for x in found]
        except Exception as e:  # whatever a model raises is a result of that row
            if len(rows) == 1:
                return [(None, f"{type(e).__name__}: {e}")]
            half = len(rows) // 2
            return outputs(model, rows[:half]) + outputs(model, rows[half:])

    def run(parts):
        model = make()
        for values in parts:
            out = [(None, None)] * len(values)
            known = [i for i, x in enumerate(values) if x is not None]
            for at in range(0, len(known), batch):
                own = known[at : at + batch]
                for i, y in zip(own, outputs(model, [values.iloc[i] for i in own]), strict=True):
                    out[i] = y
            yield pd.DataFrame(out, columns=["value", "error"], index=values.index)

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, f"value {returns}, error string")(value)
