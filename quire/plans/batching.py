"""Models that take pages by the batch: a batch that fails is halved until the pages at fault stand alone.

One bad page would fail its whole batch.  Halving costs about 2 log2(batch) calls for each bad page instead of a call for every page of
the batch, and all other pages keep the throughput of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

OUTCOME = "status string, error_type string, error string, result string, calls int"


def _outcomes(batch: pd.DataFrame, model: Callable[[pd.DataFrame], list]) -> list[tuple]:
    """status, error_type, error, result and calls of each row; a call counts for the first row that it covered."""
    out: list = [None] * len(batch)
    calls = [0] * len(batch)
    todo = [(0, len(batch))] if len(batch) else []
    while todo:
        low, high = todo.pop()
        calls[low] += 1
        try:
            results = list(model(batch.iloc[low:high].reset_index(drop=True)))
            if len(results) != high - low:
                raise ValueError(f"{len(results)} results for {high - low} pages")
        except Exception as e:  # whatever a model raises is its pages' outcome
            if high - low == 1:
                out[low] = ("error", type(e).__name__, str(e), None)
            else:
                middle = (low + high) // 2
                todo += [(middle, high), (low, middle)]
        else:
            out[low:high] = [("ok", None, None, None if r is None else str(r)) for r in results]
    return [(*o, n) for o, n in zip(out, calls, strict=True)]


def run_batched(pages: DataFrame, model: Callable[[pd.DataFrame], list], key: str, batch_rows: int = 4) -> DataFrame:
    """The key, status (ok or error), error_type, error, result and calls of each row of pages.

    model: takes a frame of some rows of pages and returns their results in order; it is called in the workers, at most batch_rows rows at a time.
    Batches form as rows come, so which pages share one depends on the partitions; the outcome of a page does not, if the model treats
    pages alike in any batch.  A task that runs again calls the model again.  No pages, no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for at in range(0, len(b), batch_rows):
                part = b.iloc[at : at + batch_rows]
                rows += [(k, *o) for k, o in zip(part[key], _outcomes(part, model), strict=True)]
            yield pd.DataFrame(rows, columns=[key, "status", "error_type", "error", "result", "calls"])

    return pages.mapInPandas(run, f"`{key}` {pages.schema[key].dataType.simpleString()}, {OUTCOME}")
