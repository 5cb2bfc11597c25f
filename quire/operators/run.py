"""Running an engine over pages: batches, retry of misses one by one, stop after a failed model, accounting.

The engine is any Python callable ``call(model, [(sample_id, path)]) -> {sample_id: text}`` that may raise; no
engine is part of this package. A task that is run again calls it again; outputs are rows, so nothing is written twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import coverage

BATCH = 24
_ROWS = "model string, sample_id string, prediction string, seconds double, error string"


class LoadError(RuntimeError):
    """The model cannot be used; its other pages are not tried in this task."""


def run_batches(pending: DataFrame, call: Callable, size: int = BATCH) -> DataFrame:
    """pending: model, sample_id, path. Each batch is one call; a failed batch is a row with its error for every page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        broken: dict[str, str] = {}
        for f in frames:
            for model, own in f.groupby("model", sort=True):
                for a in range(0, len(own), size):
                    part = own.iloc[a : a + size]
                    began, found, error = time.perf_counter(), {}, broken.get(model)
                    if error is None:
                        try:
                            found = call(model, list(zip(part["sample_id"], part["path"], strict=True)))
                        except LoadError as e:
                            error = broken[model] = f"{e}"[-3000:]
                        except Exception as e:  # the log of one batch does not end the run: its pages are missing outputs
                            error = f"{e}"[-3000:]
                    seconds = (time.perf_counter() - began) / len(part)
                    yield pd.DataFrame([(model, s, found.get(s), seconds, error) for s in part["sample_id"]], columns=["model", "sample_id", "prediction", "seconds", "error"])

    return pending.select("model", "sample_id", "path").mapInPandas(run, _ROWS)


def only(rows: DataFrame, column: str, values: list[str] | None) -> DataFrame:
    """The rows with one of the values; without a list all of them."""
    return rows if values is None else rows.where(F.col(column).isin(values))


def with_preset(inputs: DataFrame, preset: str) -> DataFrame:
    """The inputs of one preset; none is an error."""
    found = inputs.where(F.col("preset") == preset)
    if found.isEmpty():
        raise ValueError(f"no input has the preset {preset}")
    return found


def working_models(pending: DataFrame, call: Callable, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(pending rows of models that load, failed models with their error): each model is tried on its first page, once, before all its pages are."""
    first = pending.groupBy("model").agg(F.min_by(F.struct("sample_id", "path"), "sample_id").alias("p")).select("model", "p.*")
    tried = keep(run_batches(first, lambda model, pages: _loaded(call, model, pages), 1), "tried")
    failed = tried.where(F.col("error").startswith(_LOAD)).select("model", F.expr(f"substring(error, {len(_LOAD) + 1})").alias("error"))
    return pending.join(failed.select("model"), "model", "left_anti"), failed


_LOAD = "load: "


def _loaded(call: Callable, model: str, pages: list[tuple[str, str]]) -> dict[str, str]:
    try:
        return call(model, pages)
    except LoadError as e:
        raise LoadError(f"{_LOAD}{e}") from e


def chain(start: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, list[dict]]:
    """Run stages one after another; each one's table is written and is the next one's input. (last table, a log row a stage); a
    stage that raises ends the run with its name."""
    now, log = start, []
    for name, stage in stages:
        began = time.perf_counter()
        try:
            now = keep(stage(now), name)
        except Exception as e:
            raise RuntimeError(f"stage {name} failed after {[x['stage'] for x in log]}") from e
        log.append({"stage": name, "rows": now.count(), "seconds": time.perf_counter() - began})
    return now, log


def run_resumed(inputs: DataFrame, outputs: DataFrame, call: Callable, keep: Callable[[DataFrame, str], DataFrame], size: int = BATCH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all outputs, incidents, accounting): what has no output is run in batches, what a batch missed once more alone.

    ``keep(df, name)`` writes a table and reads it again, so that no page is run twice by a later action.
    """
    keys = ["model", "sample_id"]
    first = keep(run_batches(coverage.pending(inputs, outputs, keys), call, size), "first")
    missed = coverage.pending(inputs, outputs.select(*keys).unionByName(first.where("prediction is not null").select(*keys)), keys)
    second = keep(run_batches(missed, call, 1), "second")
    written = first.unionByName(second).where("prediction is not null").select(*keys, "prediction", "seconds")
    incidents = first.where("prediction is null").select(*keys, F.coalesce("error", F.lit("no output")).alias("incident"))
    done = outputs.select(*keys, "prediction", "seconds").unionByName(written)
    return done, incidents, coverage.run_accounting(inputs, outputs, written, keys)
