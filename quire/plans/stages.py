"""Stages with stated inputs and outputs: a chosen subset runs in order, finished stages are left alone."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire import sinks
from quire.sources import files

Tables = dict[str, DataFrame]
MARKER = "finished.json"


@dataclass(frozen=True)
class Stage:
    """work: from the tables of the stages it reads, by their names, to its own tables.  settings: what the outcome depends on besides.

    then: more tables, from those of `work` as written, so that what is dear is made once.  check: looks at all tables as written and raises
    where they will not do, so that the stage does not count as finished.
    """

    name: str
    work: Callable[[dict[str, Tables]], Tables]
    reads: tuple[str, ...] = ()
    settings: dict | None = None
    enabled: bool = True
    then: Callable[[Tables], Tables] | None = None
    check: Callable[[Tables], None] | None = None


def ordered(stages: Iterable[Stage], chosen: Iterable[str] | None = None) -> list[Stage]:
    """The enabled stages among the chosen (all if None), each after those it reads.  Unknown or repeated names and circles raise ValueError."""
    by_name: dict[str, Stage] = {}
    for s in stages:
        if s.name in by_name:
            raise ValueError(f"stage {s.name} is given twice")
        by_name[s.name] = s
    wanted = set(by_name if chosen is None else chosen)
    unknown = (wanted | {r for s in by_name.values() for r in s.reads}) - set(by_name)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; there are {sorted(by_name)}")
    try:
        names = list(TopologicalSorter({s.name: s.reads for s in by_name.values()}).static_order())
    except CycleError as e:
        raise ValueError(f"stages read each other: {' <- '.join(e.args[1])}") from e
    return [by_name[n] for n in names if n in wanted and by_name[n].enabled]


def _marker(spark: SparkSession, root: str, name: str) -> dict | None:
    """What a finished stage left, None for others."""
    path = f"{root}/{name}/{MARKER}"
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if files.exists(spark, path) else None


def _settings(stage: Stage, runs: dict[str, str]) -> str:
    return hashlib.sha256(json.dumps([stage.settings or {}, sorted(runs.items())], sort_keys=True, default=str).encode()).hexdigest()


def tables_of(spark: SparkSession, root: str, name: str) -> Tables:
    """The tables of a finished stage."""
    made = _marker(spark, root, name)
    if made is None:
        raise FileNotFoundError(f"stage {name} has no finished output under {root}")
    return {t: spark.read.parquet(f"{root}/{name}/{made['run']}/{t}") for t in made["rows"]}


def _written(spark: SparkSession, made: Tables, folder: str, rows: dict[str, int]) -> Tables:
    """The tables, written and read again; their rows are counted as they are written."""
    for name, df in made.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/{name}")
        rows[name] = int(seen.get["n"])
    return {name: spark.read.parquet(f"{folder}/{name}") for name in made}


def run_stages(spark: SparkSession, stages: Iterable[Stage], root: str, chosen: Iterable[str] | None = None, resume: bool = True) -> list[dict]:
    """Run the chosen stages below `root`; stage, outcome (finished before, or ran), rows of each table and seconds, in the order of work.

    A stage's tables are Parquet in a folder of this very run of it, which a marker names once all are whole: a run that was killed
    leaves no marker, and its readers never see half of it.  With `resume` a marked stage is left alone as long as its settings and the runs
    that it read are the same; so a stage runs again after any that it reads did.  A stage read by a chosen one must be chosen or
    finished, which is looked up before anything runs; disabled stages neither run nor are read.
    """
    stages, root = list(stages), root.rstrip("/")
    todo = ordered(stages, chosen)
    enabled, coming = {s.name for s in stages if s.enabled}, {s.name for s in todo}
    lost = sorted({r for s in todo for r in s.reads if r in enabled - coming and _marker(spark, root, r) is None})
    if lost:
        raise FileNotFoundError(f"stages {lost} are read but neither chosen nor finished under {root}")
    report = []
    for s in todo:
        reads = [r for r in s.reads if r in enabled]
        runs = {r: _marker(spark, root, r)["run"] for r in reads}
        settings, before, began = _settings(s, runs), _marker(spark, root, s.name), time.monotonic()
        if resume and before and before["settings"] == settings:
            report.append({"stage": s.name, "outcome": "finished before", "rows": before["rows"], "seconds": 0.0})
            continue
        run, rows = uuid.uuid4().hex, {}
        folder = f"{root}/{s.name}/{run}"
        made = _written(spark, s.work({r: tables_of(spark, root, r) for r in reads}), folder, rows)
        if s.then:
            made |= _written(spark, s.then(made), folder, rows)
        if s.check:
            s.check(made)
        sinks.replace_json_document(spark, {"run": run, "settings": settings, "rows": rows}, f"{root}/{s.name}/{MARKER}")
        if before:
            files.remove(spark, f"{root}/{s.name}/{before['run']}")
        report.append({"stage": s.name, "outcome": "ran", "rows": rows, "seconds": round(time.monotonic() - began, 3)})
    return report


def progress(spark: SparkSession, stages: Iterable[Stage], root: str) -> list[dict]:
    """stage, state (disabled, waiting, finished, or stale where settings or inputs have changed since) and rows, in the order of work."""
    out, stages = [], list(stages)
    off = {s.name for s in stages if not s.enabled}
    state: dict[str, str] = {}
    for s in ordered([Stage(x.name, x.work, x.reads, x.settings) for x in stages]):
        made = _marker(spark, root, s.name)
        reads = [r for r in s.reads if r not in off]
        if s.name in off:
            state[s.name] = "disabled"
        elif made is None:
            state[s.name] = "waiting"
        elif any(state[r] != "finished" for r in reads):
            state[s.name] = "stale"
        else:
            state[s.name] = "finished" if made["settings"] == _settings(s, {r: _marker(spark, root, r)["run"] for r in reads}) else "stale"
        out.append({"stage": s.name, "state": state[s.name], "rows": made["rows"] if made and s.name not in off else {}})
    return out
