"""Models run as commands, one process a page, inside the workers; failures are rows, never exceptions."""

from __future__ import annotations

import json
import os
import shlex
import subprocess
import sys
import tempfile
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTCOME = "page_id string, model_id string, status string, error_type string, error string, payload string, seconds double"
#: Characters of a process's output that an error carries.
TAIL = 1200
PAGE = ("page_id", "image_path", "issue_id", "page_number", "width", "height")


@dataclass(frozen=True)
class Command:
    """A command template; its JSON comes from the file {output_path}, else from stdout.

    Placeholders: page_id, image_path, image_dir, image_name, image_stem, issue_id, page_number, manifest_dir, run_dir, repo_root,
    output_path, profile_path, model_id, python, width, height.
    """

    model_id: str
    command: tuple[str, ...]
    timeout: float = 600
    env: dict = field(default_factory=dict)
    cwd: str = ""


def placeholders(c: Command, page: dict, context: dict, output_path: str) -> dict[str, str]:
    text = lambda v: "" if v is None or v != v else str(v)
    image = PurePosixPath(text(page.get("image_path")))
    own = {k: text(page.get(k)) for k in PAGE} | {"image_dir": str(image.parent), "image_name": image.name, "image_stem": image.stem}
    return {"manifest_dir": "", "run_dir": "", "repo_root": "", "profile_path": ""} | context | own | {"output_path": output_path, "model_id": c.model_id, "python": sys.executable}


def _attempt(c: Command, page: dict, context: dict) -> tuple[str, str | None, str | None, str | None]:
    """status, error type, error, payload."""
    try:
        with tempfile.TemporaryDirectory() as own:  # the process's own output, read here and now
            out = os.path.join(own, "output.json")
            argv = [a.format(**placeholders(c, page, context, out)) for a in c.command]
            done = subprocess.run(argv, capture_output=True, text=True, timeout=c.timeout, env={**os.environ, **c.env}, cwd=os.path.expanduser(c.cwd) if c.cwd else None)
            if done.returncode:
                return "error", "RuntimeError", f"{shlex.join(argv)} returned {done.returncode}: {done.stderr[-TAIL:] or done.stdout[-TAIL:]}", None
            if os.path.exists(out):
                with open(out, encoding="utf-8") as f:
                    raw = f.read()
            else:
                raw = done.stdout.strip()
        if not raw:
            return "error", "RuntimeError", "neither output file nor output", None
        payload = json.loads(raw)
        if not isinstance(payload, dict):
            return "error", "ValueError", "the output must be an object", None
        for key, own_id in (("page_id", text_of(page.get("page_id"))), ("model_id", c.model_id)):
            if str(payload.get(key) or own_id) != own_id:
                return "error", "ValueError", f"the output is of {key} {payload[key]!r}, not {own_id!r}", None
        runtime = payload.get("runtime") if isinstance(payload.get("runtime"), dict) else {}
        status = str(runtime.get("status") or "ok").lower()
        if status not in ("ok", "skipped"):
            return "error", "RuntimeError", str(runtime.get("error") or f"status {status}"), None
        return status, None, None, raw
    except (OSError, KeyError, IndexError, ValueError, subprocess.TimeoutExpired) as e:
        return "error", type(e).__name__, str(e)[-TAIL:], None


def text_of(v) -> str:
    return "" if v is None else str(v)


def run_command(pages: DataFrame, c: Command, context: dict | None = None) -> DataFrame:
    """Outcome rows of pages (page_id, image_path and, where known, issue_id, page_number, width, height).

    A task that runs again runs its commands again.
    """
    own, names = dict(context or {}), [x.split()[0] for x in OUTCOME.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page in b.to_dict("records"):
                began = time.monotonic()
                rows.append((page["page_id"], c.model_id, *_attempt(c, page, own), round(time.monotonic() - began, 6)))
            yield pd.DataFrame(rows, columns=names)

    return pages.select(*[F.col(x).cast("string").alias(x) for x in PAGE if x in pages.columns]).mapInPandas(run, OUTCOME)
