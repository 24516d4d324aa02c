"""Regions from the JSON payloads of older runs, whose keys and box shapes vary."""

from __future__ import annotations

import json
import math
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.layout import label_of, safe_token

# The keys under which payloads carry lists, wrapped payloads, ids and a record's fields, in the order of trial.
LISTS = ("regions", "boxes", "candidates", "layout_boxes", "detections", "blocks")
WRAPPERS = ("res", "result", "payload", "data")
PAGE_IDS = ("page_id", "slug", "id", "image_id")
BOXES = ("bbox_xyxy", "bbox", "box", "coordinate", "rect", "dt_poly", "poly", "polygon")
LABELS = ("source_label", "label", "category", "type", "class_name", "class", "block_label", "norm_label", "normalized_label")
TEXTS = ("text", "ocr_text", "transcript", "content")
SCORES = ("confidence", "score", "prob", "probability")
# Folders of older runs and the family of what lies there.
ROOTS = {"paddle_layout": "paddle", "paddle_vl15": "paddle", "dell": "dell", "mineru": "mineru"}
REGION = (
    "page_id string, model_id string, region int, region_id string, x1 double, y1 double, x2 double, y2 double, label string, source_label string, confidence double, "
    "source_family string, source_model string, text string, reading_order int, provenance array<string>, payload_keys array<string>"
)
OUTCOME = "page_id string, model_id string, observed int, emitted int, skipped int, status string, error string"


def finite(v) -> float | None:
    try:
        x = float(v)
    except (TypeError, ValueError):
        return None
    return x if math.isfinite(x) else None


def _bounds(xs: list, ys: list) -> tuple | None:
    return (min(xs), min(ys), max(xs), max(ys)) if xs and ys else None


def _corners(v) -> tuple | None:
    """Four corners, not yet ordered, from any of the known shapes."""
    if isinstance(v, dict):
        for names in (("x1", "y1", "x2", "y2"), ("left", "top", "right", "bottom"), ("left", "top", "width", "height")):
            got = [finite(v.get(k)) for k in names]
            if None not in got:
                return (got[0], got[1], got[0] + got[2], got[1] + got[3]) if names[-1] == "height" else tuple(got)
        return None
    if not isinstance(v, list) or len(v) < 4:
        return None
    nested = [isinstance(x, (list, dict)) for x in v]
    if all(isinstance(x, list) for x in v):
        points = [(finite(p[0]), finite(p[1])) for p in v if len(p) >= 2]
        points = [p for p in points if None not in p]
        return _bounds([p[0] for p in points], [p[1] for p in points])
    flat = [finite(x) for x in v]
    if any(nested) or None in flat or 4 < len(v) < 8:
        return None
    return tuple(flat) if len(v) == 4 else _bounds(flat[::2], flat[1::2])


def corners(v) -> tuple | None:
    c = _corners(v)
    return c if c and c[2] > c[0] and c[3] > c[1] else None


def records(payload, page_id: str = "") -> list[dict]:
    """The box records of a payload: a list as it is, the fitting entries of pages, a list under a known key, else those of a wrapped payload."""
    if isinstance(payload, list):
        return [x for x in payload if isinstance(x, dict)]
    if not isinstance(payload, dict):
        return []
    named = lambda p: page_id in {str(p.get(k) or "") for k in PAGE_IDS} or page_id == posixpath.splitext(posixpath.basename(str(p.get("image") or p.get("image_path") or "")))[0]
    pages = payload["pages"] if isinstance(payload.get("pages"), list) else []
    found = [r for p in pages if isinstance(p, dict) and (not page_id or named(p)) for r in records(p)]
    if found:
        return found
    for k in LISTS:
        if isinstance(payload.get(k), list):
            return records(payload[k])
    return next((r for k in WRAPPERS if (r := records(payload.get(k), page_id))), [])


def _first(record: dict, keys: tuple, default=None):
    return next((record[k] for k in keys if record.get(k) not in (None, "")), default)


def _order(record: dict) -> int | None:
    """The given reading order; the key `order` counts only without `reading_order`.  None if there is none to be read."""
    given = record["reading_order"] if "reading_order" in record else record.get("order")
    x = None if given in (None, "") else finite(given)
    return None if x is None else int(x)


def regions_of(payload, page_id: str, model_id: str = "legacy", family: str = "", default: float = 0.5, start: int = 1) -> list[tuple]:
    """Records without a valid box are skipped; regions are numbered by their record's place, from start."""
    out = []
    for i, r in enumerate(records(payload, page_id), start):
        box = next((c for k in BOXES if (c := corners(r.get(k)))), None)
        if box is None:
            continue
        score = next((s for k in SCORES if r.get(k) not in (None, "") and (s := finite(r[k])) is not None), default)
        said = str(_first(r, LABELS, "text"))
        label = str(r.get("norm_label") or r.get("normalized_label") or label_of(said))
        model, own = str(r.get("source_model") or r.get("variant") or model_id), str(r.get("source_family") or family or "")
        order, trail = _order(r), list(dict.fromkeys(x for x in (model_id, own, model) if x))
        ident = str(r.get("region_id") or f"{page_id}:{model_id}:{i:04d}")
        out.append((page_id, model_id, i, ident, *box, label, said, min(1.0, max(0.0, score)), own, model, str(_first(r, TEXTS, "")), i if order is None else order, trail, sorted(map(str, r))))
    return out


def _read(raw: str | None):
    """The payload and null, or null and what is wrong with it."""
    try:
        return json.loads(raw or "null"), None
    except (json.JSONDecodeError, RecursionError) as e:
        return None, type(e).__name__


def _outcome(raw: str | None, page_id: str, *of: object) -> tuple[int, list[tuple], str | None]:
    """How many records a payload has, its regions, and what is wrong with it.  One nested too deep to be walked is at fault like one that cannot be read."""
    payload, fault = _read(raw)
    try:
        return len(records(payload, page_id)), regions_of(payload, page_id, *of), fault
    except RecursionError as e:
        return 0, [], type(e).__name__


def legacy_regions(payloads: DataFrame, model_id: str = "legacy", family: str = "", default: float = 0.5) -> DataFrame:
    """Regions of payloads (page_id, payload as JSON text); null, unreadable or too deeply nested payloads give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in REGION.split(", ")]
        for b in batches:
            rows = [r for page, raw in zip(b["page_id"], b["payload"]) for r in _outcome(raw, page or "", model_id, family, default)[1]]
            yield pd.DataFrame(rows, columns=names)

    return payloads.select(F.col("page_id").cast("string").alias("page_id"), F.col("payload").cast("string").alias("payload")).mapInPandas(run, REGION)


def legacy_outcome(payloads: DataFrame, model_id: str = "legacy") -> DataFrame:
    """A row for each payload: records observed, regions emitted, records skipped; skipped if the payload is missing, error if it cannot be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in OUTCOME.split(", ")]
        for b in batches:
            rows = []
            for page, raw in zip(b["page_id"], b["payload"]):
                seen, made, fault = _outcome(raw, page or "")
                rows.append((page, model_id, seen, len(made), max(0, seen - len(made)), "error" if fault else "skipped" if raw is None else "ok", fault))
            yield pd.DataFrame(rows, columns=names)

    return payloads.select(F.col("page_id").cast("string").alias("page_id"), F.col("payload").cast("string").alias("payload")).mapInPandas(run, OUTCOME)


def legacy_sources(paths: DataFrame, roots: tuple[str, ...] = tuple(ROOTS)) -> DataFrame:
    """source_root, variant, family, n, model_id of the stored results among paths (path), by root and variant; unknown roots raise ValueError."""
    if unknown := sorted(set(roots) - set(ROOTS)):
        raise ValueError(f"unknown source roots {unknown}; known are {sorted(ROOTS)}")
    part = lambda i: F.regexp_extract("path", r"(?:^|/)outputs/sources/([^/]+)/([^/]+)/[^/]+/layout_boxes\.normalized\.json$", i)
    found = paths.select(part(1).alias("source_root"), part(2).alias("variant")).filter(F.col("source_root").isin(*roots))
    family = F.create_map(*[F.lit(x) for kv in ROOTS.items() for x in kv])
    model = F.concat(F.lit("legacy_"), safe_token(F.col("source_root")), F.lit("_"), safe_token(F.col("variant")))
    return found.groupBy("source_root", "variant").agg(F.count(F.lit(1)).alias("n")).select("source_root", "variant", family[F.col("source_root")].alias("family"), "n", model.alias("model_id"))


def import_config(sources: list[dict], run_dir: str, profile: str = "legacy_import", allow_missing: bool = True) -> dict:
    """A configuration whose adapters import an older run's stored results, one for each of legacy_sources' rows; none raise ValueError."""
    if not sources:
        raise ValueError(f"no stored results under {run_dir}/outputs/sources")
    return {
        "include_builtin_adapters": False,
        "import_adapters": [
            {"model_id": s["model_id"], "family": "layout", "resource_class": "cpu", "profiles": [profile], "source_family": s["family"], "allow_missing": allow_missing, "pattern": f"{run_dir}/outputs/sources/{s['source_root']}/{s['variant']}/{{image_stem}}/layout_boxes.normalized.json"}
            for s in sources
        ],
    }
