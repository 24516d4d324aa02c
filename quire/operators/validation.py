"""Progress of runs, the rollup of issues (level, code, ...), paths that leave a run, and files unfit to publish."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Shapes of secrets that published text must not hold.
SECRETS = {
    "private key": r"BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY",
    "AWS access key": r"AKIA[0-9A-Z]{16}",
    "Google API key": r"AIza[0-9A-Za-z_-]{35}",
    "GitHub token": r"gh[pousr]_[0-9A-Za-z]{30,}",
    "OpenAI-style key": r"sk-[0-9A-Za-z_-]{20,}",
    "Slack token": r"xox[baprs]-[0-9A-Za-z-]{10,}",
    "local macOS path": r"/Users/[A-Za-z0-9._-]+/",
}

# Folders, names and endings that published files must not have, and their greatest size.
CACHE_PARTS = ("__pycache__", ".pytest_cache", ".mypy_cache", ".ruff_cache")
SENSITIVE_NAMES = (".DS_Store", ".env", "credentials.json", "id_rsa", "id_ed25519")
SENSITIVE_ENDINGS = (".key", ".p12", ".pem", ".pid", ".pyc")
MOST_BYTES = 10 * 1024 * 1024


def row_counts(**tables: DataFrame) -> dict[str, int]:
    """How many rows each table has, all counted by one query."""
    each = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    return {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, each).collect()}


def issue_rollup(issues: DataFrame, strict: bool = False) -> DataFrame:
    """errors, warnings and status in one row; strict makes warnings errors.  No issues: ok."""
    counts = issues.agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"))
    bad = F.col("errors") + F.when(F.lit(strict), F.col("warnings")).otherwise(0) > 0
    return counts.select("errors", "warnings", F.when(bad, "error").when(F.col("warnings") > 0, "warning").otherwise("ok").alias("status"))


def stage_progress(expected: DataFrame, artifacts: DataFrame, first: int = 10) -> DataFrame:
    """stage, done, total, percent, missing (the first slugs without artifact); expected (slug), artifacts (stage, slug); others do not count."""
    slugs = expected.select("slug").distinct()
    stages = artifacts.select("stage").distinct().agg(F.sort_array(F.collect_set("stage")).alias("stages"))  # one row: a run has a handful of stages
    grid = slugs.join(F.broadcast(stages)).select("slug", F.explode("stages").alias("stage"))
    have = artifacts.select("stage", "slug").distinct().withColumn("have", F.lit(True))
    seen = grid.join(have, ["stage", "slug"], "left")
    rank = F.row_number().over(Window.partitionBy("stage").orderBy("slug"))
    lost = seen.filter("have is null").select("stage", "slug").withColumn("rank", rank).filter(F.col("rank") <= first)
    names = lost.groupBy("stage").agg(F.sort_array(F.collect_list("slug")).alias("missing"))
    counts = seen.groupBy("stage").agg(F.count("have").alias("done"), F.count(F.lit(1)).alias("total"))
    out = counts.join(names, "stage", "left").withColumn("missing", F.coalesce("missing", F.array().cast("array<string>")))
    return out.select("stage", "done", "total", F.round(F.col("done") * 100 / F.col("total"), 2).alias("percent"), "missing")


def resolved(path: Column) -> Column:
    """Parts of an absolute path without . and .. (which stop at the root)."""
    empty = F.array().cast("array<string>")
    up = lambda acc: F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
    step = lambda acc, p: F.when(p.isin("", "."), acc).when(p == "..", up(acc)).otherwise(F.concat(acc, F.array(p)))
    return F.aggregate(F.split(path, "/"), empty, step)


def inside(path: Column, root: str) -> Column:
    """Whether a path, taken from root if it is relative, stays under root."""
    absolute = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))
    base = [p for p in root.split("/") if p]
    return F.slice(resolved(absolute), 1, len(base)) == F.array(*map(F.lit, base))


def path_issues(outputs: DataFrame, root: str) -> DataFrame:
    """Outputs (name, path) that leave the run's folder; empty paths stand for defaults."""
    bad = outputs.filter((F.coalesce("path", F.lit("")) != "") & ~inside(F.col("path"), root))
    return bad.select(F.lit("error").alias("level"), F.lit("output_path_outside_run").alias("code"), F.col("name").cast("string").alias("detail"))


def file_findings(files: DataFrame) -> DataFrame:
    """path, finding of files (path relative to the root, length, content): cache folders, sensitive names, great sizes, and secrets in text files no greater."""
    name, parts = F.element_at(F.split("path", "/"), -1), F.split("path", "/")
    ending = F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))
    small = F.col("length") <= MOST_BYTES
    body = F.decode("content", "ISO-8859-1")
    secrets = [F.when(small & ~body.contains("\0") & body.rlike(p), F.lit(n)) for n, p in SECRETS.items()]
    found = [
        F.when(F.arrays_overlap(parts, F.array(*map(F.lit, CACHE_PARTS))), F.lit("cache path")),
        F.when(name.isin(*SENSITIVE_NAMES) | ending.isin(*SENSITIVE_ENDINGS), F.lit("sensitive name")),
        F.when(~small, F.lit("too large")),
        *secrets,
    ]
    return files.select("path", F.explode(F.array_compact(F.array(*found))).alias("finding"))


def secret_findings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, finding: a row for every kind of secret a text holds."""
    kinds = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), F.lit(n)) for n, p in SECRETS.items()]))
    return docs.select(key, F.explode(kinds).alias("finding"))
