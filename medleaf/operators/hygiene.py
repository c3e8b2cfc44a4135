"""Scans of a corpus for patterns that should not be published, and of paths for forbidden names."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names and patterns looked for.
FORBIDDEN_PARTS = (".aider", ".codex", ".cursor", ".windsurf")
FORBIDDEN_NAMES = ("AGENTS.md", "CLAUDE.md", "CODEX.md", "GEMINI.md", "copilot-instructions.md")
PATTERNS = {
    "agentic-development-reference": r"(?i)\bagentic\b",
    "private-ovh-hostname": r"(?i)\bns\d+\.ip-\d+-\d+-\d+\.us\b",
    "github-token": r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9_]{20,}\b",
    "github-fine-grained-token": r"\bgithub_pat_[A-Za-z0-9_]{20,}\b",
    "openai-token": r"\bsk-[A-Za-z0-9_-]{20,}\b",
    "database-url-with-password": r"(?i)\bpostgres(?:ql)?://[^:\s/@{}]+:[^@\s{}]+@",
    "password-assignment": r"""(?i)\b(?:password|passwd|secret|token)\s*[:=]\s*['"][^'"\s]{8,}['"]""",
}
BINARY_HEAD = 4096
#: For each pattern texts of which one must stand in the lower-cased text; found faster than the pattern is tried.
NEEDED = {
    "agentic-development-reference": ("agentic",),
    "private-ovh-hostname": (".ip-",),
    "github-token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "github-fine-grained-token": ("github_pat_",),
    "openai-token": ("sk-",),
    "database-url-with-password": ("postgres",),
    "password-assignment": ("password", "passwd", "secret", "token"),
}


def scan_texts(docs: DataFrame, key: str, text: str, patterns: dict[str, str] = PATTERNS, skip: DataFrame | None = None, needed: dict[str, tuple[str, ...]] = NEEDED) -> DataFrame:
    """(label, key) of every named pattern that a text holds. Null texts and texts with a zero character near the start
    hold none; keys of skip are left out.
    """
    rows = docs.select(key, text) if skip is None else docs.select(key, text).join(skip.select(key), key, "left_anti")
    rows = rows.filter(F.col(text).isNotNull() & ~F.contains(F.substring(text, 1, BINARY_HEAD), F.lit("\0")))

    def holds(label: str) -> Column:
        found = F.col(text).rlike(patterns[label])
        some = [F.contains("__low", F.lit(x)) for x in needed.get(label, ())]
        return F.when(functools.reduce(Column.__or__, some), found).otherwise(False) if some else found

    hits = F.filter(F.array(*[F.when(holds(label), F.lit(label)) for label in patterns]), lambda x: x.isNotNull())
    return rows.withColumn("__low", F.lower(text)).select(F.explode(hits).alias("label"), key)


def scan_paths(paths: DataFrame, path: str, parts: tuple[str, ...] = FORBIDDEN_PARTS, names: tuple[str, ...] = FORBIDDEN_NAMES) -> DataFrame:
    """(problem, path) of paths with a forbidden component or base name; a path may have both."""
    piece = F.split(F.col(path), "/")
    problems = F.array(
        F.when(F.arrays_overlap(piece, F.array(*[F.lit(p) for p in parts])), F.lit("forbidden path component")),
        F.when(F.element_at(piece, -1).isin(*names), F.lit("forbidden instruction file")),
    )
    return paths.select(F.explode(F.filter(problems, lambda x: x.isNotNull())).alias("problem"), path)
