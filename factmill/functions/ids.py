"""Identities: versions, fingerprints of code and derived keys."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_LENGTH = 16


def short_hash(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of the parts joined by bars; a null part is written None."""
    named = [F.coalesce(p.cast("string"), F.lit("None")) for p in parts]
    return F.substring(F.sha2(F.concat_ws("|", *named), 256), 1, ID_LENGTH)


def version_id(natural_key: Column, content: Column, code: Column) -> Column:
    return short_hash(natural_key, content, code)


def evidence_id(version: Column, field: Column) -> Column:
    return short_hash(version, field)


def audit_id(version: Column, field: Column, stage: Column, step: Column) -> Column:
    return short_hash(version, field, stage, step)


def safe_key(path: Column, suffix: Column, version: Column) -> Column:
    """A key for stores that allow letters, digits, _, - and = only."""
    return F.concat(F.regexp_replace(path, r"[^A-Za-z0-9_\-=]", "_"), F.lit("_"), suffix.cast("string"), F.lit("__"), version)


def file_fingerprint(path: str) -> str:
    """SHA-256 of a file's bytes; a token with its name if it can't be read."""
    try:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()
    except OSError:
        return "missing:" + path.rstrip("/").rpartition("/")[2]


def code_fingerprint(files: Iterable[str], params: Mapping | None = None, length: int = ID_LENGTH) -> str:
    """One digest of source files, in the order of their paths, and the parameters that shape a stage's output."""
    digest = hashlib.sha256()
    for path in sorted(files):
        digest.update(f"{file_fingerprint(path)}|".encode())
    digest.update(json.dumps(dict(params or {}), sort_keys=True, default=str).encode())
    return digest.hexdigest()[:length]
