"""Ports to models and services, with deterministic defaults that need no network.

A provider answers a batch of requests. It is called inside mapInArrow, and a request that fails
becomes a row with an error, not a failed task. budget bounds the estimated tokens of one call's
batch; the answers of each call leave Python before the next is made, so that what a worker holds
doesn't grow with the table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from .files import bound_batches

Provider = Callable[[list[str]], list[str]]


def admitted(costs: list[int], budget: int) -> Iterator[range]:
    """Runs of requests, in order, whose costs, each held to the budget, fit it together."""
    start, held = 0, 0
    for i, c in enumerate(costs):
        c = min(c, budget)
        if held and held + c > budget:
            yield range(start, i)
            start, held = i, 0
        held += c
    if start < len(costs):
        yield range(start, len(costs))


def call(df: DataFrame, column: str, provider: Provider, budget: int = 500_000, reserve: int = 2000) -> DataFrame:
    """df with ok, payload and error for the requests in a column."""
    bound_batches(df.sparkSession)
    schema = df.schema.simpleString()[7:-1] + ",ok:boolean,payload:string,error:string"

    def answered(requests: list[str]) -> list[tuple]:
        try:
            answers = [(True, a, None) for a in provider(requests)]
        except Exception:  # one by one, so that the others keep their answers
            answers = []
            for r in requests:
                try:
                    answers.append((True, provider([r])[0], None))
                except Exception as e:
                    answers.append((False, None, f"{type(e).__name__}: {e}"[:500]))
        return answers

    def run(batches):
        for batch in batches:
            asked = batch.column(column)
            costs = [max(1, (n or 0) // 4 + reserve) for n in pa.compute.utf8_length(asked).to_pylist()]
            for part in admitted(costs, budget):
                answers = answered(["" if r is None else r for r in asked.slice(part.start, len(part)).to_pylist()])
                told = [pa.array([a[i] for a in answers], kind) for i, kind in enumerate((pa.bool_(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.slice(part.start, len(part)).columns, *told], [*batch.schema.names, "ok", "payload", "error"])

    return df.mapInArrow(run, schema)


def call_with_fallback(df: DataFrame, column: str, provider: Callable[[list[str], str], list[str]], formats: tuple[str, ...] = ("json_schema", "json_object"), budget: int = 500_000) -> DataFrame:
    """As call(), for a provider(requests, format): requests that fail in one response format, or whose answer isn't a JSON object, are made again in the next."""

    def one(requests: list[str], fmt: str) -> list[str]:
        answers = provider(requests, fmt)
        for a in answers:
            if not isinstance(json.loads(a), dict):
                raise ValueError("the answer is no JSON object")
        return answers

    def tried(requests: list[str]) -> list[str]:
        for fmt in formats[:-1]:
            try:
                return one(requests, fmt)
            except Exception:  # the next format decides
                continue
        return one(requests, formats[-1])

    return call(df, column, tried, budget)


def hashed_embedding(texts: list[str | None], dim: int = 64) -> list[list[float]]:
    """Words hashed to signed places, length one; the default where there is no embedding model."""
    out = []
    for t in texts:
        v = np.zeros(dim)
        for w in re.findall(r"\w+", (t or "").lower()):
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            v[h % dim] += 1 if h >> 63 else -1
        n = np.linalg.norm(v)
        out.append((v / n if n else v).astype("float32").tolist())
    return out


def embed(df: DataFrame, text: str, embedding: Callable[[list[str | None]], list[list[float]]] = hashed_embedding, batch: int = 100) -> DataFrame:
    """df with embedding, in requests of so many texts, order kept."""
    bound_batches(df.sparkSession)
    schema = df.schema.simpleString()[7:-1] + ",embedding:array<float>"

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, batch):
                part = whole.slice(i, batch)
                vectors = pa.array(embedding(part.column(text).to_pylist()), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*part.columns, vectors], [*part.schema.names, "embedding"])

    return df.mapInArrow(run, schema)


def layout_of_text(requests: list[str]) -> list[str]:
    """A layout result for plain text: lines are paragraphs (short ones headings, some page footers), runs of lines with bars are tables, {{fig}} lines figures.

    The default where there is no layout service. Pages are so many lines; each line is one word,
    with a confidence that its length tells.
    """
    out = []
    for text in requests:
        at, page, paragraphs, words, tables, run = 0, 1, [], [], [], []

        def end_table(run=None, tables=tables):
            if run:
                cells = [{"row": r, "col": c, "row_span": 1, "col_span": 1, "kind": "columnHeader" if r == 0 else "content", "text": x.strip()} for r, (_, line) in enumerate(run) for c, x in enumerate(line.split(" | "))]
                tables.append({"row_count": len(run), "column_count": max(c["col"] for c in cells) + 1, "regions": [{"page": 1 + run[0][0][2] // 40}], "spans": [{"offset": run[0][0][0], "length": sum(len(x) + 1 for _, x in run)}], "cells": cells})

        for n, line in enumerate(text.split("\n")):
            page = 1 + n // 40
            if " | " in line:
                run.append(((at, page, n), line))
            else:
                end_table(run)
                run = []
            role = "sectionHeading" if len(line) < 40 else "pageFooter" if len(line) % 11 == 0 else None
            paragraphs.append({"role": role, "content": line, "regions": [{"page": page}], "spans": [{"offset": at, "length": len(line)}]})
            words.append({"offset": at, "length": len(line), "confidence": 1 - len(line) % 7 / 10})
            at += len(line) + 1
        end_table(run)
        pages = [{"width": 8.5, "height": 11.0, "words": words}] + [{"width": 8.5, "height": 11.0, "words": []} for _ in range(page - 1)]
        out.append(json.dumps({"content": text, "paragraphs": paragraphs, "tables": tables, "figures": [], "pages": pages}))
    return out


def page_of_text(requests: list[str]) -> list[str]:
    """Stands in for rendered pages: {"text", "page"} gives the text of that page (forty lines each), an error beyond the last."""
    out = []
    for r in requests:
        q = json.loads(r)
        lines = q["text"].split("\n")[40 * (q["page"] - 1) : 40 * q["page"]]
        if q["page"] < 1 or not lines:
            raise ValueError(f"no page {q['page']}")
        out.append("\n".join(lines))
    return out


def rule_verify(requests: list[str]) -> list[str]:
    """Looks at {"page", "value"}: confirmed if the page holds the value, contradicted if it holds none of its words, else unclear."""
    out = []
    for r in requests:
        q = json.loads(r)
        page, value = q["page"].lower(), str(q["value"]).lower()
        words = re.findall(r"\w+", value)
        verdict = "confirmed" if value in page else "contradicted" if words and not any(w in page for w in words) else "unclear"
        out.append(json.dumps({"verdict": verdict, "rationale": f"{sum(w in page for w in words)} of {len(words)} words"}))
    return out


def rule_correct(requests: list[str]) -> list[str]:
    """Reads {"page", "pattern"} anew: the pattern's first match and its line, or unclear without a value."""
    out = []
    for r in requests:
        q = json.loads(r)
        found = json.loads(rule_extractor([json.dumps({"text": q["page"], "patterns": {"x": q["pattern"]}})])[0])["x"] if q.get("pattern") else {"value": None, "evidence": None}
        verdict = "correct" if found["value"] else "unclear"
        out.append(json.dumps(found | {"verdict": verdict, "rationale": "read from the page"}))
    return out


def rule_match(requests: list[str]) -> list[str]:
    """Judges {"expected", "actual"} by the share of words that the two have in common."""
    out = []
    for r in requests:
        q = json.loads(r)
        a, b = (set(re.findall(r"\w+", str(q.get(k) or "").lower())) for k in ("expected", "actual"))
        share = len(a & b) / len(a | b) if a | b else 1.0
        out.append(json.dumps({"score": share, "verdict": "same" if share == 1 else "other", "rationale": f"{len(a & b)} of {len(a | b)} words"}))
    return out


def first_spellings(requests: list[str]) -> list[str]:
    """Stands in for a model that consolidates {"items"}: of items with the same letters and digits the first stays."""
    out = []
    for r in requests:
        kept: dict[str, str] = {}
        for item in json.loads(r)["items"]:
            kept.setdefault(re.sub(r"\W+", "", str(item).lower()), item)
        out.append(json.dumps({"items": [v for k, v in kept.items() if k]}))
    return out


def rule_extractor(requests: list[str]) -> list[str]:
    """Answers {"text", "patterns": {field: regex}} with the first match and its line for each field."""
    out = []
    for r in requests:
        q = json.loads(r)
        found = {}
        for field, pattern in q["patterns"].items():
            m = re.search(pattern, q["text"])
            line = q["text"][q["text"].rfind("\n", 0, m.start()) + 1 : (q["text"] + "\n").find("\n", m.end())] if m else None
            found[field] = {"value": m.group(m.lastindex or 0) if m else None, "evidence": line}
        out.append(json.dumps(found))
    return out


def rule_judge(requests: list[str]) -> list[str]:
    """Judges {"value", "quote", "located"}: correct if the quote holds the value, partial if half its words are there."""
    out = []
    for r in requests:
        q = json.loads(r)
        value, quote = str(q.get("value") or "").lower(), str(q.get("quote") or "").lower()
        words = set(re.findall(r"\w+", value))
        share = len(words & set(re.findall(r"\w+", quote))) / max(1, len(words))
        out.append("unverifiable" if not q.get("located") else "correct" if value and value in quote else "partial" if share >= 0.5 else "incorrect")
    return out


def rule_judge_fields(requests: list[str]) -> list[str]:
    """Judges all fields of a document, {"fields": {name: {"value", "quote"}}}, in one answer {name: {"verdict", "rationale"}}; fields without a value aren't judged."""
    out = []
    for r in requests:
        fields = {n: f for n, f in json.loads(r)["fields"].items() if f.get("value") is not None}
        verdicts = rule_judge([json.dumps(f | {"located": bool(f.get("quote"))}) for f in fields.values()])
        out.append(json.dumps({n: {"verdict": v, "rationale": "by rule"} for n, v in zip(fields, verdicts)}))
    return out
