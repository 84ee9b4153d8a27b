"""Configuration and secrets."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

FIELD_SCHEMA = "field_name string, question string, type string, source string, extraction_strategy string, reduce string, validation_pattern string, item_fields array<struct<name:string,type:string>>, position int"


def load_json(path: str):
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def fields(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """The field configuration as a small table; no entries is an error."""
    if not entries:
        raise ValueError("no fields are configured")
    names = [c.split()[0] for c in FIELD_SCHEMA.split(", ")[:-1]]
    rows = [tuple([tuple((i["name"], i.get("type")) for i in e["item_fields"]) if n == "item_fields" and e.get(n) else e.get(n) for n in names]) + (k,) for k, e in enumerate(entries)]
    return spark.createDataFrame([[list(v) if isinstance(v, tuple) else v for v in r] for r in rows], FIELD_SCHEMA)


def load_secrets(paths: Iterable[str], override: bool = False, environ=os.environ) -> str | None:
    """KEY=VALUE lines of the first of the paths that is there, into the environment; gives that path."""
    for path in dict.fromkeys(paths):
        if not os.path.isfile(path):
            continue
        with open(path, encoding="utf-8") as f:
            for line in map(str.strip, f):
                key, eq, value = line.partition("=")
                if line.startswith("#") or not eq:
                    continue
                value = value.strip()
                if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                    value = value[1:-1]
                if override or key.strip() not in environ:
                    environ[key.strip()] = value
        return path
    return None


class Context:
    """Layers and where they lie; a stage that expects another layer than the attached one fails at once."""

    def __init__(self, layers: dict[str, str], attached: str):
        if attached not in layers:
            raise ValueError(f"{attached} isn't one of {sorted(layers)}")
        self.layers, self.attached = dict(layers), attached

    def mount(self, layer: str, path: str) -> str:
        """Where a layer lies; to say the same again does nothing, to say something else of it fails."""
        if self.layers.setdefault(layer, path) != path:
            raise RuntimeError(f"{layer} is mounted at {self.layers[layer]}, not at {path}")
        return path

    def expect(self, layer: str) -> str:
        if layer != self.attached:
            raise RuntimeError(f"this stage runs on {layer}, not on {self.attached}")
        return self.layers[layer]
