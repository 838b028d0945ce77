"""Configurations: small files that the driver reads and checks."""

from __future__ import annotations

import json
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from tallyloom.model import ENDPOINTS


def load_yaml(path: str) -> dict:
    """A YAML mapping; anything else is an error. PyYAML is needed only for this."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("PyYAML is not installed") from e
    value = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ValueError(f"{path} does not hold a mapping")
    return value


def load_json(path: str) -> dict:
    """A JSON object that is not empty."""
    value = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict) or not value:
        raise ValueError(f"{path} does not hold a mapping")
    return value


def load_key(path: str, name: str) -> str:
    """The value of ``name`` in a file of ``NAME=value`` lines: comments and quotes go, percent-encoding is undone."""
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        key, found, value = line.strip().removeprefix("export ").partition("=")
        if found and not line.lstrip().startswith("#") and key.strip() == name:
            value = value.strip()
            value = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
            if value:
                return unquote(value)
    raise ValueError(f"{name} is not set in {path}")


def endpoints(spark: SparkSession, config: dict) -> DataFrame:
    """The catalogue of a configuration as a table."""
    rows = config.get("endpoints")
    if not isinstance(rows, list) or not rows:
        raise ValueError("the configuration has no endpoints")
    names = [part.split()[0] for part in ENDPOINTS.split(", ")]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], ENDPOINTS)


def expected_series(spark: SparkSession, config: dict) -> DataFrame:
    """``group_code, label, domain, series, expected`` out of nested groups."""
    rows = [(group, label, str(g["domain"]), str(s["id"]), int(s["expected_files"])) for group, g in config["groups"].items() for label, s in g.get("series", {}).items()]
    return spark.createDataFrame(rows, "group_code string, label string, domain string, series string, expected int")
