"""Config files, logging and row counts that both jobs share."""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging
import os
from collections.abc import Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

Config = TypeVar("Config")
LOG = logging.getLogger("jobs")


def load(kind: type[Config], path: str) -> Config:
    """The JSON object in a small local file as a config; keys that it lacks keep their defaults, unknown ones are errors."""
    with open(path, encoding="utf-8") as file:
        values = json.load(file)
    unknown = set(values) - {f.name for f in dataclasses.fields(kind)}
    if unknown:
        raise ValueError(f"unknown settings in {path}: {', '.join(sorted(unknown))}")
    return kind(**values)


def beside(file: str) -> str:
    """The config file that stands beside a job's module."""
    return os.path.splitext(file)[0] + ".json"


def parser(about: str, file: str, paths: dict[str, str]) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=about)
    for name, help in paths.items():
        out.add_argument(f"--{name}", required=True, help=help)
    out.add_argument("--config", default=beside(file), help="JSON file of settings")
    return out


def parsed(about: str, file: str, paths: dict[str, str], argv: Sequence[str] | None) -> argparse.Namespace:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    return parser(about, file, paths).parse_args(argv)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df and an observation that has its number of rows once a plan with it has run, without a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows(seen: Observation) -> int:
    return int(seen.get.get("rows") or 0)
