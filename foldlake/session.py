"""The session of the command line, where settings that are given already, as on a cluster, stay; and shared folders."""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession


def session(name: str) -> SparkSession:
    """A session in UTC with adaptive execution."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder in spark.checkpoint.dir, which the driver and all executors share. Only with a local
    master, whose executors are the driver, that setting may be missing; the folder is a temporary one then."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or "local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="foldlake-")
    at = at.rstrip("/") if urlsplit(at).scheme else "file://" + at.rstrip("/")
    return f"{at}/{name}-{uuid.uuid4().hex}"
