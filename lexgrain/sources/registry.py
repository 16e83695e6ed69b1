"""Source definitions from YAML, and selections of them."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "name string, source_type string, base_url string, enabled boolean, requests_per_second double, max_documents int, queries array<string>"


class RegistryError(ValueError):
    """The registry is missing or doesn't hold valid definitions."""


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per source of a YAML file ``{sources: [{name, source_type, ...}]}``."""
    try:
        with open(path, encoding="utf-8") as f:
            doc = yaml.safe_load(f)
    except FileNotFoundError as e:
        raise RegistryError(f"no registry at {path}") from e
    except yaml.YAMLError as e:
        raise RegistryError(f"registry isn't YAML: {e}") from e
    rows = (doc or {}).get("sources") if isinstance(doc, dict) else None
    if not isinstance(rows, list):
        raise RegistryError("registry has no list of sources")
    out = []
    for r in rows:
        if not isinstance(r, dict) or not r.get("name") or not r.get("source_type"):
            raise RegistryError(f"source without name or type: {r!r}")
        rate = float(r.get("requests_per_second", 1.0))
        if rate <= 0:
            raise RegistryError(f"rate of {r['name']} must be positive")
        out.append((str(r["name"]), str(r["source_type"]), r.get("base_url"), bool(r.get("enabled", True)), rate, int(r.get("max_documents", 1000)), [str(q) for q in r.get("queries", [])]))
    return spark.createDataFrame(out, SCHEMA)


def select_sources(registry: DataFrame, name: str | None = None, source_type: str | None = None) -> DataFrame:
    """Enabled sources, by name (whatever its case, blanks around it) or type."""
    df = registry.where("enabled")
    if name is not None:
        df = df.where(F.lower(F.trim("name")) == name.strip().lower())
    return df.where(F.col("source_type") == source_type) if source_type else df
