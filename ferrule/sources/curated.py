"""Files that are kept by hand: YAML lists with a declared shape, checked before they become tables."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import yaml
except ImportError:  # only these files need it
    yaml = None

_IDS = "externalIds map<string,string>"
_PATCH = "id string, create boolean, exclude boolean, set map<string,string>, append map<string,array<string>>, remove map<string,array<string>>, source struct<type:string,url:string,retrievedAt:string>, note string"
#: The curated set: file, shape of an entry.
CURATED = {
    "seeds/companies": f"id string, name string, aliases array<string>, roles array<string>, classification struct<include:boolean,category:string,notes:string>, {_IDS}, discover boolean",
    "seeds/technologies": f"id string, name string, aliases array<string>, category string, subcategory string, developer string, website string, license string, {_IDS}, description string",
    "overrides/games": _PATCH, "overrides/companies": _PATCH, "overrides/people": _PATCH,
    "overrides/technology": "game string, technology string, role string, confidence string, source struct<type:string,url:string,retrievedAt:string>, remove boolean, note string",
    "overrides/relationships": "from string, type string, to string, confidence string, source struct<type:string,url:string,retrievedAt:string>, remove boolean",
    "mappings/companies": "key string, id string", "mappings/distinct": "a string, b string", "decisions": "candidate string, action string, date string",
}
#: Values of fields that an entry leaves out.
DEFAULTS = {"discover": True, "create": False, "exclude": False, "remove": False, "aliases": [], "roles": []}


class ShapeError(ValueError):
    """The entries of a file don't have its shape; `paths` lists every place."""

    def __init__(self, name: str, paths: list[str]):
        super().__init__(f"{name}: " + "; ".join(paths))
        self.paths = paths


def misfits(value: Any, kind: T.DataType, path: str) -> list[str]:
    """Every place in a value that isn't of a type."""
    if value is None:
        return []
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return [f"{path}: not an object"]
        unknown = [f"{path}.{k}: unknown field" for k in value if k not in kind.names]
        return unknown + [m for f in kind.fields for m in misfits(value.get(f.name), f.dataType, f"{path}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        return [m for i, v in enumerate(value) for m in misfits(v, kind.elementType, f"{path}[{i}]")] if isinstance(value, list) else [f"{path}: not a list"]
    if isinstance(kind, T.MapType):
        return [m for k, v in value.items() for m in misfits(v, kind.valueType, f"{path}.{k}")] if isinstance(value, dict) else [f"{path}: not an object"]
    wanted = {T.StringType: str, T.BooleanType: bool, T.LongType: int, T.DoubleType: (int, float)}[type(kind)]
    return [] if isinstance(value, wanted) and (wanted is bool or not isinstance(value, bool)) else [f"{path}: not a {kind.simpleString()}"]


def _made(value: Any, kind: T.DataType) -> Any:
    if isinstance(kind, T.StructType) and value is not None:
        return tuple(_made(value.get(f.name, DEFAULTS.get(f.name)), f.dataType) for f in kind.fields)
    return value


def read_yaml(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """The entries of a YAML list, in order. A missing or empty file has none; fields that are left out get DEFAULTS, or
    null; anything that doesn't fit raises ShapeError with every place."""
    if yaml is None:
        raise RuntimeError("PyYAML is needed to read YAML")
    kind = T.StructType.fromDDL(shape)
    try:
        text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "")).collect())  # kept by hand, hence small
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        text = ""
    entries = yaml.load(text, Loader=yaml.SafeLoader) or []
    entries = [{k: _plain(v, kind[k].dataType) if k in kind.names else v for k, v in e.items()} if isinstance(e, dict) else e for e in entries] if isinstance(entries, list) else entries
    wrong = [m for i, e in enumerate(entries) for m in (misfits(e, kind, f"[{i}]") or ([] if isinstance(e, dict) else [f"[{i}]: not an object"]))] if isinstance(entries, list) else ["not a list"]
    if wrong:
        raise ShapeError(path, wrong)
    return spark.createDataFrame([_made(e, kind) for e in entries], kind)


def _plain(value: Any, kind: T.DataType) -> Any:
    """Dates and numbers that YAML makes of plain words are text again where text is wanted."""
    if isinstance(kind, T.StringType) and value is not None and not isinstance(value, (str, bool, dict, list)):
        return str(value)
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        return {k: _plain(v, kind[k].dataType) if k in kind.names else v for k, v in value.items()}
    if isinstance(kind, T.MapType) and isinstance(value, dict):
        return {str(k): _plain(v, kind.valueType) for k, v in value.items()}
    if isinstance(kind, T.ArrayType) and isinstance(value, list):
        return [_plain(v, kind.elementType) for v in value]
    return value


def load_curated(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table of the curated set; what isn't there is empty."""
    return {name: read_yaml(spark, f"{root.rstrip('/')}/{name}.yaml", shape) for name, shape in CURATED.items()}


def mapped(found: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Of the mapping entries those by provider id (key, id) and those by name (name, id)."""
    rows = found["mappings/companies"]
    by_id = F.col("key").rlike("^(steam|wikidata|igdb):")
    return rows.where(by_id).select("key", "id"), rows.where(~by_id).select(F.col("key").alias("name"), "id")
