"""A published folder of many small files: written where they differ, and rid of what is no longer published."""

from __future__ import annotations

import hashlib
import posixpath
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def filesystem(path: str):
    """pyarrow's file system for a path or URI, and the path in it."""
    from pyarrow import fs

    path = re.sub("^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def present(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256) of the files below a folder, by their path in it; none where there is no folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, sha256 string")
    top = re.sub("^file:/+", "/", root).rstrip("/") + "/"
    return files.select(F.regexp_replace("path", "^.*?" + re.escape(top), "").alias("path"), F.sha2("content", 256).alias("sha256"))


def planned_changes(files: DataFrame, there: DataFrame) -> DataFrame:
    """(path, content, action) of what has to happen: write what is missing or differs, delete what isn't published."""
    now = files.select("path", "content", F.sha2(F.col("content").cast("binary"), 256).alias("new"))
    both = now.join(there, "path", "full")
    action = F.when(F.col("new").isNull(), "delete").when(~F.col("new").eqNullSafe(F.col("sha256")), "write")
    return both.select("path", "content", action.alias("action")).where("action is not null")


def sync(files: DataFrame, root: str) -> DataFrame:
    """Makes a folder hold exactly the files (path, content); what was done, one row a file. A second run does nothing.

    Executors write and delete, each its own files; a file is written under another name and then moved.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = filesystem(root)
        for batch in batches:
            for path, content, action in zip(batch["path"], batch["content"], batch["action"], strict=True):
                at = posixpath.join(top, path)
                if action == "delete":
                    store.delete_file(at)
                    continue
                raw = (content or "").encode("utf-8", "surrogatepass")
                store.create_dir(posixpath.dirname(at), recursive=True)
                aside = posixpath.join(posixpath.dirname(at), f".{posixpath.basename(at)}.{hashlib.sha256(raw).hexdigest()[:12]}")
                with store.open_output_stream(aside, compression=None) as out:
                    out.write(raw)
                store.move(aside, at)
            yield batch[["path", "action"]]

    spark = files.sparkSession
    plan = planned_changes(files, present(spark, root))
    done = plan.mapInPandas(run, "path string, action string").collect()  # names of changed files alone
    return spark.createDataFrame([tuple(r) for r in done], "path string, action string")


def documents(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """(path, content): for each name one JSON document of a table, or, with a key column, one for each of its rows or
    groups at name/key.json, rows sorted by their text."""
    out = None
    for name, (df, key) in tables.items():
        row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        path = F.lit(f"{name}.json") if key is None else F.concat(F.lit(f"{name}/"), F.col(key).cast("string"), F.lit(".json"))
        body = F.concat(F.lit("[\n"), F.array_join(F.array_sort(F.collect_list("row")), ",\n"), F.lit("\n]\n"))
        one = df.select(path.alias("path"), row.alias("row")).groupBy("path").agg(body.alias("content"))
        out = one if out is None else out.unionByName(one)
    return out
