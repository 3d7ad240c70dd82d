"""Corrections by hand over entities of any shape: an entity is its leaves, (path, value), and its lists, (path, values)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.operators import core

#: How sure a correction is by the type of its source; any other is "high".
CONFIDENCE = {
    "official": "verified", "manual": "high", "developer-interview": "high", "technical-article": "high", "job-posting": "medium",
    "community": "low", "inferred": "inferred",
}


def _within(path: Column, other: Column) -> Column:
    """Whether path is other or lies below it."""
    return (path == other) | F.startswith(path, F.concat(other, F.lit(".")))


#: Operations of an entry, in the order in which they count.
OPERATIONS = ("exclude", "create", "set", "append", "remove")
_STATE = """struct<exists:boolean,excluded:boolean,created:boolean,leaves:array<struct<path:string,value:string>>,
  lists:array<struct<path:string,values:array<string>>>,touched:array<struct<path:string,source:string>>,problems:array<string>>"""


def _after(state: Column, step: Column) -> Column:
    """The state of an entity after one operation."""
    op, path, value = step["op"], step["path"], step["value"]
    empty = lambda name: F.filter(state[name], lambda x: F.lit(False))
    apart = lambda name: F.filter(state[name], lambda x: ~(_within(x["path"], path) | _within(path, x["path"])))
    had = F.coalesce(F.get(F.filter(state["lists"], lambda x: x["path"] == path), 0)["values"], F.expr("cast(array() as array<string>)"))
    grown = F.when(F.exists(had, lambda x: x.eqNullSafe(value)), had).otherwise(F.concat(had, F.array(value)))
    left = F.filter(had, lambda x: ~x.eqNullSafe(value))
    edits, unknown = op.isin("set", "append", "remove"), ~state["exists"]
    fresh = (op == "exclude") | ((op == "create") & unknown)
    acts = edits & state["exists"]
    now = F.struct(path.alias("path"), F.when(op == "append", grown).otherwise(left).alias("values"))
    said = F.struct(path.alias("path"), F.coalesce(step["source"], F.lit("manual")).alias("source"))
    problem = F.concat(F.lit("entry "), step["ordinal"].cast("string"), F.lit(" for something unknown"))
    either = lambda name, changed: F.when(fresh, empty(name)).when(acts, changed).otherwise(state[name])
    return F.struct(
        F.when(op == "exclude", False).when(op == "create", True).otherwise(state["exists"]).alias("exists"),
        (state["excluded"] | (op == "exclude")).alias("excluded"),
        (state["created"] | ((op == "create") & unknown)).alias("created"),
        either("leaves", F.when(op == "set", F.concat(apart("leaves"), F.array(F.struct(path.alias("path"), value.alias("value"))))).otherwise(apart("leaves"))).alias("leaves"),
        either("lists", F.when(op == "set", apart("lists")).otherwise(F.concat(apart("lists"), F.array(now)))).alias("lists"),
        either("touched", F.concat(F.filter(state["touched"], lambda x: x["path"] != path), F.array(said))).alias("touched"),
        F.when(edits & unknown, F.array_union(state["problems"], F.array(problem))).otherwise(state["problems"]).alias("problems"),
    )


def apply_log(entities: DataFrame, entries: DataFrame) -> DataFrame:
    """(id, known, exists, excluded, created, leaves, lists, touched, problems) of everything that entities (id, leaves map,
    lists map of arrays) or entries (id, ordinal, op, path, value, source; position, if some of an entry have an order) name.

    Entry follows entry, by ordinal; within one the operations follow OPERATIONS, and then position. `exclude` takes the
    entity away, with all it had; `create` makes an empty one where there is none. `set` puts a value at a dot path: what
    lay at the path or below it goes, and so does what lies at a path above, as that becomes an object; other leaves
    stay, so that a nested object given leaf by leaf is a deep merge. `append` adds a value to the list at the path unless
    it is there, `remove` takes it out; either makes a list where there was none. Edits of what doesn't exist then are
    problems, one an entry. known: it was among the entities; excluded, created: it ever was. touched: path to the
    struct of source and confidence of the last edit since the entity was made. An entity's log is folded in its row.
    """
    place = F.col("position").cast("long") if "position" in entries.columns else F.lit(0).cast("long")
    rank = F.array_position(F.array(*(F.lit(o) for o in OPERATIONS)), F.col("op"))
    steps = F.array_sort(F.collect_list(F.struct(F.col("ordinal").cast("long").alias("ordinal"), rank.alias("rank"), place.alias("position"), "path", "value", "op", "source")))
    log = entries.where(F.col("op").isin(*OPERATIONS)).groupBy("id").agg(steps.alias("_steps"))
    both = entities.select("id", "leaves", "lists", F.lit(True).alias("known")).join(log, "id", "full")
    none = lambda kind: F.expr(f"cast(array() as {kind})")
    pairs = lambda m, name, kind: F.coalesce(F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("path"), e["value"].alias(name))), none(f"array<struct<path:string,{name}:{kind}>>"))
    known = F.coalesce("known", F.lit(False))
    start = F.struct(known.alias("exists"), F.lit(False).alias("excluded"), F.lit(False).alias("created"), pairs("leaves", "value", "string").alias("leaves"), pairs("lists", "values", "array<string>").alias("lists"), none("array<struct<path:string,source:string>>").alias("touched"), none("array<string>").alias("problems"))
    steps = F.coalesce("_steps", none("array<struct<ordinal:bigint,rank:bigint,position:bigint,path:string,value:string,op:string,source:string>>"))
    done = both.select("id", known.alias("known"), F.aggregate(steps, start.cast(_STATE), lambda s, e: _after(s, e).cast(_STATE)).alias("s"))
    sure = F.create_map(*(F.lit(x) for pair in CONFIDENCE.items() for x in pair))
    as_map = lambda name, value: F.map_from_entries(F.transform(F.col("s")[name], lambda x: F.struct(x["path"].alias("key"), value(x).alias("value"))))
    touched = as_map("touched", lambda x: F.struct(x["source"].alias("source"), F.coalesce(sure[x["source"]], F.lit("high")).alias("confidence")))
    return done.select("id", "known", "s.exists", "s.excluded", "s.created", as_map("leaves", lambda x: x["value"]).alias("leaves"), as_map("lists", lambda x: x["values"]).alias("lists"), touched.alias("touched"), "s.problems")


def apply_overrides(entities: DataFrame, entries: DataFrame) -> DataFrame:
    """(id, leaves, lists, touched) of the entities that are there after entries, see apply_log()."""
    return apply_log(entities, entries).where("known and exists").select("id", "leaves", "lists", "touched")


def problems(entries: DataFrame, fields: DataFrame, computed: DataFrame, editorial: DataFrame) -> DataFrame:
    """(id, path, level, problem) of entries (id, op, path, source): the first part of a path must be a known field that
    isn't computed; a factual field wants a source. fields, computed and editorial have one column, field."""
    top = F.element_at(F.split("path", r"\."), 1)
    rows = entries.where(F.col("op").isin("set", "append", "remove")).withColumn("field", top)
    flag = lambda df, name: df.select("field").distinct().withColumn(name, F.lit(True))
    seen = rows.join(flag(fields, "known"), "field", "left").join(flag(computed, "made"), "field", "left").join(flag(editorial, "free"), "field", "left")
    seen = seen.join(editorial.select(F.col("field").alias("path")).distinct().withColumn("free_path", F.lit(True)), "path", "left")
    problem = F.when(F.col("known").isNull(), "unknown field").when(F.col("made").isNotNull(), "computed field").when(F.col("source").isNull() & F.col("free").isNull() & F.col("free_path").isNull(), "no source")
    found = seen.select("id", "path", problem.alias("problem")).where("problem is not null").distinct()
    both = entries.groupBy("id").agg(F.max((F.col("op") == "create").cast("int")).alias("c"), F.max((F.col("op") == "exclude").cast("int")).alias("e")).where("c = 1 and e = 1")
    clash = both.select("id", F.lit("").alias("path"), F.lit("both created and excluded").alias("problem"))
    return found.unionByName(clash).select("id", "path", F.when(F.col("problem") == "no source", "warning").otherwise("error").alias("level"), "problem")


def json_leaves(rows: DataFrame, json: str = "json") -> DataFrame:
    """rows with (path, value) of each leaf of a JSON object of any shape: what is no object, or an empty one, at its dot path
    as canonical text. One step a depth, until no object is left; what isn't an object has no leaves."""
    spark, others = rows.sparkSession, [c for c in rows.columns if c != json]
    is_object = F.startswith(F.schema_of_variant("v"), F.lit("OBJECT<")) & (F.schema_of_variant("v") != "OBJECT<>")
    open_ = core.cut(spark, rows.select(*others, F.lit("").alias("path"), F.to_json(F.try_parse_json(json)).alias("v")).where("v is not null"))
    parsed, found = open_.withColumn("v", F.parse_json("v")).where(is_object), []
    while True:
        inner = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("key"), F.col("value").alias("of")))
        step = inner.select(*others, F.when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key")).alias("path"), F.to_json("of").alias("value"))
        step = core.cut(spark, step.withColumn("deeper", F.startswith("value", F.lit("{")) & (F.col("value") != "{}")))
        found.append(step.where("not deeper").select(*others, "path", "value"))
        if step.where("deeper").isEmpty():
            return functools.reduce(DataFrame.unionByName, found)
        parsed = step.where("deeper").select(*others, "path", F.parse_json("value").alias("v"))


def read_entries(entries: DataFrame) -> DataFrame:
    """(id, ordinal, op, path, value, source, position) of entries (id, ordinal, json, source) as apply_log() takes them. json
    is {"exclude", "create", "set", "append", "remove"}: flags, values of any shape by dot path or nested, and lists of
    values by path. Values are canonical JSON, so that equal ones are equal text."""
    keys = ["id", "ordinal", "source"]
    parsed = entries.withColumn("v", F.try_parse_json("json"))
    part = lambda name: F.to_json(F.try_variant_get("v", f"$.{name}", "variant"))
    flags = [parsed.where(F.try_variant_get("v", f"$.{op}", "boolean")).select(*keys, F.lit(op).alias("op"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("value"), F.lit(0).alias("position")) for op in ("exclude", "create")]
    sets = json_leaves(parsed.select(*keys, part("set").alias("json"))).select(*keys, F.lit("set").alias("op"), "path", "value", F.lit(0).alias("position"))
    listed = functools.reduce(DataFrame.union, (parsed.select(*keys, F.lit(op).alias("op"), part(op).alias("json")) for op in ("append", "remove")))
    values = json_leaves(listed)
    each = F.transform(F.expr("cast(try_parse_json(value) as array<variant>)"), lambda v: F.to_json(v))
    lists = values.where("value like '[%'").select(*keys, "op", "path", F.posexplode(each).alias("position", "value")).select(*keys, "op", "path", "value", "position")
    return functools.reduce(DataFrame.unionByName, [*flags, sets, lists])
