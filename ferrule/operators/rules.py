"""Rules as data: what entities of each kind must look like, checked as one expression a kind and a few joins.

A rule names a path below an entity. `a.b` is a field of a struct, `a[]` every item of an array and `a{}` every value of
a map, at any depth. The rules of a kind become one Column that walks the entity once and returns each failing place
with its full path (`links[3]`, `technology.engine[0].id`). What needs other rows is joined: references by (kind, id),
values that only one entity may have, and ids that occur twice.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions import columns as C

LOCAL, JOINED = ("required", "pattern", "among", "least", "most"), ("reference", "exclusive")
#: How values are made alike before they are told apart, by the name that a rule gives.
FORMS: dict[str, Callable[[Column], Column]] = {"plain": lambda v: v, "company": C.company_name, "technology": C.technology_name, "title": C.title_name}
FAILURE = "array<struct<level: string, path: string, message: string>>"
PLACE = "array<struct<level: string, path: string, rule: string, target: string, key: string, shown: string>>"
OUT = ("level", "kind", "id", "path", "message")


@dataclass(frozen=True)
class Rule:
    """One rule: a path, what is asked of it, and the value that the check takes.

    required: not null, and no blank text. pattern: a regular expression found in the value. among: one of a list.
    least, most: a number. reference: the kind that has the id, or None with `by` naming the field beside the last one
    that holds the kind. exclusive: (group, form); in a group a value belongs to one id, whatever path it stands at.
    Nulls pass all checks but required.
    """

    path: str
    check: str
    value: Any = None
    by: str | None = None
    level: str = "error"

    def __post_init__(self) -> None:
        if self.check not in LOCAL + JOINED:
            raise ValueError(f"{self.path}: unknown check {self.check}")
        if self.level not in ("error", "warning"):
            raise ValueError(f"{self.path}: unknown level {self.level}")
        if self.check == "exclusive" and self.value[1] not in FORMS:
            raise ValueError(f"{self.path}: unknown form {self.value[1]}")
        if self.check == "reference" and (self.value is None) == (self.by is None):
            raise ValueError(f"{self.path}: a reference has either a kind or a field that names it")
        if self.by is not None and steps(self.path)[-1] in ("[]", "{}"):
            raise ValueError(f"{self.path}: items have no field beside them")


def steps(path: str) -> list[str]:
    """The steps of a path: names, `[]` and `{}`."""
    found = re.findall(r"\[\]|\{\}|[^.\[\]{}]+", path)
    if not found or found[0] in ("[]", "{}") or re.sub(r"\.(?=[^.\[\]{}])", "", path) != "".join(found):
        raise ValueError(f"not a path: {path!r}")
    return found


def _field(parent: Column | None, name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`") if parent is None else parent.getField(name)


def _walk(value: Column | None, parent: Column | None, todo: Sequence[str], path: Column, leaf: Callable, shape: str) -> Column:
    """The places that todo leads to from value, each as leaf(value, struct it is a field of, path) gives them."""
    if not todo:
        return leaf(value, parent, path)
    step, rest = todo[0], todo[1:]
    none = F.array().cast(shape)
    if step == "[]":
        each = F.transform(value, lambda x, i: _walk(x, None, rest, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), leaf, shape))
        return F.coalesce(F.flatten(each), none)
    if step == "{}":
        each = F.transform(F.map_entries(value), lambda e: _walk(e["value"], None, rest, F.concat(path, F.lit("."), e["key"].cast("string")), leaf, shape))
        return F.coalesce(F.flatten(each), none)
    below = F.lit(step) if value is None else F.concat(path, F.lit(f".{step}"))
    return _walk(_field(value, step), value, rest, below, leaf, shape)


def _judged(rule: Rule, value: Column) -> tuple[Column, str]:
    shown = value.cast("string")
    if rule.check == "required":
        return value.isNull() | F.coalesce(F.trim(shown) == "", F.lit(False)), "is missing"
    if rule.check == "pattern":
        return ~shown.rlike(rule.value), f"doesn't match {rule.value}"
    if rule.check == "among":
        return ~value.isin(*rule.value), f"is none of {', '.join(map(str, rule.value))}"
    return (value < rule.value, f"is below {rule.value}") if rule.check == "least" else (value > rule.value, f"is above {rule.value}")


def _each(rules: Sequence[Rule], leaf: Callable[[Rule], Callable], shape: str) -> Column:
    found = [_walk(None, None, steps(r.path), F.lit(""), leaf(r), shape) for r in rules]
    return F.concat(*found) if found else F.array().cast(shape)


def failures(rules: Sequence[Rule]) -> Column:
    """Every failing place of a row under the rules that need no other row, in the order of rules and places."""

    def leaf(rule: Rule) -> Callable:
        def one(value: Column, parent: Column | None, path: Column) -> Column:
            bad, message = _judged(rule, value)
            row = F.struct(F.lit(rule.level).alias("level"), path.alias("path"), F.lit(message).alias("message"))
            return F.when(bad, F.array(row).cast(FAILURE)).otherwise(F.array().cast(FAILURE))

        return one

    return _each([r for r in rules if r.check in LOCAL], leaf, FAILURE)


def places(rules: Sequence[Rule]) -> Column:
    """Every place of a row that other rows decide, with the kind or group that is asked and the key."""

    def leaf(rule: Rule) -> Callable:
        def one(value: Column, parent: Column | None, path: Column) -> Column:
            if rule.check == "exclusive":
                target, key = F.lit(rule.value[0]), FORMS[rule.value[1]](value.cast("string"))
            else:
                target, key = (F.lit(rule.value) if rule.by is None else _field(parent, rule.by).cast("string")), value.cast("string")
            row = F.struct(F.lit(rule.level).alias("level"), path.alias("path"), F.lit(rule.check).alias("rule"), F.coalesce(target, F.lit("?")).alias("target"), key.alias("key"), value.cast("string").alias("shown"))
            return F.when(key.isNotNull() & (key != ""), F.array(row).cast(PLACE)).otherwise(F.array().cast(PLACE))

        return one

    return _each([r for r in rules if r.check in JOINED], leaf, PLACE)


def check(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]], id: str = "id") -> DataFrame:
    """(level, kind, id, path, message) of everything wrong with the tables, which are named by their kind.

    Ids are compared as text. A null id is an error, of repeated ids each gives one row with their number. A reference
    to a kind that no table has is unknown. Empty tables and kinds without rules give no rows; columns that no rule
    names are not read. A hot key is asked once: references and claims are told apart before they are joined, and only
    places of bad keys meet them again.
    """
    if not tables:
        raise ValueError("no tables")
    wanted = {kind: list(rules.get(kind, ())) for kind in tables}
    stray = set(rules) - set(tables)
    if stray:
        raise ValueError(f"rules for kinds without a table: {', '.join(sorted(stray))}")
    union = functools.partial(functools.reduce, DataFrame.unionByName)
    key = F.col(f"`{id}`").cast("string").alias("id")

    def exploded(kind: str, found: Column) -> DataFrame:
        return tables[kind].select(F.lit(kind).alias("kind"), key, F.explode(found).alias("x")).select("kind", "id", "x.*")

    local = union([exploded(k, failures(r)) for k, r in wanted.items()]).select(*OUT)
    ids = union([df.select(F.lit(k).alias("kind"), key) for k, df in tables.items()]).groupBy("kind", "id").agg(F.count("*").alias("n"))
    wrong = F.when(F.col("id").isNull(), F.format_string("no id in %d rows", "n")).when(F.col("n") > 1, F.format_string("%d rows of one id", "n"))
    twice = ids.select(F.lit("error").alias("level"), "kind", "id", F.lit(id).alias("path"), wrong.alias("message")).where("message is not null")

    asked = union([exploded(k, places(r)) for k, r in wanted.items()])
    refs, claims = asked.where("rule = 'reference'"), asked.where("rule = 'exclusive'")
    known = ids.select(F.col("kind").alias("target"), F.col("id").alias("key"))
    lost = refs.select("target", "key").distinct().join(known, ["target", "key"], "left_anti")
    unknown = refs.join(lost, ["target", "key"]).withColumn("message", F.concat(F.lit("unknown "), "target", F.lit(" "), "key")).select(*OUT)
    owner = F.struct("kind", "id")
    shared = claims.groupBy("target", "key").agg(F.min(owner).alias("a"), F.max(owner).alias("b")).where("a <> b")
    other = F.concat_ws(" ", F.col("a.kind"), F.col("a.id"))
    last = F.concat_ws(" ", F.col("b.kind"), F.col("b.id"))
    told = F.concat(F.lit("'"), "shown", F.lit("' is used from "), other, F.lit(" to "), last)
    return union([local, twice, unknown, claims.join(shared, ["target", "key"]).withColumn("message", told).select(*OUT)])
