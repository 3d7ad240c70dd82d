"""Rules as data against a walk over plain values."""

import random
import re

import pytest

from ferrule.operators.rules import Rule, check, steps

SHAPE = "id string, name string, aliases array<string>, rel struct<parent: string, kind: string>, tech map<string, array<struct<id: string, share: double, type: string>>>, extra int, path string, level string"
RULES = {
    "game": [
        Rule("name", "required"),
        Rule("aliases[]", "pattern", "^[A-Z]", level="warning"),
        Rule("rel.parent", "reference", "game"),
        Rule("rel.kind", "among", ("dlc", "port")),
        Rule("tech{}[].id", "reference", by="type"),
        Rule("tech{}[].share", "least", 0.0),
        Rule("tech{}[].share", "most", 1.0, level="warning"),
        Rule("name", "exclusive", ("names", "title")),
        Rule("aliases[]", "exclusive", ("names", "plain")),
    ],
    "tool": [Rule("name", "required")],
}


def values(row, todo, path="", parent=None):
    """(path, value, parent) of every place, one step after another."""
    if not todo:
        return [(path, row, parent)]
    step, rest = todo[0], todo[1:]
    if step == "[]":
        return [x for i, v in enumerate(row or []) for x in values(v, rest, f"{path}[{i}]")]
    if step == "{}":
        return [x for k, v in (row or {}).items() for x in values(v, rest, f"{path}.{k}")]
    return values(None if row is None else row[step], rest, f"{path}.{step}" if path else step, row)


def plain(tables):
    out, claims = [], []
    known = {(kind, r["id"]) for kind, rows in tables.items() for r in rows}
    for kind, rows in tables.items():
        ids = [r["id"] for r in rows]
        for i in set(ids):
            if i is None:
                out.append(("error", kind, None, "id", f"no id in {ids.count(i)} rows"))
            elif ids.count(i) > 1:
                out.append(("error", kind, i, "id", f"{ids.count(i)} rows of one id"))
        for r in rows:
            for rule in RULES[kind]:
                for path, v, parent in values(r, steps(rule.path)):
                    say = lambda m: out.append((rule.level, kind, r["id"], path, m))  # noqa: B023, E731
                    if rule.check == "required" and (v is None or not str(v).strip(" ")):
                        say("is missing")
                    if v is None:
                        continue
                    if rule.check == "pattern" and not re.search(rule.value, v):
                        say(f"doesn't match {rule.value}")
                    if rule.check == "among" and v not in rule.value:
                        say(f"is none of {', '.join(rule.value)}")
                    if rule.check == "least" and v < rule.value:
                        say(f"is below {rule.value}")
                    if rule.check == "most" and v > rule.value:
                        say(f"is above {rule.value}")
                    if rule.check == "reference" and v:
                        target = rule.value or parent[rule.by] or "?"
                        if (target, v) not in known:
                            say(f"unknown {target} {v}")
                    if rule.check == "exclusive":
                        key = v if rule.value[1] == "plain" else " ".join(re.findall("[a-z0-9]+", v.lower()))
                        if key:
                            claims.append((key, (kind, r["id"]), rule.level, path, v))
    for key, owner, level, path, v in claims:
        owners = sorted({o for k, o, *_ in claims if k == key}, key=lambda o: (o[0], o[1] is not None, o[1] or ""))
        if len(owners) > 1:
            a, b = (" ".join(x for x in o if x is not None) for o in (owners[0], owners[-1]))
            out.append((level, *owner, path, f"'{v}' is used from {a} to {b}"))
    return sorted(map(str, out))


def made(seed, n):
    rng = random.Random(seed)
    pick = lambda *xs: rng.choice(xs)
    tech = lambda: {"id": pick(None, "", "t1", "g2", "x"), "share": pick(None, -1.0, 0.5, 2.0), "type": pick(None, "tool", "game", "what")}
    return [
        {
            "id": pick(None, f"g{i}", f"g{i}", "g2"), "name": pick(None, "", " ", f"Name {i}", "Moon", "moon"), "aliases": pick(None, [], ["moon", "A", None, "a"], [f"Al {i}"]),
            "rel": pick(None, {"parent": pick(None, "g1", "g99"), "kind": pick(None, "dlc", "other")}), "tech": pick(None, {}, {"engine": [tech(), tech()], "tool": None}, {"language": [tech()]}), "extra": i, "path": "p", "level": "l",
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_entities(spark, seed):
    tables = {"game": made(seed, 40), "tool": [{"id": "t1", "name": "Tool", "level": "x"}, {"id": "t1", "name": None, "level": "x"}]}
    frames = {"game": spark.createDataFrame(tables["game"], SHAPE), "tool": spark.createDataFrame(tables["tool"], "id string, name string, level string")}
    got = check(frames, RULES).collect()
    want = plain(tables)
    assert len(want) > 60
    assert sorted(str(tuple(r)) for r in got) == want


def test_empty_tables_and_kinds_without_rules(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert check({"game": empty, "tool": empty}, RULES).collect() == []
    one = spark.createDataFrame([(7,)], "id long")
    assert check({"thing": one}, {}).collect() == []


@pytest.mark.parametrize(
    "make",
    [lambda: Rule("a", "odd"), lambda: Rule("a", "required", level="note"), lambda: Rule("a", "reference"), lambda: Rule("a[]", "reference", by="b"), lambda: Rule("a", "exclusive", ("g", "odd")), lambda: steps("a..b"), lambda: steps("[]"), lambda: steps("a.b."), lambda: steps("")],
)
def test_rules_that_say_nothing_are_refused(make):
    with pytest.raises(ValueError):
        make()


def test_rules_of_a_kind_without_table(spark):
    with pytest.raises(ValueError, match="ghost"):
        check({"thing": spark.range(1)}, {"ghost": [Rule("a", "required")]})
