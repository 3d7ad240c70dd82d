"""What changed between two builds, and what of it a person should look at."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.operators.core import snapshot_changes

#: What can be decided about a candidate of each category.
ACTIONS = {
    "new-company": "approve reject merge edit ignore", "new-game": "approve reject merge edit ignore", "relationship-change": "approve reject ignore",
    "classification-change": "approve edit ignore", "technology-claim": "approve reject edit ignore", "source-conflict": "edit ignore", "potential-duplicate": "merge reject ignore",
}
#: Edges whose coming and going is worth a look, and how sure a claim has to be to need none.
WATCHED, SURE = ("developer", "publisher", "subsidiary-of"), ("verified", "high")


def changed_fields(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Every field of rows that both builds have and that differs, null-safe: key, field, old_value, new_value."""
    return snapshot_changes(before, after, key, [c for c in after.columns if c != key and c in before.columns])


def candidate_id(category: Column, subject: Column, details: Column) -> Column:
    return F.concat_ws(":", category, subject, F.substring(F.sha2(details, 256), 1, 12))


def candidates(before: dict[str, DataFrame], after: dict[str, DataFrame], seeded: DataFrame, issues: DataFrame, decided: DataFrame, first_build: bool = False) -> DataFrame:
    """(id, category, subject, actions) of seven categories, each id once and none that is decided.

    before, after: games (id), companies (id, parent_name), edges (from, type, to), claims (game, technology, confidence).
    issues: kind, subject, field, details, suggested. New games and changed edges need a build before; new companies are
    named on the first build too. Of rows that get the same id the last counts: that of the last category, and in it that
    with the greatest details.
    """
    text = lambda c: F.col(c).cast("string")
    parts = []

    def add(ordinal: int, rows: DataFrame, category: Column | str, subject: Column, details: Column, actions: Column | None = None) -> None:
        kind = F.lit(category) if isinstance(category, str) else category
        table = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
        parts.append(rows.select(kind.alias("category"), subject.alias("subject"), details.alias("details"), F.coalesce(actions, table[kind]).alias("actions") if actions is not None else table[kind].alias("actions"), F.lit(ordinal).alias("ordinal")))

    fresh = after["companies"].join(before["companies"].select("id"), "id", "left_anti").join(seeded.select("id"), "id", "left_anti")
    add(1, fresh, "new-company", text("id"), text("id"))
    new_games = after["games"].join(before["games"].select("id"), "id", "left_anti").select("id")
    if not first_build:
        add(2, new_games, "new-game", text("id"), text("id"))
        edge = ["from", "type", "to"]
        for change, one, other in (("added", after["edges"], before["edges"]), ("removed", before["edges"], after["edges"])):
            moved = one.where(F.col("type").isin(*WATCHED)).join(other.select(*edge), edge, "left_anti").join(new_games.select(F.col("id").cast("string").alias("to")), "to", "left_anti")
            add(3, moved, "relationship-change", text("from"), F.concat_ws("|", F.lit(change), "from", "type", "to"))
    parents = before["companies"].select("id", F.col("parent_name").alias("old")).join(after["companies"].select("id", "parent_name"), "id").where(~F.col("old").eqNullSafe(F.col("parent_name")))
    add(4, parents, "classification-change", text("id"), F.concat_ws("|", F.coalesce("old", F.lit("-")), F.coalesce("parent_name", F.lit("-"))))
    claim = ["game", "technology"]
    known = before["claims"].select(*claim, F.col("confidence").alias("was"))
    unsure = after["claims"].join(known, claim, "left").where(~F.col("confidence").isin(*SURE) & ~F.col("confidence").eqNullSafe(F.col("was")))
    add(5, unsure, "technology-claim", text("game"), F.concat_ws("|", "technology", "confidence"))
    kind = F.when(F.col("kind") == "source-conflict", "source-conflict").when(F.col("kind") == "unmatched-technology", "technology-claim").otherwise("potential-duplicate")
    actions = (
        F.when((F.col("kind") == "source-conflict") & F.col("suggested"), "merge edit ignore")
        .when(F.col("kind") == "unmatched-technology", "approve merge reject ignore")
        .when((F.col("kind") == "ambiguous-match") & (F.col("field") == "externalIds"), "edit ignore")
    )
    add(6, issues, kind, text("subject"), F.concat_ws("|", "kind", F.coalesce("field", F.lit("-")), "details"), actions)
    every = functools.reduce(DataFrame.unionByName, parts).withColumn("id", candidate_id(F.col("category"), F.col("subject"), F.col("details")))
    last = every.groupBy("id").agg(F.max(F.struct("ordinal", "details", "category", "subject", "actions")).alias("x"))
    return last.select("id", "x.category", "x.subject", "x.actions").join(decided.select("id"), "id", "left_anti")
