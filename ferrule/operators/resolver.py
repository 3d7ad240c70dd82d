"""Set-based resolution of references to entities: evidence in a fixed order, then learning from what was resolved.

The sequential form, in which each resolved reference changes what later ones see, has no parallel counterpart. Here
each round resolves every reference against the same dictionary, and what the round found extends it for the next;
ties are broken by the smallest id, so that the result doesn't depend on the order of rows.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator, Sequence

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.columns import company_name, core_company_name, loose_company_name, rounded, similarity, slug
from ferrule.operators import core
from ferrule.operators.ids import allocate


def resolve(refs: DataFrame, key: str, steps: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """refs with id and method of the first step that knows them; steps are (method, (id, value), value of a ref)."""
    out, ids, methods = refs, [], []
    for i, (method, known, value) in enumerate(steps):
        best = known.where(F.col("value").isNotNull()).groupBy(F.col("value").alias(f"_v{i}")).agg(F.min("id").alias(f"_id{i}"))
        out = out.withColumn(f"_k{i}", value).join(best, F.col(f"_k{i}") == F.col(f"_v{i}"), "left").drop(f"_k{i}", f"_v{i}")
        ids.append(F.col(f"_id{i}"))
        methods.append(F.when(F.col(f"_id{i}").isNotNull(), F.lit(method)))
    names = [f"_id{i}" for i in range(len(ids))]
    return out.withColumn("id", F.coalesce(*ids)).withColumn("method", F.coalesce(*methods)).drop(*names)


def learn(refs: DataFrame, known: DataFrame) -> DataFrame:
    """(ref, id, round): refs (ref, name, ext) resolved by name against known (id, value), then by the external ids of
    what was resolved before, until a round finds nothing. Each round looks at what the last one taught, and is cut from
    its lineage."""
    spark = refs.sparkSession
    new = core.cut(spark, resolve(refs, "ref", [("name", known, F.col("name"))]).where("id is not null").select("ref", "ext", "id", F.lit(1).alias("round")))
    found, rest, n = new, core.cut(spark, refs.where("ext is not null").join(new, "ref", "left_anti")), 1
    while not new.isEmpty():
        n += 1
        taught = new.where("ext is not null").groupBy(F.col("ext").alias("value")).agg(F.min("id").alias("id"))
        new = core.cut(spark, resolve(rest, "ref", [("learned", taught.select("id", "value"), F.col("ext"))]).where("id is not null").select("ref", "ext", "id", F.lit(n).alias("round")))
        found, rest = found.unionByName(new), rest.join(new, "ref", "left_anti")
    return found


def evidence(names: DataFrame) -> DataFrame:
    """(id, key_type, key) of every company (id, name): exact, loose, and compact of five characters or more."""
    keyed = names.select("id", company_name(F.col("name")).alias("exact"), loose_company_name(F.col("name")).alias("loose"))
    compact = F.replace(F.col("loose"), F.lit(" "), F.lit(""))
    pairs = F.array(F.struct(F.lit("exact").alias("key_type"), F.col("exact").alias("key")), F.struct(F.lit("loose").alias("key_type"), F.col("loose").alias("key")), F.struct(F.lit("compact").alias("key_type"), F.when(F.length(compact) >= 5, compact).alias("key")))
    return keyed.select("id", F.explode(pairs).alias("p")).select("id", "p.*").where("key is not null and key <> ''").distinct()


#: Leading characters that a Jaro-Winkler similarity rewards, and by how much of what is missing each.
LEADING, REWARD = 4, 0.1


def name_keys(names: DataFrame, threshold: float) -> DataFrame:
    """(name, n, letters, words, key, short) of distinct names: pairs that are similar enough share a key.

    Two names with l leading characters in common need a Jaro similarity of j = (t - l / 10) / (1 - l / 10), so that of
    lengths m and n at least (3 j - 1) m n / (m + n) of their characters are common, and (3 j - 2) m of any partner's.
    Of two sets with c tokens in common the first few in any order, all but c - k, share k: an l of 2 and more stands in
    the key with one token, a smaller one with three. Tokens are characters with their occurrence, rarest first by count.
    Names too short for three tokens (`short`) have keys of one, which others have too, for pairs with them alone. Of words
    a share of t must be common; they are tokens likewise, one to a key.
    """
    at = F.sequence(F.lit(1), F.length("name"))
    head = lambda i: F.substring(F.col("name"), F.lit(1), i)
    letter = lambda i: F.substring(F.col("name"), i, F.lit(1))
    letters = F.transform(at, lambda i: F.concat(F.lit("l"), (i - F.length(F.replace(head(i), letter(i), F.lit("")))).cast("string"), letter(i)))
    words = F.transform(F.array_distinct(F.filter(F.split("name", " "), lambda w: w != "")), lambda w: F.concat(F.lit("w"), w))
    tokens = names.select("name", F.explode(F.concat(letters, words)).alias("token"))
    counted = tokens.groupBy("token").agg(F.count("*").alias("n"))
    ranked = tokens.join(counted, "token").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("all"))
    of = lambda kind: F.transform(F.filter("all", lambda x: F.startswith(x["token"], F.lit(kind))), lambda x: x["token"])
    rows = ranked.select("name", F.length("name").alias("n"), of("l").alias("letters"), of("w").alias("words"))
    none = F.expr("cast(array() as array<string>)")
    keys, short = [], F.lit(False)
    for l in range(LEADING + 1):  # noqa: E741
        part = 3 * (threshold - REWARD * l) / (1 - REWARD * l) - 2
        least = F.greatest(F.lit(1), F.ceil(F.col("n") * part - 1e-9).cast("int"))
        front = F.concat(F.lit(f"{l}:"), F.substring("name", 1, l), F.lit(":"))
        one = F.slice("letters", 1, F.col("n") - least + 1)
        near_short = F.lit(l >= 2) | (least <= int(2 / part + 1e-6))  # a short name has that many characters at most
        keys.append(F.when((F.col("n") >= l) & near_short, _prefixed(front if l >= 2 else F.concat(F.lit("s"), front), one)))
        if l < 2:
            first = F.slice("letters", 1, F.col("n") - least + 3)
            keys.append(F.when((F.col("n") >= 3) & (least >= 3), _prefixed(front, _triples(first))))
            short = short | (least < 3)
    share = F.slice("words", 1, F.size("words") - F.ceil(F.size("words") * threshold - 1e-9).cast("int") + 1)
    keys.append(F.when(F.size("words") > 0, _prefixed(F.lit("w:"), share)))
    every = F.array_distinct(F.flatten(F.array(*(F.coalesce(k, none) for k in keys))))
    return rows.select("name", "n", "letters", "words", short.alias("short"), F.explode(every).alias("key"))


def _prefixed(front: Column, tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.concat(front, x))


def _triples(tokens: Column) -> Column:
    """Every three of the tokens, in their order, as one string."""
    join = lambda i, j, z: F.concat_ws(" ", F.get(tokens, i - 1), F.get(tokens, j - 1), z)
    last = lambda i, j: F.transform(F.slice(tokens, j + 1, F.size(tokens)), lambda z: join(i, j, z))
    return F.flatten(F.flatten(F.transform(F.sequence(F.lit(1), F.size(tokens) - 2), lambda i: F.transform(F.sequence(i + 1, F.size(tokens) - 1), lambda j: last(i, j)))))


#: Most keys that a name may have for one partner's length and one number of leading characters.
SUBSETS = 100


def _common(threshold: float, l: int, n: int, m: int) -> int:  # noqa: E741
    """The fewest common characters of names of n and m characters, l leading ones in common, that are similar enough."""
    jaro = (threshold - REWARD * l) / (1 - REWARD * l)
    return max(1, l, math.ceil((3 * jaro - 1) * n * m / (n + m) - 1e-9))


def _subset_plan(lengths: Sequence[int], threshold: float) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
    """For each pair of lengths n <= m that subsets serve: (l, k of n, k of m), where names with l leading characters in
    common share as many of their other characters, in the order of the alphabet, as n - l - k and m - l - k.

    More leading characters in common ask for fewer common ones; a number of them that asks for no fewer than the one
    before has no keys of its own. Pairs of lengths of which one would need too many keys are left to name_keys().
    """
    plan = {}
    for n, m in ((n, m) for n in lengths for m in lengths if n <= m):
        found, last = [], None
        for l in range(min(LEADING, n) + 1):  # noqa: E741
            c = _common(threshold, l, n, m)
            if c <= n and c != last:
                found.append((l, n - c, m - c))
                last = c
        if all(math.comb(m - l, j) <= SUBSETS for l, _, j in found):
            plan[n, m] = found
    return plan


def _subsets(names: Iterator[pd.DataFrame], plan: dict) -> Iterator[pd.DataFrame]:
    """(name, key): a hash of each subset that a name leaves when it drops what a partner of some length may lack."""
    for batch in names:
        out: list[tuple[str, int]] = []
        for name in batch["name"]:
            done = set()
            for (n, m), steps in plan.items():
                for l, i, j in steps:  # noqa: E741
                    for own, drop in {(n, i), (m, j)}:
                        if own == len(name):
                            rest = sorted(name[l:])
                            done |= {f"{l}:{n}:{m}:{name[:l]}:{''.join(x)}" for x in itertools.combinations(rest, len(rest) - drop)}
            out += [(name, xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass")) - (1 << 63)) for k in done]
        yield pd.DataFrame(out, columns=["name", "key"])


def similar_names(names: DataFrame, column: str, threshold: float) -> DataFrame:
    """(a, b, score): every pair a < b of distinct names whose similarity is at least threshold, which is above 0.8.

    Two names that lack few of each other's characters share what is left when each drops what the other may lack: pairs
    of lengths with few such subsets meet at whole ones, so that hardly any pair meets in vain. Other pairs of lengths,
    and names with several words, meet at a key of name_keys(). Neither loses a pair. Candidates are checked by length
    and by common characters or words in the JVM before they are scored. Scores have four digits: what the bounds ask for
    is less by half of the last one, as such scores are rounded up to the threshold.
    """
    least = threshold - 0.00005
    distinct = core.cut(names.sparkSession, names.select(F.col(column).alias("name")).where("name <> ''").distinct())
    lengths = sorted(r[0] for r in distinct.select(F.length("name")).distinct().collect())
    plan = _subset_plan(lengths, least)
    keyed = distinct.mapInPandas(lambda batches: _subsets(batches, plan), "name string, key long")
    x, y = (keyed.select(F.col("name").alias(c), "key") for c in "ab")
    # merged, as sizes guessed from the files would have the driver broadcast all keys
    pairs = x.join(y.hint("merge"), "key").where("a < b").select("a", "b").distinct()
    # names that may meet a partner of a length that subsets don't serve, and those that share words
    s = (3 * least - 1.2) / 0.6 - 1
    open_ = sorted({x for n in lengths for m in lengths if n <= m and (n, m) not in plan and m * (s - 1) <= n + 1e-6 for x in (n, m)})
    spaced = F.contains("name", F.lit(" "))
    word = distinct.where(spaced).select(F.explode(F.split("name", " ")).alias("name")).distinct()  # one word may be all of another name's
    odd = F.length("name").isin(open_) | spaced if open_ else spaced
    rest = distinct.where(odd).union(distinct.where(~odd).join(word.hint("merge"), "name", "left_semi"))
    pairs = pairs.union(_met_names(rest, least)).distinct()
    return pairs.select("a", "b", rounded(similarity(F.col("a"), F.col("b")), 4).alias("score")).where(F.col("score") >= threshold)


def _met_names(distinct: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the candidates of name_keys()."""
    s = (3 * threshold - 1.2) / 0.6 - 1
    keyed = name_keys(distinct, threshold)
    a, b = (keyed.select(*(F.col(c).alias(f"{x}_{c}") for c in ("n", "letters", "words", "short")), F.col("name").alias(x), "key") for x in "ab")
    near = F.size(F.array_intersect("a_letters", "b_letters")) * (F.col("a_n") + F.col("b_n")) >= s * F.col("a_n") * F.col("b_n") - 1e-6
    alike = F.size(F.array_intersect("a_words", "b_words")) >= threshold * F.size(F.array_union("a_words", "b_words")) - 1e-9
    met = ~F.startswith("key", F.lit("s")) | F.col("a_short") | F.col("b_short")
    # all of the shorter one's characters may be common, not more; and words go through whatever the lengths are
    fits = F.startswith("key", F.lit("w")) | (F.greatest("a_n", "b_n") * (s - 1) <= F.least("a_n", "b_n") + 1e-6)
    return a.join(b.hint("merge"), "key").where("a < b").where(met & fits & (near | alike)).select("a", "b").distinct()


PROVIDERS = ("steam", "wikidata", "igdb")


def _differ(a: Column, b: Column) -> Column:
    """Whether two things have different ids of one provider; a missing id differs from none."""
    return functools.reduce(Column.__or__, (F.coalesce(a[p] != b[p], F.lit(False)) for p in PROVIDERS))


def _given() -> Column:
    """Which providers' ids there are, as bits."""
    return functools.reduce(Column.__add__, (F.when(F.col(p).isNotNull(), 1 << i).otherwise(0) for i, p in enumerate(PROVIDERS)))


def _group_key(loose: str) -> Column:
    """What names that differ by blanks share; names of fewer than five characters share just themselves."""
    compact = F.replace(F.col(loose), F.lit(" "), F.lit(""))
    return F.when(F.length(compact) >= 5, F.concat(F.lit("c:"), compact)).when(F.col(loose) != "", F.concat(F.lit("l:"), F.col(loose)))


def match_companies(refs: DataFrame, entries: DataFrame, mapped_ids: DataFrame, mapped_names: DataFrame, registry: DataFrame, distinct: DataFrame) -> DataFrame:
    """(ref, id, method) of every reference (ref, name, steam, wikidata, igdb); id and method are null where it is new.

    entries: id, name, aliases, seeded, steam, wikidata, igdb. mapped_ids and registry: key ("provider:id", the registry
    also "name:key"), id. mapped_names: name, id. distinct: a, b, companies that are never the same.

    The first evidence that says something counts: a mapped id, a mapped name as it stands and then normalised; by
    provider a known id, then a registered one; the one company of the normalised name, or of several the only seeded
    one, else the least; the companies that differ only by trailing words or blanks; the registered name. A company whose
    ids differ from the reference's is none of them. A key's companies are summed up once for each set of providers that a
    reference may have ids of, so that references meet one row a key, whatever number of companies share a name. Ids
    of entries are unique.
    """
    names = entries.select("id", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", F.expr("cast(array() as array<string>)")))).alias("name"))
    keyed = names.select("id", company_name(F.col("name")).alias("exact"), loose_company_name(F.col("name")).alias("loose")).where("exact <> ''").distinct()
    keyed = keyed.withColumn("compact", F.replace("loose", F.lit(" "), F.lit("")))
    apart = distinct.select("a", "b").union(distinct.select("b", "a")).groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("apart"))
    own = entries.join(keyed.select("id").distinct(), "id", "left_semi")
    full = own.select("id", "seeded", F.length("name").alias("length"), "name", _given().alias("given"), *PROVIDERS)

    def seen(members: DataFrame, key: str, **made: Column) -> DataFrame:
        """Sums of a key's companies for each set of providers a reference may have: those with an id of none of them, as a
        reference that shares an id with any company is settled by the id before its name counts. Companies of a key
        and of the same providers combine first, so that a key of any number of companies is one row a set."""
        least = {n: c for n, c in made.items() if n.startswith("least_")} | {f"low_{p}": F.col(p) for p in PROVIDERS}
        most = {f"high_{p}": F.col(p) for p in PROVIDERS}
        count = {"n": F.lit(1), "n_seeded": F.col("seeded").cast("long"), "n_id": (F.col("given") > 0).cast("long")}
        first = members.groupBy(key, "given").agg(*(F.min(c).alias(n) for n, c in least.items()), *(F.max(c).alias(n) for n, c in most.items()), *(F.sum(c).alias(n) for n, c in count.items()))
        asked = F.filter(F.sequence(F.lit(0), F.lit((1 << len(PROVIDERS)) - 1)), lambda m: m.bitwiseAND(F.col("given")) == 0)
        each = first.withColumn("asked", F.explode(asked))
        return each.groupBy(key, "asked").agg(*(F.min(n).alias(n) for n in least), *(F.max(n).alias(n) for n in most), *(F.sum(n).alias(n) for n in count))

    stable = F.struct("length", "id")
    sums = {"least_id": F.col("id"), "least_seeded": F.when(F.col("seeded"), F.col("id")), "least_stable": stable, "least_with_id": F.when(F.col("given") > 0, stable)}
    by_name = seen(keyed.select(F.col("exact").alias("exact_key"), "id").distinct().join(full, "id"), "exact_key", least_id=sums["least_id"], least_seeded=sums["least_seeded"], least_name=F.col("name"))
    member = keyed.select(_group_key("loose").alias("group_key"), "id").where("group_key is not null").distinct()
    groups = seen(member.join(full, "id"), "group_key", **sums)
    # companies of a group that have its short form as a name
    bare = keyed.select("id", F.col("exact").alias("short_key"), _group_key("exact").alias("group_key")).join(member, ["id", "group_key"], "left_semi").select("id", "short_key").distinct()
    shorts = seen(bare.join(full, "id"), "short_key", **sums)
    # pairs in one group that are never the same; they clash for references that both are open to
    of = lambda c: full.select(F.col("id").alias(c), F.col("given").alias(f"given_{c}")).join(member.withColumnRenamed("id", c), c)
    never = distinct.select("a", "b").where("a <> b").join(of("a"), "a").join(of("b"), ["b", "group_key"])
    never = never.select("group_key", F.explode(F.sequence(F.lit(0), F.lit((1 << len(PROVIDERS)) - 1))).alias("asked"), F.col("given_a").bitwiseOR(F.col("given_b")).alias("either"))
    never = never.where(F.col("asked").bitwiseAND(F.col("either")) == 0).select("group_key", "asked").distinct().withColumn("never", F.lit(True))

    # of each loose key the least and the greatest company that goes on with a word which isn't left out
    words = F.split("exact", " ")
    heads = keyed.select("id", "loose", F.explode(F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda n: F.array_join(F.slice(words, 1, n), " "))).alias("head"))
    longer = heads.where("head <> loose").groupBy(F.col("head").alias("prefix_key")).agg(F.min("id").alias("longer_least"), F.max("id").alias("longer_most"))

    out = refs.withColumns({"exact_key": company_name(F.col("name")), "loose_key": loose_company_name(F.col("name"))})
    out = out.withColumns({"group_key": _group_key("loose_key"), "short_key": F.col("loose_key"), "prefix_key": F.col("loose_key"), "asked": _given()})
    for key, found, name in (("exact_key", by_name, "named"), ("group_key", groups, "group"), ("short_key", shorts, "short")):
        out = out.join(found.select(key, "asked", *(F.col(c).alias(f"{name}_{c}") for c in found.columns[2:])), [key, "asked"], "left")
    out = out.join(never, ["group_key", "asked"], "left")
    out = out.join(longer, "prefix_key", "left")

    steps: list[tuple[Column, Column]] = []
    known = entries.select(F.explode(F.array(*(F.struct(F.concat(F.lit(f"{p}:"), p).alias("key"), F.col("seeded")) for p in PROVIDERS))).alias("k"), "id").select("k.*", "id").where("key is not null")
    known = known.groupBy("key").agg(F.min(F.struct((~F.col("seeded")).alias("later"), "id"))["id"].alias("id"))  # seeds are registered first
    for label, table in (("mapped", mapped_ids), ("known", known), ("registered", registry)):
        least = table.groupBy("key").agg(F.min("id").alias("id"))
        for p in PROVIDERS:
            out = out.withColumn("_k", F.concat(F.lit(f"{p}:"), p)).join(least.select(F.col("key").alias("_k"), F.col("id").alias(f"{label}_{p}")), "_k", "left").drop("_k")
    said = mapped_names.groupBy("name").agg(F.min("id").alias("mapped_exact"))
    alike = mapped_names.groupBy(company_name(F.col("name")).alias("exact_key")).agg(F.min_by("id", "name").alias("mapped_alike"))
    out = out.join(said, "name", "left").join(alike, "exact_key", "left")
    by_name = registry.where("key like 'name:%'").groupBy(F.substring("key", 6, 1 << 30).alias("exact_key")).agg(F.min("id").alias("registered_name"))
    ids = own.select(F.col("id").alias("registered_name"), F.struct(*PROVIDERS).alias("registered_ids"))
    out = out.join(by_name, "exact_key", "left").join(ids, "registered_name", "left")

    own_ids = F.struct(*PROVIDERS)
    n = lambda name, what="n": F.coalesce(f"{name}_{what}", F.lit(0))
    clash = functools.reduce(Column.__or__, (F.coalesce(F.col(f"group_low_{p}") != F.col(f"group_high_{p}"), F.lit(False)) for p in PROVIDERS)) | F.col("never").isNotNull()
    has_short = n("short") > 0
    # several names of a group: those that are just the short name, and of these the only one with an id
    least = lambda name: F.when(n(name, "n_id") == 1, F.col(f"{name}_least_with_id")).otherwise(F.col(f"{name}_least_stable"))["id"]
    best = F.when(has_short, least("short")).otherwise(least("group"))
    shared = lambda id_: F.coalesce((F.col("longer_least") != id_) | (F.col("longer_most") != id_), F.lit(False))
    chief = F.col("group_least_seeded")
    folded = (
        F.when((F.col("loose_key") == "") | (n("group") == 0) | clash | (n("group", "n_seeded") > 1), None)
        .when(n("group", "n_seeded") == 1, F.when(has_short | ~shared(chief), chief))
        .otherwise(F.when(has_short | ~shared(F.col("group_least_id")), best))
    )
    out = out.withColumn("_folded", folded)
    several = F.when(n("named", "n_seeded") == 1, F.col("named_least_seeded")).otherwise(F.col("named_least_id"))
    only = F.col("named_least_id")
    steps += [(F.col(f"mapped_{p}"), F.lit("mapping")) for p in PROVIDERS] + [(F.col("mapped_exact"), F.lit("mapping")), (F.col("mapped_alike"), F.lit("mapping"))]
    steps += [x for p in PROVIDERS for x in ((F.col(f"known_{p}"), F.lit("external-id")), (F.col(f"registered_{p}"), F.lit("registry")))]
    same = F.coalesce(F.col("_folded") == only, F.lit(True)) & (F.col("named_least_name") == F.col("name"))
    steps += [
        (F.when(n("named") == 1, F.coalesce("_folded", only)), F.when(same, "name").otherwise("normalized-name")),
        (F.when(n("named") > 1, F.coalesce("_folded", several)), F.lit("normalized-name")),
        (F.col("_folded"), F.lit("normalized-name")),
        (F.when(F.col("registered_ids").isNull() | ~_differ(F.col("registered_ids"), own_ids), F.col("registered_name")), F.lit("registry")),
    ]
    return out.select("ref", F.coalesce(*(v for v, _ in steps)).alias("id"), F.coalesce(*(F.when(v.isNotNull(), m) for v, m in steps)).alias("method"))


def _ref_keys(refs: DataFrame) -> DataFrame:
    """(ref, key): what a reference is known by, each kind of name and each provider's id."""
    loose = loose_company_name(F.col("name"))
    compact = F.replace(loose, F.lit(" "), F.lit(""))
    kinds = {"exact": company_name(F.col("name")), "loose": loose, "compact": F.when(F.length(compact) >= 5, compact)} | {p: F.col(p) for p in PROVIDERS}
    every = F.array(*(F.when(v != "", F.concat(F.lit(f"{k}:"), v)) for k, v in kinds.items()))
    return refs.select("ref", F.explode(F.array_compact(every)).alias("key"))


def resolve_all(refs: DataFrame, entries: DataFrame, mapped_ids: DataFrame, mapped_names: DataFrame, registry: DataFrame, distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ref, id, method, created, round) of every reference, and the entries afterwards (with `created`); inputs as for
    match_companies(), ids are text.

    A fixpoint over growing relations: what a round resolves teaches its company the reference's name and provider ids
    (of several the least reference's; a company keeps the ids it has), and the next round asks again only for
    references that share a key with what was learned. Where a round teaches nothing, each reference that has the least
    ref among all open ones of each of its keys makes a company, with an id that nobody has; those that share its keys
    meet it in the next round. There is always such a reference, so rounds go on until none is open, and none depends on
    the order of rows.
    """
    spark = refs.sparkSession
    none = F.expr("cast(array() as array<string>)")
    shape = ["id", "name", "aliases", "seeded", *PROVIDERS]
    entries = core.cut(spark, entries.select(*shape).withColumn("created", F.lit(False)))
    open_ = core.cut(spark, refs.select("ref", "name", *PROVIDERS).dropDuplicates(["ref"]))
    keys = core.cut(spark, _ref_keys(open_))
    taken = core.cut(spark, functools.reduce(DataFrame.union, (x.select(F.col("id").cast("string").alias("id")) for x in (entries, mapped_ids, mapped_names, registry))))
    asked, done, n = open_, [], 0
    found = asked.limit(0).select("ref", F.lit("").alias("id"), F.lit("").alias("method"), F.lit(False).alias("created"))
    while not open_.isEmpty():
        n += 1
        found = found.limit(0) if asked.isEmpty() else match_companies(asked, entries.select(*shape), mapped_ids, mapped_names, registry, distinct).where("id is not null").withColumn("created", F.lit(False))
        found = core.cut(spark, found)
        if found.isEmpty():
            least = keys.groupBy("key").agg(F.min("ref").alias("least"))
            later = keys.join(least, "key").where("ref <> least").select("ref").distinct()
            first = open_.join(later, "ref", "left_anti")
            own = allocate(first.select(F.col("ref").alias("key"), F.array(slug(F.col("name"))).alias("candidates")), taken)
            found = core.cut(spark, own.select(F.col("key").alias("ref"), "id", F.lit("new").alias("method"), F.lit(True).alias("created")))
            taken = taken.union(found.select("id"))
        done.append(found.withColumn("round", F.lit(n)))
        taught = found.join(open_, "ref").groupBy("id").agg(F.min(F.struct("ref", "name"))["name"].alias("said"), F.array_sort(F.collect_set("name")).alias("names"), F.max("created").alias("fresh"), *(F.min(F.when(F.col(p).isNotNull(), F.struct("ref", p)))[p].alias(f"own_{p}") for p in PROVIDERS))
        entries = core.cut(spark, entries.join(taught, "id", "full").select(
            "id", F.coalesce("name", "said").alias("name"), F.array_except(F.array_union(F.coalesce("aliases", none), F.coalesce("names", none)), F.array(F.coalesce("name", "said"))).alias("aliases"),
            F.coalesce("seeded", F.lit(False)).alias("seeded"), *(F.coalesce(p, f"own_{p}").alias(p) for p in PROVIDERS), (F.coalesce("created", F.lit(False)) | F.coalesce("fresh", F.lit(False))).alias("created")))
        open_ = core.cut(spark, open_.join(found, "ref", "left_anti"))
        touched = keys.join(found, "ref", "left_semi").select("key").distinct()
        keys = core.cut(spark, keys.join(found, "ref", "left_anti"))
        asked = core.cut(spark, open_.join(keys.join(touched, "key", "left_semi").select("ref").distinct(), "ref", "left_semi"))
    whole = functools.reduce(DataFrame.unionByName, done) if done else found.withColumn("round", F.lit(n))
    return whole.select("ref", "id", "method", "created", "round"), entries


def suggested_links(names: DataFrame, column: str, entries: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(name, suggestion, score): for each unmatched name the most alike core name of an entry (id, name), if it is at
    least that alike; the least id of several. Threshold as for similar_names(), which gives the candidates."""
    core = core_company_name(F.col("name"))
    known = entries.select("id", core.alias("core")).where("core <> ''").groupBy("core").agg(F.min("id").alias("id"))
    asked = names.select(F.col(column).alias("name")).distinct().withColumn("own", core).where("own <> ''")
    pairs = similar_names(asked.select(F.col("own").alias("c")).union(known.select("core")), "c", threshold)
    both = pairs.select("a", "b", "score").union(pairs.select("b", "a", "score")).unionByName(known.select(F.col("core").alias("a"), F.col("core").alias("b"), F.lit(1.0).alias("score")))
    found = asked.join(both, F.col("own") == F.col("a")).join(known, F.col("b") == F.col("core"))
    best = found.groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("minus"), "id")).alias("best"))
    return best.select("name", F.col("best.id").alias("suggestion"), (-F.col("best.minus")).alias("score"))
