"""Personal data, DataFrame functions and Spark ML only.

Base spans follow fixed rules. Generators of high recall propose further spans, overlapping ones too, each for one kind or
several. Boosted trees score every proposal by its format and its context; they learn from proposals that agree with a
base span (half of both covered) against all others. A threshold for each kind is calibrated on all proposals, scored by
trees that learned from other documents: the lowest score from which proposals are right often enough. Proposals above it that touch no base span
are added, the best of each chain of overlapping ones.

Texts are searched once. From then on each match is a row: its place is a running sum of the lengths of what stands
between matches, so that texts with any number of matches cost no more than sorting them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import free_name, saved, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The base rules, written so that a long text takes linear time: a match starts where a run starts or the last one ended,
#: and what can't match otherwise isn't tried again. Same matches as the plain forms in the tests.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
OCTETS = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
_WORD = r"[^\s@<>()\[\]{}\",;:!?|*#$&=]"
#: name: (kinds a match is proposed for, pattern).
GENERATORS = {
    "address": (("email",), rf"(?<!{_WORD}){_WORD}++\s?(?:@|[(\[{{]\s?(?:at|AT)\s?[)\]}}])\s?{_WORD}++"),
    "dotted": (("ip",), r"(?<![0-9A-Za-z.:])[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){2,7}"),
    "digits": (("card", "phone"), r"(?<![0-9])[0-9]++(?:[.-][0-9]++)*+"),
    "groups": (("card", "phone"), r"(?<![0-9])[+(]?[0-9](?:[\x20()./-]{0,2}[0-9])++"),
    "local": (("phone",), r"(?<![0-9])\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])"),
}
#: Fewest digits of a proposed card or phone.
LEAST_DIGITS = 7
#: Words that announce personal data of a kind.
CUES = {"email": "mail|contact|write|kontakt|correo|courriel|from|to", "ip": "ip|host|server|addr|address|client", "card": "card|visa|karte|tarjeta|carte|credit|iban|account|konto", "phone": "tel|phone|call|fax|mobile|cell|telefon|handy|móvil|appel"}
CONTEXT = 24
ROUNDS, DEPTH, PRECISION, BINS, LEAST_ROWS = 20, 4, 0.97, 100, 20


def _matches(text: Column, generator: str, pattern: str, gate: Column) -> Column:
    """array<struct>: matches in order, each with the length of what stands before it and what surrounds it."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    one = lambda m, i: F.struct(F.lit(generator).alias("generator"), i.alias("nth"), F.char_length(between[i]).alias("gap"), m.alias("match"), F.right(between[i], F.lit(CONTEXT)).alias("before"), F.substring(between[i + 1], 1, CONTEXT).alias("after"))
    none = F.expr("cast(array() as array<struct<generator:string,nth:int,gap:int,match:string,before:string,after:string>>)")
    return F.when(gate, F.transform(found, one)).otherwise(none)


def searched(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs, written, with a row key and all matches of base rules and generators in the place of `text`."""
    whole = text_or_empty(text)
    at, digit = whole.contains("@"), whole.rlike("[0-9]")
    gates = {"email": at, "address": at | whole.rlike(r"(?i)[(\[{]\s?at\s?[)\]}]"), "phone": whole.contains("+")}
    every = [_matches(whole, n, p, gates.get(n, digit)) for n, p in [*BASE.items(), *((n, p) for n, (_, p) in GENERATORS.items())]]
    others = [c for c in docs.columns if c.lower() != text.lower()]
    return saved(docs.select(*others, F.monotonically_increasing_id().alias(free_name(docs.columns, "row")), F.concat(*every).alias(free_name(docs.columns, "matches"))), "private-matches")


def _luhn(digits: Column) -> Column:
    """Whether digits pass the check of card numbers."""
    def each(total: Column, i: Column) -> Column:
        x = F.substring(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), each) % 10 == 0


def _valid(kind: Column, match: Column, digits: Column) -> Column:
    n = F.char_length(digits)
    return F.when(kind == "email", True).when(kind == "ip", match.rlike(OCTETS)).when(kind == "card", n.between(12, 19) & F.when(n.between(12, 19), _luhn(digits)).otherwise(False)).otherwise(n.between(9, 15))


def spans(found: DataFrame, row: str = "row", matches: str = "matches") -> DataFrame:
    """(row, kind, place of the kind, start, stop, base, match, before, after): base spans, and proposals for each kind;
    failing base matches are proposals too. Places count code points, stop is exclusive."""
    long = found.select(F.col(row).alias("row"), F.explode(matches).alias("m")).select("row", "m.*")
    so_far = Window.partitionBy("row", "generator").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("match")
    long = long.withColumn("stop", F.sum(F.col("gap") + size).over(so_far).cast("int")).withColumn("start", F.col("stop") - size)
    kinds = F.map_from_entries(F.array(*(F.struct(F.lit(n), F.array(*(F.lit(k) for k in ks))) for n, ks in [*((k, (k,)) for k in KINDS), *((n, ks) for n, (ks, _) in GENERATORS.items())])))
    long = long.select("row", "generator", "start", "stop", "match", "before", "after", F.explode(kinds[F.col("generator")]).alias("kind"))
    digits = F.regexp_replace("match", "[^0-9]", "")
    long = long.withColumn("digits", F.char_length(digits)).withColumn("valid", _valid(F.col("kind"), F.col("match"), digits)).withColumn("base", (F.col("generator") == F.col("kind")) & F.col("valid"))
    ordered = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind")).cast("int")
    enough = F.col("base") | F.col("kind").isin("email", "ip") | (F.col("digits") >= LEAST_DIGITS)
    return long.where(enough).withColumn("place", ordered).drop("generator")


def _one(condition: Column) -> Column:
    return F.coalesce(condition.cast("double"), F.lit(0.0))


def featured(long: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of each span as numbers, and their names."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    count = lambda pattern: (F.char_length(match) - F.char_length(F.regexp_replace(match, pattern, ""))).cast("double")
    runs = F.array_remove(F.split(match, "[^0-9]+"), "")
    cue = F.lit(0.0)
    for k, words in CUES.items():
        cue = F.when(F.col("kind") == k, _one(before.rlike(rf"(?i)(?<!\pL)(?:{words})(?!\pL)"))).otherwise(cue)
    made = {f"is_{k}": _one(F.col("kind") == k) for k in KINDS} | {
        "length": F.char_length(match).cast("double"), "n_digits": F.col("digits").cast("double"), "letters": count(r"\pL"), "spaces": count(r"\s"), "dots": count(r"\."), "hyphens": count("-"), "colons": count(":"), "brackets": count(r"[()]"),
        "runs": F.size(runs).cast("double"), "longest": F.coalesce(F.array_max(F.transform(runs, F.char_length)), F.lit(0)).cast("double"), "distinct": F.size(F.array_distinct(F.split(F.regexp_replace(match, "[^0-9]", ""), ""))).cast("double"),
        "domain": _one(match.rlike(r"[\pL0-9-]+(?:\.[\pL0-9-]+)*\.\pL{2,24}$")), "sound": _one(F.col("valid")), "ends_well": _one(match.rlike(r"[\pL0-9]$")), "cue": cue,
        "after_letter": _one(before.rlike(r"[\pL_]$")), "after_digit": _one(before.rlike(r"[0-9][\s().+-]{0,3}$")), "after_mark": _one(before.rlike(r"[=\"'/#$%&*:@]\s?$")), "after_plus": _one(before.rlike(r"\+$")),
        "to_letter": _one(after.rlike(r"^[\pL_]")), "to_digit": _one(after.rlike(r"^[\s().-]{0,3}[0-9]")), "to_mark": _one(after.rlike(r"^[=\"'/@%]")),
    }
    return long.withColumns(made), list(made)


def with_base(long: DataFrame) -> DataFrame:
    """Proposals with `agrees` (half of it and a base span of its kind is common to both) and `touches` (it overlaps a base
    span of any kind). A proposal is held against the base spans that start last before it and first after it."""
    of_row, of_kind = Window.partitionBy("row").orderBy("start"), Window.partitionBy("row", "kind").orderBy("start")
    up_to, beyond = lambda w: w.rangeBetween(Window.unboundedPreceding, 0), lambda w: w.rangeBetween(1, Window.unboundedFollowing)
    own = F.when(F.col("base"), F.struct("start", "stop"))
    marked = long.withColumn("last", F.max(own).over(up_to(of_kind))).withColumn("next", F.min(own).over(beyond(of_kind)))
    marked = marked.withColumn("reached", F.max(F.when(F.col("base"), F.col("stop"))).over(up_to(of_row))).withColumn("upcoming", F.min(F.when(F.col("base"), F.col("start"))).over(beyond(of_row)))
    common = lambda s: F.greatest(F.lit(0), F.least("stop", s["stop"]) - F.greatest("start", s["start"]))
    agrees = lambda s: s.isNotNull() & (2 * common(s) >= F.greatest("stop", s["stop"]) - F.least("start", s["start"]))
    touches = F.coalesce(F.col("reached") > F.col("start"), F.lit(False)) | F.coalesce(F.col("upcoming") < F.col("stop"), F.lit(False))
    found = marked.where(~F.col("base")).withColumn("agrees", (agrees(F.col("last")) | agrees(F.col("next"))).cast("double")).withColumn("touches", touches)
    return found.drop("last", "next", "reached", "upcoming", "base")


def _half() -> Column:
    """Which half of the documents a candidate stands in."""
    return F.pmod(F.xxhash64("row", F.lit("side")), F.lit(2)) == 0


@dataclass
class Model:
    trees: tuple[GBTClassificationModel, GBTClassificationModel]
    features: list[str]
    thresholds: dict[str, float]

    def scored(self, candidates: DataFrame) -> DataFrame:
        """candidates with `score`, the chance that a proposal is right, by the trees that learned from the other half."""
        def half(own: Column, trees: GBTClassificationModel) -> DataFrame:
            ready = VectorAssembler(inputCols=self.features, outputCol="features").transform(candidates.where(own))
            return trees.transform(ready).withColumn("score", vector_to_array("probability")[1]).drop("features", "probability", "rawPrediction", "prediction")

        return half(_half(), self.trees[1]).unionByName(half(~_half(), self.trees[0]))


def model_of(candidates: DataFrame, features: list[str]) -> Model | None:
    """Trees and thresholds from all candidates (materialised); nothing where one of the classes is missing in a half.

    Each half of the documents teaches trees that score the other half, so that every candidate teaches and is scored by
    trees that haven't seen its document; thresholds come from the scores of all. A kind whose proposals are never right
    often enough gets no threshold, so that none is added.
    """
    trees = []
    for own in (_half(), ~_half()):
        rows = candidates.where(own)
        if rows.select("agrees").distinct().count() < 2:
            return None
        ready = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
        trees.append(GBTClassifier(featuresCol="features", labelCol="agrees", maxIter=ROUNDS, maxDepth=DEPTH, seed=7, stepSize=0.3, cacheNodeIds=False).fit(ready.select("features", "agrees")))
    model = Model(tuple(trees), features, {})
    binned = model.scored(candidates).groupBy("kind", F.floor(F.col("score") * BINS).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.sum("agrees").alias("right"))
    for kind in KINDS:
        n = right = 0
        for r in sorted((r for r in binned.where(F.col("kind") == kind).collect()), key=lambda r: -r.bin):
            n, right = n + r.n, right + r.right
            if n >= LEAST_ROWS and right >= PRECISION * n:
                model.thresholds[kind] = r.bin / BINS
    return model


def added(candidates: DataFrame, model: Model) -> DataFrame:
    """The proposals that the thresholds select: free of base spans, the best of each chain of overlapping ones."""
    if not model.thresholds:
        return candidates.limit(0)
    passes = F.lit(False)
    for kind, least in model.thresholds.items():
        passes = passes | ((F.col("kind") == kind) & (F.col("score") >= least))
    chosen = model.scored(candidates.where(~F.col("touches"))).where(passes)
    order = Window.partitionBy("row").orderBy("start", "stop", "place")
    chosen = chosen.withColumn("reach", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    chosen = chosen.withColumn("chain", F.sum(F.coalesce(F.col("start") >= F.col("reach"), F.lit(True)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = Window.partitionBy("row", "chain").orderBy(F.desc("score"), F.desc(F.col("stop") - F.col("start")), "start", "place")
    return chosen.withColumn("nth", F.row_number().over(best)).where("nth = 1")


SPAN = "array<struct<start:int,place:int,stop:int,kind:string,base:boolean>>"


def detected(docs: DataFrame, text: str = "text", name: str = "private") -> DataFrame:
    """docs without `text` and with a column `name`: all spans in order of start and kind, each with whether it is a base
    span.

    Null and empty texts have no spans; a text of any length is searched whole; repeated rows, null ids and other columns
    stay as they are. No rows give no rows, and tables that don't teach both classes get base spans only.
    """
    found = searched(docs, text)
    row, matches = found.columns[-2:]
    long = saved(spans(found, row, matches), "private-spans")
    featured_, features = featured(with_base(long))
    candidates = saved(featured_.select("row", "start", "stop", "kind", "place", "agrees", "touches", *features), "private-candidates")
    model = model_of(candidates, features)
    every = long.where("base").select("row", "start", "place", "stop", "kind", F.lit(True).alias("base"))
    if model is not None:
        every = every.union(added(candidates, model).select("row", "start", "place", "stop", "kind", F.lit(False).alias("base")))
    name = free_name(found.columns, name)
    lists = every.groupBy(F.col("row").alias(free_name(found.columns, "of"))).agg(F.array_sort(F.collect_list(F.struct("start", "place", "stop", "kind", "base"))).alias(name))
    with_matches = found.where(F.size(matches) > 0).drop(matches).join(lists, F.col(row) == F.col(lists.columns[0]), "left").drop(row, lists.columns[0])
    rest = found.where(F.size(matches) == 0).drop(row, matches).withColumn(name, F.lit(None).cast(SPAN))
    none = F.expr(f"cast(array() as {SPAN})")
    return with_matches.unionByName(rest).withColumn(name, F.coalesce(name, none))


def redacted(text: Column, spans_: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in square brackets."""
    step = lambda s, x: F.struct(F.when(x["start"] >= s["to"], F.concat(s["out"], F.substring(text, s["to"] + 1, x["start"] - s["to"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(s["out"]).alias("out"), F.greatest(s["to"], x["stop"]).alias("to"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("to"))
    return F.aggregate(spans_, start, step, lambda s: F.concat(s["out"], F.substring(text, s["to"] + 1, F.char_length(text))))


def written(spans_: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a digest of every document's base spans, and all its spans."""
    found = detected(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("private", lambda x: x["base"])
    of_kind = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(of_kind, KINDS), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("private")).alias("spans"))
