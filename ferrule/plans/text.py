"""Names, titles, vocabularies, dates and HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.functions import columns as C
from ferrule.operators.resolver import similar_names
from ferrule.plans.base import query

FORMS = ("Inc.", "GmbH", "Co., Ltd", "Games LLC", "Studios", "Publishing", "(Asia) Interactive Pty Ltd", "S.A.")
CASES = " ".join(f"WHEN {i} THEN ' {f}'" for i, f in enumerate(FORMS))
NAMED = f"n AS (SELECT s_suppkey AS id, 'The ' || s_name || CASE s_suppkey % {len(FORMS)} {CASES} END AS name FROM supplier)"
WORDS = """trim(regexp_replace(regexp_replace(replace(lower({0}), '&', ' and '), '[''’`]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"""
LEGAL = "|".join(sorted(C.LEGAL_FORMS, key=len, reverse=True))
TRAIL = "|".join(sorted(C.TRAILING_WORDS, key=len, reverse=True))
COMPANY = f"regexp_replace({WORDS}, '( (?:{LEGAL}))+$', '')"
SLUG = "regexp_replace(substr(replace(" + WORDS + ", ' ', '-'), 1, 80), '-+$', '')"


def named(t):
    form = F.lit("")
    k = F.col("s_suppkey") % len(FORMS)
    form = F.coalesce(*(F.when(k == i, F.lit(f" {f}")) for i, f in enumerate(FORMS)))
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("The "), F.col("s_name"), form).alias("name"))


@query("normalize_company", f"WITH {NAMED} SELECT id, {COMPANY.format('name')} AS name FROM n")
def normalize_company(t):
    return named(t).select("id", C.company_name(F.col("name")).alias("name"))


_BARE = f"regexp_replace({WORDS.format(chr(0))}, '( (?:{LEGAL}))+$', '')".replace(chr(0), "regexp_replace(name, '\\s*\\([^)]*\\)', ' ', 'g')")


@query("loose_company", f"WITH {NAMED} SELECT id, regexp_replace(regexp_replace({_BARE}, '( (?:{TRAIL}))+$', ''), '^(?:{TRAIL})$', '') AS name FROM n")
def loose_company(t):
    return named(t).select("id", C.loose_company_name(F.col("name")).alias("name"))


GENERIC = ", ".join(f"'{w}'" for w in C.GENERIC_WORDS)


@query("core_company", f"WITH {NAMED} SELECT id, array_to_string(list_filter(string_split({COMPANY.format('name')}, ' '), lambda w: w NOT IN ('', {GENERIC})), ' ') AS name FROM n")
def core_company(t):
    return named(t).select("id", C.core_company_name(F.col("name")).alias("name"))


@query("normalize_technology", f"""WITH x AS (SELECT p_partkey AS id, p_brand || CASE p_partkey % 3 WHEN 0 THEN '#' WHEN 1 THEN '++' ELSE '' END AS name FROM part) SELECT id, {WORDS.format("replace(replace(name, '#', ' sharp '), '+', ' plus ')")} AS name FROM x""")
def normalize_technology(t):
    k = F.col("p_partkey") % 3
    name = F.concat("p_brand", F.when(k == 0, "#").when(k == 1, "++").otherwise(""))
    return t.part.select(F.col("p_partkey").alias("id"), C.technology_name(name).alias("name"))


@query(
    "normalize_title",
    f"""WITH x AS (SELECT p_partkey AS id, 'The ' || p_name || CASE p_partkey % 2 WHEN 0 THEN '™ of an Age' ELSE ' & a Half' END AS title FROM part)
    SELECT id, trim(regexp_replace(regexp_replace({WORDS.format("regexp_replace(title, '[™®©]', '', 'g')")}, '\\b(the|a|an)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM x""",
)
def normalize_title(t):
    title = F.concat(F.lit("The "), "p_name", F.when(F.col("p_partkey") % 2 == 0, "™ of an Age").otherwise(" & a Half"))
    return t.part.select(F.col("p_partkey").alias("id"), C.title_name(title).alias("title"))


@query("slugify", f"SELECT p_partkey AS id, {SLUG.format(chr(34) + 'label' + chr(34))} AS slug FROM (SELECT p_partkey, p_name || ' & ' || p_type || '''s #' || p_partkey AS label FROM part)")
def slugify(t):
    label = F.concat("p_name", F.lit(" & "), "p_type", F.lit("'s #"), F.col("p_partkey").cast("string"))
    return t.part.select(F.col("p_partkey").alias("id"), C.slug(label).alias("slug"))


@query("unicode_slugs", f"SELECT doc_id, CASE WHEN s = '' THEN 'untitled' ELSE s END AS slug FROM (SELECT doc_id, {SLUG.format("strip_accents(coalesce(text, ''))")} AS s FROM documents)")
def unicode_slugs(t):
    return t.documents.select("doc_id", C.slug(F.coalesce("text", F.lit("")), unicode=True).alias("slug"))


_GENRE = {"STANDARD": "Role-Playing (RPG)", "SMALL": "Platform Game", "MEDIUM": "Indie", "LARGE": "Hack and slash/Beat 'em up", "ECONOMY": "Early Access"}
_PLATFORM = {"click": "PC", "view": "Mac OS X", "purchase": "PlayStation 5", "signup": "Xbox Series X|S", "login": "Steam Deck"}


def _cases(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join("WHEN '{}' THEN '{}'".format(k, v.replace("'", "''")) for k, v in values.items()) + f" ELSE {column} END"


def _lookup(key: str, values: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


_KEY = "trim(regexp_replace(regexp_replace(lower(name), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_PKEY = "trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'))"


@query(
    "vocab_normalize",
    f"""WITH p AS (SELECT DISTINCT 'platform' AS kind, {_cases('event_type', _PLATFORM)} AS name FROM events),
    g AS (SELECT DISTINCT 'genre' AS kind, {_cases('p_type', _GENRE)} AS name FROM part)
    SELECT kind, name, coalesce({_lookup(_PKEY, C.PLATFORMS)}, {SLUG.format('name')}) AS id FROM p
    UNION ALL SELECT kind, name, coalesce({_lookup(_KEY, C.GENRES)}, {SLUG.format('name')}) AS id FROM g""",
)
def vocab_normalize(t):
    p = t.events.select(F.lit("platform").alias("kind"), F.coalesce(C.map_literal(_PLATFORM)[F.col("event_type")], "event_type").alias("name")).distinct()
    g = t.part.select(F.lit("genre").alias("kind"), F.coalesce(C.map_literal(_GENRE)[F.col("p_type")], "p_type").alias("name")).distinct()
    return p.withColumn("id", C.platform(F.col("name"))).unionByName(g.withColumn("id", C.genre(F.col("name"))))


@query("genre_cleanup", f"WITH g AS (SELECT p_partkey AS id, {_cases('p_type', _GENRE)} AS name FROM part) SELECT id, genre FROM (SELECT id, coalesce({_lookup(_KEY, C.GENRES)}, {SLUG.format('name')}) AS genre FROM g) WHERE genre NOT IN ('early-access', 'free-to-play', 'indie', 'massively-multiplayer')")
def genre_cleanup(t):
    name = F.coalesce(C.map_literal(_GENRE)[F.col("p_type")], "p_type")
    return t.part.select(F.col("p_partkey").alias("id"), C.genre(name).alias("genre")).where(~F.col("genre").isin(*C.NON_GAMEPLAY))


@query("alias_cleanup", "SELECT p_partkey AS id, a AS alias FROM (SELECT p_partkey, p_name, unnest([p_name, p_brand, repeat(p_name, 1 + (p_partkey % 12)::INT)]) AS a FROM part) WHERE length(a) <= 120 AND a <> p_name")
def alias_cleanup(t):
    aliases = F.array("p_name", "p_brand", F.repeat("p_name", (1 + F.col("p_partkey") % 12).cast("int")))
    kept = F.filter(aliases, lambda a: (F.length(a) <= 120) & (a != F.col("p_name")))
    return t.part.select(F.col("p_partkey").alias("id"), F.explode(kept).alias("alias"))


STORE = """x AS (SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%b %-d, %Y') WHEN 1 THEN strftime(o_orderdate, '%-d %b, %Y') WHEN 2 THEN strftime(o_orderdate, '%B %Y')
  WHEN 3 THEN 'Q2 ' || strftime(o_orderdate, '%Y') WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00') WHEN 5 THEN strftime(o_orderdate, '%Y') ELSE 'Coming soon' END AS s, o_orderdate AS d FROM orders)"""


@query(
    "parse_store_date",
    f"""WITH {STORE} SELECT id, CASE WHEN id % 7 IN (0, 1, 4) THEN strftime(d, '%Y-%m-%d') WHEN id % 7 = 2 THEN strftime(d, '%Y-%m') WHEN id % 7 IN (3, 5) THEN strftime(d, '%Y') END AS date,
    CASE WHEN id % 7 IN (0, 1, 4) THEN 'day' WHEN id % 7 = 2 THEN 'month' WHEN id % 7 IN (3, 5) THEN 'year' END AS precision FROM x""",
)
def parse_store_date(t):
    k, d = F.col("o_orderkey") % 7, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "MMM d, yyyy")).when(k == 1, F.date_format(d, "d MMM, yyyy")).when(k == 2, F.date_format(d, "MMMM yyyy")).when(k == 3, F.concat(F.lit("Q2 "), F.date_format(d, "yyyy")))
    text = text.when(k == 4, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00"))).when(k == 5, F.date_format(d, "yyyy")).otherwise("Coming soon")
    found = C.store_date(text)
    return t.orders.select(F.col("o_orderkey").alias("id"), found["date"].alias("date"), found["precision"].alias("precision"))


PART_DATES = "d AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y') END AS date FROM orders)"


def part_dates(t):
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    return t.orders.select(F.col("o_orderkey").alias("id"), F.date_format(d, "yyyy-MM-dd").alias("day"), F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyy")).alias("date"))


@query("finer_date", f"WITH {PART_DATES} SELECT id, CASE WHEN length(date) >= 10 THEN date WHEN id % 2 = 0 THEN day WHEN length(date) < 7 THEN substr(day, 1, 7) ELSE date END AS date FROM d")
def finer_date(t):
    others = F.array(F.lit("1900-01-01"), F.when(F.col("id") % 2 == 0, F.col("day")).otherwise(F.substring("day", 1, 7)))
    return part_dates(t).select("id", C.refined_date(F.col("date"), others).alias("date"))


@query("release_status", f"WITH {PART_DATES} SELECT id, CASE WHEN date <= substr('1998-06-15', 1, length(date)) THEN 'released' ELSE 'upcoming' END AS status FROM d")
def release_status(t):
    return part_dates(t).select("id", C.release_status(F.col("date"), "1998-06-15").alias("status"))


@query(
    "date_scalars",
    f"""WITH {PART_DATES} SELECT id, CASE length(date) WHEN 10 THEN 'day' WHEN 7 THEN 'month' ELSE 'year' END AS precision, substr(date, 1, 4) AS year,
    floor(greatest(0.0, (TIMESTAMP '2001-06-01 12:00:00' - (date || CASE length(date) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END)::TIMESTAMP) / INTERVAL 1 SECOND / 86400.0) * 100.0 + 0.5) / 100.0 AS age,
    strftime(make_timestamp(id * 86400 * 1000000), '%Y-%m-%d') AS from_unix, (day::DATE - DATE '1970-01-01')::INT AS day_number FROM d""".replace("(TIMESTAMP '2001-06-01 12:00:00' - ", "(epoch(TIMESTAMP '2001-06-01 12:00:00') - epoch(").replace("::TIMESTAMP) / INTERVAL 1 SECOND", "::TIMESTAMP))"),
)
def date_scalars(t):
    age = C.rounded(C.days_since(F.col("date"), F.lit("2001-06-01 12:00:00").cast("timestamp_ntz")), 2)
    return part_dates(t).select(
        "id", C.precision_of(F.col("date")).alias("precision"), F.substring("date", 1, 4).alias("year"), age.alias("age"),
        C.day_text(F.timestamp_seconds(F.col("id") * 86400)).alias("from_unix"), F.unix_date(F.to_date("day")).alias("day_number"),
    )


@query(
    "decode_html",
    r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(replace(regexp_replace(regexp_replace(title, '(?i)<br\s*/?>', ' ', 'g'), '<[^>]+>', '', 'g'), '&quot;', '"'), '&#39;|&apos;', '''', 'g'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')) AS title
    FROM (SELECT page_id, html AS title FROM pages)""",
)
def decode_html(t):
    return t.pages.select("page_id", C.html_text(F.col("html")).alias("title"))


@query("parse_languages", "SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'English|French' WHEN 1 THEN 'German|Spanish - Spain|English' ELSE 'Japanese' END AS languages FROM customer")
def parse_languages(t):
    k = F.col("c_custkey") % 3
    raw = F.when(k == 0, "English<strong>*</strong>, French<br><strong>*</strong>languages with audio").when(k == 1, "German, Spanish - Spain*,  English, German").otherwise("Japanese<BR/>x, y")
    return t.customer.select(F.col("c_custkey").alias("id"), F.array_join(C.languages(raw), "|").alias("languages"))


@query(
    "token_similarity_pairs",
    r"""WITH p AS (SELECT DISTINCT p_type, p_name FROM part) SELECT a.p_type AS type, a.p_name AS a, b.p_name AS b,
    floor(len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' ')))::DOUBLE / len(list_distinct(list_concat(string_split(a.p_name, ' '), string_split(b.p_name, ' ')))) * 10000.0 + 0.5) / 10000.0 AS score
    FROM p AS a JOIN p AS b ON a.p_type = b.p_type AND a.p_name < b.p_name AND len(list_intersect(string_split(a.p_name, ' '), string_split(b.p_name, ' '))) > 0""",
)
def token_similarity_pairs(t):
    # blocked by shared words instead of comparing all names of a type
    p = t.part.select("p_type", "p_name").distinct().withColumn("word", F.explode(F.array_distinct(F.split("p_name", " "))))
    a, b = p.select("p_type", F.col("p_name").alias("a"), "word"), p.select("p_type", F.col("p_name").alias("b"), "word")
    pairs = a.join(b, ["p_type", "word"]).where("a < b").select(F.col("p_type").alias("type"), "a", "b").distinct()
    return pairs.withColumn("score", C.rounded(C.token_similarity(F.col("a"), F.col("b")), 4))


@query("jaro_winkler_pairs")
def jaro_winkler_pairs(t):
    """All pairs of part names at least 0.85 alike; names that differ early are compared like any other."""
    return similar_names(t.part.select("p_name").distinct(), "p_name", 0.85)


@query("label_titles", "SELECT DISTINCT event_type || '-of_the 2d' AS id, upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' of the 2D' AS label FROM events")
def label_titles(t):
    value = F.concat("event_type", F.lit("-of_the 2d"))
    return t.events.select(value.alias("id"), C.labelized(value).alias("label")).distinct()


@query(
    "url_hosts",
    r"""SELECT page_id, regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '^www\.', '') AS host, string_split(url, '?')[1] AS stable, regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1) AS segment FROM pages""",
)
def url_hosts(t):
    return t.pages.select("page_id", F.regexp_replace(F.parse_url(F.col("url"), F.lit("HOST")), r"^www\.", "").alias("host"), F.substring_index("url", "?", 1).alias("stable"), F.split(F.parse_url(F.col("url"), F.lit("PATH")), "/")[1].alias("segment"))


@query("js_rounding", "SELECT l_orderkey, l_linenumber, floor(l_extendedprice / l_quantity * 10.0 + 0.5) / 10.0 AS one, floor(l_discount * 100 * 1.0 + 0.5) / 1.0 AS whole FROM lineitem")
def js_rounding(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", C.rounded(F.col("l_extendedprice") / F.col("l_quantity"), 1).alias("one"), C.rounded(F.col("l_discount") * 100).alias("whole"))
