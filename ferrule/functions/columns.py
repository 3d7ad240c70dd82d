"""Column helpers: rounding, partial dates, names, vocabularies, HTML, search scores."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------------------------------
#: Legal forms that never tell two companies apart.
LEGAL_FORMS = (
    "incorporated", "inc", "llc", "l l c", "ltd", "limited", "pty", "pty ltd", "plc", "corp", "corporation", "co",
    "company", "gmbh", "ug", "ag", "ab", "publ", "oy", "oyj", "as", "a s", "aps", "bv", "b v", "nv", "sa", "s a",
    "sas", "sarl", "srl", "spa", "kk", "k k", "co ltd", "sp z o o", "s r o", "sro",
)
#: Trailing words that make no second company.
TRAILING_WORDS = (
    "games", "game", "studios", "studio", "entertainment", "interactive", "software", "productions", "production",
    "media", "labs", "works", "digital", "vr",
)
#: Words that the core of a name leaves out.
GENERIC_WORDS = (
    "the", "games", "game", "studio", "studios", "entertainment", "interactive", "digital", "software", "productions",
    "production", "media", "labs", "team", "publishing", "works",
)
#: Platform spellings.
PLATFORMS = {
    "microsoft windows": "windows", "pc": "windows", "pc microsoft windows": "windows", "win": "windows",
    "mac": "macos", "mac os": "macos", "mac os x": "macos", "os x": "macos", "classic mac os": "macos",
    "linux": "linux", "switch": "nintendo-switch", "nintendo switch": "nintendo-switch",
    "nintendo switch 2": "nintendo-switch-2", "wii u": "wii-u", "nintendo 3ds": "nintendo-3ds",
    "new nintendo 3ds": "nintendo-3ds", "playstation 3": "playstation-3", "playstation 4": "playstation-4",
    "playstation 5": "playstation-5", "playstation vita": "playstation-vita", "ps3": "playstation-3",
    "ps4": "playstation-4", "ps5": "playstation-5", "xbox 360": "xbox-360", "xbox one": "xbox-one",
    "xbox series x s": "xbox-series", "xbox series x and series s": "xbox-series", "xbox series x": "xbox-series",
    "xbox series": "xbox-series", "ios": "ios", "apple ios": "ios", "ipados": "ios", "android": "android",
    "web browser": "web", "browser": "web", "html5": "web", "google stadia": "stadia", "stadia": "stadia",
    "meta quest": "meta-quest", "oculus quest": "meta-quest", "meta quest 2": "meta-quest",
    "meta quest 3": "meta-quest", "steamos": "linux",
}
#: Genre spellings.
GENRES = {
    "role playing rpg": "rpg", "role playing game": "rpg", "role playing video game": "rpg", "role playing": "rpg",
    "rpg": "rpg", "action role playing game": "action-rpg", "action rpg": "action-rpg",
    "hack and slash beat em up": "hack-and-slash", "platform game": "platformer", "platform": "platformer",
    "platformer": "platformer", "metroidvania": "metroidvania", "roguelike": "roguelike",
    "roguelike video game": "roguelike", "roguelite": "roguelite", "real time strategy rts": "real-time-strategy",
    "real time strategy": "real-time-strategy", "turn based strategy tbs": "turn-based-strategy",
    "turn based strategy": "turn-based-strategy", "shooter": "shooter", "first person shooter": "first-person-shooter",
    "point and click": "point-and-click", "adventure game": "adventure", "action game": "action",
    "action adventure game": "action-adventure", "puzzle video game": "puzzle",
    "simulation video game": "simulation", "strategy video game": "strategy", "survival game": "survival",
    "sandbox game": "sandbox", "massively multiplayer": "mmo", "free to play": "free-to-play",
    "early access": "early-access", "indie game": "indie", "indie": "indie", "deck building game": "deckbuilder",
    "deck building": "deckbuilder", "card battle": "card-game", "card and board game": "card-game",
}
#: Labels that are about business, not play.
NON_GAMEPLAY = ("early-access", "free-to-play", "indie", "massively-multiplayer")
#: Words that a title keeps small.
SMALL_WORDS = ("a", "an", "and", "of", "the", "for", "in", "on", "to")
#: Layouts of store dates (month day year, day month year, month year, year with or without a quarter, ISO).
DATE_MDY = r"^([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4})$"
DATE_DMY = r"^(\d{1,2}) ([A-Za-z]{3,9})\.?,? (\d{4})$"
DATE_MY = r"^([A-Za-z]{3,9}),? (\d{4})$"
DATE_Y = r"^(?:Q[1-4] )?(\d{4})$"
DATE_ISO = r"^(\d{4})-(\d{2})-(\d{2})"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


# --- numbers ------------------------------------------------------------------------------------------------------
def rounded(value: Column, digits: int = 0) -> Column:
    """Half towards positive infinity on the binary product, as browsers round."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


# --- values -------------------------------------------------------------------------------------------------------
def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def map_literal(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


# --- text ---------------------------------------------------------------------------------------------------------
@functools.cache
def decompositions() -> tuple[str, str, str, dict[str, str]]:
    """From Python's tables, once: characters whose decomposition is one character, those characters, the marks that go, and
    the decompositions of several; Hangul syllables are left to arithmetic."""
    one, several, gone = {}, {}, []
    for c in map(chr, (*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x110000))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not "\u0300" <= x <= "\u036f")
        if not plain:
            gone.append(c)
        elif len(plain) > 1:
            several[c] = plain
        elif plain != c:
            one[c] = plain
    return "".join(one), "".join(one.values()), "".join(gone), several


def folded(text: Column) -> Column:
    """Compatibility decomposition without the marks U+0300 to U+036F, in the JVM: one translation; only texts that have
    Hangul or characters that become several are gone through character by character. Marks that stay keep their order."""
    one, plain, gone, several = decompositions()
    keys = "".join(several)
    values = F.split(F.lit("\x00".join(several.values())), "\x00")  # constants, folded once
    known = lambda c: F.get(values, F.instr(F.lit(keys), c) - 1)
    at = lambda c: F.ascii(c) - 0xAC00
    # a syllable's parts follow from its number: 19 leading consonants, 21 vowels, 27 tails or none
    parts = [F.lit("".join(map(chr, range(first, first + n)))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))]
    pick = lambda k, n: F.substring(parts[k], n.cast("int"), F.lit(1))
    hangul = lambda c: F.concat(pick(0, at(c) / 588 + 1), pick(1, at(c) % 588 / 28 + 1), F.when(at(c) % 28 > 0, pick(2, at(c) % 28)).otherwise(""))
    each = lambda c: F.when(c <= "\x7f", c).when(c.between("\uac00", "\ud7a3"), hangul(c)).otherwise(F.coalesce(known(c), c))
    some = text.rlike("[\uac00-\ud7a3]") | (F.char_length(F.translate(text, keys, "")) < F.char_length(text))
    whole = F.when(some, F.array_join(F.transform(F.split(text, ""), each), "")).otherwise(text)
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(whole, one + gone, plain)).otherwise(text)


def canonical_json(text: Column) -> Column:
    """JSON of any shape without blanks, keys in order at every depth, numbers without trailing zeros; null for what isn't
    JSON. Numbers with an exponent are written as doubles."""
    return F.to_json(F.try_parse_json(text))


def natural_key(text: Column) -> Column:
    """Orders names as people do: runs of text by the Unicode collation, runs of digits by their value, however long."""
    digits = lambda r: r.rlike("^[0-9]")
    value = lambda r: F.regexp_replace(r, "^0+(?=[0-9])", "")
    run = lambda r: F.struct(F.collate(F.when(digits(r), "0").otherwise(r), "UNICODE").alias("text"), F.when(digits(r), F.length(value(r))).otherwise(0).alias("size"), F.when(digits(r), value(r)).otherwise("").alias("digits"))
    return F.transform(F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), run)


def words_only(text: Column, unicode: bool = False) -> Column:
    """Lower case, & as "and", no apostrophes, everything else that is no letter or digit a single space."""
    text = F.lower(folded(text) if unicode else text)
    text = F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" and ")), "['’`]", "")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def slug(text: Column, unicode: bool = False) -> Column:
    text = F.regexp_replace(F.substring(F.replace(words_only(text, unicode), F.lit(" "), F.lit("-")), 1, 80), "-+$", "")
    return F.regexp_replace(text, "^$", "untitled")  # the text is made once


def _alternatives(words: tuple[str, ...]) -> str:
    return "|".join(sorted(words, key=len, reverse=True))


def company_name(name: Column, unicode: bool = False) -> Column:
    """Without legal forms at the end, however many; never the whole name."""
    return F.regexp_replace(words_only(name, unicode), f"( (?:{_alternatives(LEGAL_FORMS)}))+$", "")


def loose_company_name(name: Column, unicode: bool = False) -> Column:
    """Also without asides in brackets and trailing words; empty where nothing else remains."""
    bare = company_name(F.regexp_replace(name, r"\s*\([^)]*\)", " "), unicode)
    some = _alternatives(TRAILING_WORDS)
    return F.regexp_replace(F.regexp_replace(bare, f"( (?:{some}))+$", ""), f"^(?:{some})$", "")


def core_company_name(name: Column, unicode: bool = False) -> Column:
    words = F.split(company_name(name, unicode), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin("", *GENERIC_WORDS)), " ")


def technology_name(name: Column) -> Column:
    return words_only(F.replace(F.replace(name, F.lit("#"), F.lit(" sharp ")), F.lit("+"), F.lit(" plus ")))


def title_name(title: Column, unicode: bool = False) -> Column:
    """Without trade marks and articles."""
    bare = words_only(F.regexp_replace(title, "[™®©]", ""), unicode)
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"\b(the|a|an)\b", " "), r"\s+", " "))


def platform(name: Column) -> Column:
    key = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))
    return F.coalesce(map_literal(PLATFORMS)[key], slug(name))


def genre(name: Column) -> Column:
    key = F.trim(F.regexp_replace(F.regexp_replace(F.lower(name), "['’]", ""), "[^a-z0-9]+", " "))
    return F.coalesce(map_literal(GENRES)[key], slug(name))


def token_similarity(a: Column, b: Column) -> Column:
    """Jaccard over words; 0 where one has none."""
    x, y = (F.filter(F.array_distinct(F.split(c, " ")), lambda w: w != "") for c in (a, b))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(0.0)


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = dict(enumerate(b))
    left = []
    for i, c in enumerate(a):
        hit = next((j for j in range(max(0, i - reach), min(i + reach + 1, len(b))) if free.get(j) == c), None)
        if hit is not None:
            del free[hit]
            left.append(c)
    if not left:
        return 0.0
    right = [c for j, c in enumerate(b) if j not in free]
    m = len(left)
    moved = sum(x != y for x, y in zip(left, right, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler without a threshold for the common beginning; transpositions count by halves."""
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def similarity(a: Column, b: Column) -> Column:
    return F.greatest(jaro_winkler(a, b), token_similarity(a, b))


def html_text(html: Column) -> Column:
    """Breaks as blanks, no tags, entities resolved in a fixed order, blanks collapsed; numeric references too."""
    text = F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>", " "), "<[^>]+>", "")
    text = F.replace(text, F.lit("&quot;"), F.lit('"'))
    text = F.regexp_replace(text, "&#39;|&apos;", "'")
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    references = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#(\d+);"), F.lit(1)))
    text = F.aggregate(references, text, lambda done, n: F.replace(done, F.concat(F.lit("&#"), n, F.lit(";")), F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")))
    return F.trim(F.regexp_replace(F.replace(text, F.lit("&amp;"), F.lit("&")), r"(?U)\s+", " "))


def languages(text: Column) -> Column:
    """Listed languages before the first break, without stars, in order, each once."""
    listed = F.split(html_text(F.element_at(F.split(text, r"(?i)<br\s*/?>"), 1)), ",")
    return F.array_distinct(F.filter(F.transform(listed, lambda x: F.trim(F.replace(x, F.lit("*"), F.lit("")))), lambda x: x != ""))


def labelized(value: Column) -> Column:
    words = F.filter(F.split(value, r"[-_\s]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*SMALL_WORDS), w).when(w == "2d", "2D").when(w == "3d", "3D").otherwise(F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w))))), " ")


def search_score(label: Column, aliases: Column, query: str) -> Column:
    """100 equal, 80 beginning, 60 word beginning, 40 part of the label; else 70, 50 or 25 for the first alias that matches; else 0."""
    q = F.lit(query)
    name = words_only(label)
    of_alias = F.filter(F.transform(aliases, lambda a: F.when(words_only(a) == q, 70).when(F.startswith(words_only(a), q), 50).when(F.contains(words_only(a), q), 25).otherwise(0)), lambda s: s > 0)
    ladder = F.when(name == q, 100).when(F.startswith(name, q), 80).when(F.contains(name, F.lit(f" {query}")), 60).when(F.contains(name, q), 40)
    return ladder.otherwise(F.coalesce(F.get(of_alias, 0), F.lit(0)))


# --- partial dates ------------------------------------------------------------------------------------------------
def store_date(text: Column) -> Column:
    """Struct (date, precision) of the layouts that stores use; null for anything else. No calendar is consulted."""
    s = F.trim(F.regexp_replace(text, r"\s+", " "))

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(s, pattern, i)

    def month(name: Column) -> Column:
        at = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.lower(F.substring(name, 1, 3)))
        return F.when(at > 0, F.lpad(at.cast("string"), 2, "0"))

    def made(date: Column, precision: str) -> Column:
        return F.when(date.isNotNull(), F.struct(date.alias("date"), F.lit(precision).alias("precision")))

    mdy, dmy, my, y, iso = DATE_MDY, DATE_DMY, DATE_MY, DATE_Y, DATE_ISO
    return (
        F.when(s.rlike(mdy), made(F.concat(part(mdy, 3), F.lit("-"), month(part(mdy, 1)), F.lit("-"), F.lpad(part(mdy, 2), 2, "0")), "day"))
        .when(s.rlike(dmy), made(F.concat(part(dmy, 3), F.lit("-"), month(part(dmy, 2)), F.lit("-"), F.lpad(part(dmy, 1), 2, "0")), "day"))
        .when(s.rlike(my), made(F.concat(part(my, 2), F.lit("-"), month(part(my, 1))), "month"))
        .when(s.rlike(y), made(part(y, 1), "year"))
        .when(s.rlike(iso), made(F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})", 1), "day"))
    )


def precision_of(date: Column) -> Column:
    return F.when(date.isNull() | (date == ""), None).when(date.rlike(r"^\d{4}-\d{2}-\d{2}$"), "day").when(date.rlike(r"^\d{4}-\d{2}$"), "month").otherwise("year")


def earliest_day(date: Column) -> Column:
    """The first day that a partial date can mean, as days since 1970."""
    return F.unix_date(F.to_date(F.concat(date, F.when(F.length(date) == 4, "-01-01").when(F.length(date) == 7, "-01").otherwise(""))))


def day_text(day: Column) -> Column:
    """yyyy-MM-dd of a date or timestamp; years above 9999 are written out, without the plus that Spark gives them."""
    return F.regexp_replace(F.date_format(day, "yyyy-MM-dd"), r"^\+", "")


def days_since(date: Column, now: Column) -> Column:
    """Days, with fractions, from the earliest reading of a partial date to a timestamp without zone; at least 0."""
    seconds = F.unix_micros(now.cast("timestamp")) / 1e6
    return F.greatest(F.lit(0.0), (seconds - earliest_day(date) * 86400.0) / 86400.0)


def refined_date(date: Column, others: Column) -> Column:
    """The longest of the other dates that goes on where a date short of a day ends."""
    finer = F.filter(others, lambda o: F.startswith(o, date) & (F.length(o) > F.length(date)))
    longest = F.array_max(F.transform(finer, lambda o: F.length(o)))
    return F.when(F.length(date) >= 10, date).otherwise(F.coalesce(F.get(F.filter(finer, lambda o: F.length(o) == longest), 0), date))


def release_status(date: Column, today: str) -> Column:
    return F.when(date.isNull(), "unknown").when(date <= F.lit(today).substr(F.lit(1), F.length(date)), "released").otherwise("upcoming")
