"""Column helpers against literal expectations."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrule.functions import columns as C


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_slug(spark):
    got = values(spark, C.slug(F.col("x"), unicode=True), ["Ōkami & Friends", "Bob's -- Game!", "  ", "Pokémon: Édition", "A" * 90])
    assert got == ["okami-and-friends", "bobs-game", "untitled", "pokemon-edition", "a" * 80]


@pytest.mark.parametrize(("name", "want"), [("Acme Co., Ltd.", "acme"), ("Inc", "inc"), ("Foo Games LLC", "foo games"), ("Bar S.A.S.", "bar s"), ("X Sp. z o.o. Inc", "x")])
def test_company_name(spark, name, want):
    assert values(spark, C.company_name(F.col("x")), [name]) == [want]


def model_company(words: str) -> str:
    changed = True
    while changed:
        changed = False
        for form in C.LEGAL_FORMS:
            if words.endswith(f" {form}"):
                words, changed = words[: -len(form) - 1].strip(), True
    return words


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["acme", "co", "ltd", "a", "s", "pty", "k", "kk", "sp", "z", "o", "inc"]), min_size=1, max_size=6).map(" ".join), min_size=1, max_size=8))
def test_company_name_is_a_fixpoint(spark, names):
    assert values(spark, C.company_name(F.col("x")), names) == [model_company(n) for n in names]


def test_loose_and_core(spark):
    assert values(spark, C.loose_company_name(F.col("x")), ["PlaySide Studios (AU)", "Games", "Coffee Publishing", "A Games Studio Ltd"]) == ["playside", "", "coffee publishing", "a"]
    assert values(spark, C.core_company_name(F.col("x")), ["The Bossa Games Team", "Studios Inc"]) == ["bossa", ""]


def test_technology_and_title(spark):
    assert values(spark, C.technology_name(F.col("x")), ["C", "C#", "C++", "C Sharp"]) == ["c", "c sharp", "c plus plus", "c sharp"]
    assert values(spark, C.title_name(F.col("x")), ["The Witness™", "A Hat in Time", "Anthem"]) == ["witness", "hat in time", "anthem"]


def test_vocabulary_is_idempotent(spark):
    once = values(spark, C.platform(F.col("x")), ["PC (Microsoft Windows)", "Mac OS X", "Steam Deck"])
    assert once == ["windows", "macos", "steam-deck"] and values(spark, C.platform(F.col("x")), once) == once
    assert values(spark, C.genre(F.col("x")), ["Role-playing (RPG)", "Hack and slash/Beat 'em up", "Odd One"]) == ["rpg", "hack-and-slash", "odd-one"]


def test_store_dates(spark):
    text = ["Feb 24, 2017", "24 Feb, 2017", "February 2027", "Q1 2027", "2027", "2020-01-02T00:00", "Coming soon", "Foo 3, 2020", None]
    got = [tuple(r) if r else None for r in values(spark, C.store_date(F.col("x")), text)]
    assert got == [("2017-02-24", "day"), ("2017-02-24", "day"), ("2027-02", "month"), ("2027", "year"), ("2027", "year"), ("2020-01-02", "day"), None, None, None]


def test_html_and_languages(spark):
    assert values(spark, C.html_text(F.col("x")), ["a<br/>b &amp;lt; <i>c</i>&#33;&nbsp;&quot;d&#8364;"]) == ['a b &lt; c! "d€']
    assert values(spark, F.array_join(C.languages(F.col("x")), "|"), ["English<strong>*</strong>, French<br>x, y", "", None]) == ["English|French", "", None]


def test_similarity(spark):
    df = spark.createDataFrame([("martha", "marhta"), ("a", "a"), ("", "b"), ("abcvwxyz", "cabvwxyz"), ("abcd", "wxyz")], "a string, b string")
    got = [r[0] for r in df.select(C.jaro_winkler(F.col("a"), F.col("b"))).collect()]
    assert got[:3] == [pytest.approx(0.9611, abs=1e-4), 1.0, 0.0] and got[3] == pytest.approx(0.9375) and got[4] == 0
    assert [r[0] for r in df.select(C.token_similarity(F.lit("a b c"), F.lit("b c d"))).take(1)] == [0.5]


def test_labels_and_search(spark):
    assert values(spark, C.labelized(F.col("x")), ["game-of_the 2d year", "a-b"]) == ["Game of the 2D Year", "A B"]
    labels = ["zelda", "zelda two", "a zelda", "azelda", "other"]
    assert values(spark, C.search_score(F.col("x"), F.array(F.lit("zzz"), F.lit("my zelda")), "zelda"), labels) == [100, 80, 60, 40, 25]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=20))
def test_rounding(spark, numbers):
    assert values(spark, C.rounded(F.col("x"), 2), numbers, "double") == [math.floor(n * 100.0 + 0.5) / 100.0 for n in numbers]


def test_partial_dates(spark):
    others = F.array(F.lit("2017-02"), F.lit("2017-02-24"), F.lit("2018-01-01"))
    assert values(spark, C.refined_date(F.col("x"), others), ["2017", "2017-02", "2016", "2015-01-01"]) == ["2017-02-24", "2017-02-24", "2016", "2015-01-01"]
    assert values(spark, C.release_status(F.col("x"), "2026-01-16"), ["2026", "2026-02", "2026-01-16", None]) == ["released", "upcoming", "released", "unknown"]
    assert values(spark, C.days_since(F.col("x"), F.lit("2026-01-02 12:00:00").cast("timestamp_ntz")), ["2026", "2026-01-02", "2027"]) == [1.5, 0.5, 0.0]
