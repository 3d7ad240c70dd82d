"""Personal data against the plain rules, and what the trees add."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrule.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(x) if i % 2 == 0 else 2 * int(x) - 9 * (int(x) > 4) for i, x in enumerate(reversed(digits))) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain(text):
    return sorted((m.start(), i, m.end(), k) for i, k in enumerate(pii.KINDS) for m in re.finditer(PLAIN[k], text or "") if valid(k, m[0]))


def base_of(spark, texts):
    """Base spans of each text by the operator's search."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = pii.searched(docs)
    got = pii.spans(found).where("base").join(found.select("doc_id", "row"), "row").select("doc_id", "start", F.col("place") - 1, "stop", "kind").collect()
    return [sorted(tuple(r)[1:] for r in got if r.doc_id == i) for i in range(len(texts))]


TEXTS = [
    None, "", "plain", "a@b.c", "a@b.c@d.e", "x.y%z+1@host-1.example.co.uk, and b@c.d", "a@b.c-_x@d.e", "x@y @z.w a@.b.c", "1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 0255.1.01.000001", "1.2.3 4.5", "256.1.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111", "6625883203433323 6625883203433324", "12345678901", "+1 (858) 555-2896", "+1 2", "++49 89 123456 .", "+123456789012345678", "ä😀 a@b.cd 😀 +49 (0)89-123456", "tel.\n+1 555\n0123456",
    "0" * 40 + "1.2.3.4", "a" * 3000 + "@b.c", "5" * 5000, "1-" * 4000, "@" * 100 + ".", "a@b" + ".c" * 3000,
]


def test_base_spans(spark):
    assert base_of(spark, TEXTS) == [plain(t) for t in TEXTS]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab@.-_+0123456789 ()%😀", max_size=60), min_size=20, max_size=40))
def test_base_spans_of_any_text(spark, texts):
    assert base_of(spark, texts) == [plain(t) for t in texts]


def made(spark, n=400):
    """Rows with each kind in running text, numbers that fail, and, in the last ones, personal data in other forms."""
    card = lambda i: next(str(s) for s in range(4111111111110000 + 13 * i, 4111111111119999) if luhn(str(s)))
    bad = lambda i: next(str(s) for s in range(4111111111110000 + 13 * i, 4111111111119999) if not luhn(str(s)))
    rows = []
    for i in range(n):
        parts = [f"word{'s' * (i % 5)} write to user{i}.x@mail{i % 7}.example.com for it", f"then call +1 ({200 + i % 700}) 555-{1000 + i} today", f"the card {card(i)} was used", f"the number {bad(i)} is none", f"from host 10.{i % 250}.7.{i % 199} on", f"version {i % 9}.{i % 5}.1 of it", f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}" here']
        rows.append((i, "x. ".join(parts[i % 3 :] + parts[: i % 2]), "src"))
    rows.append((n, "for it, call (858) 555-2896 today", "src"))
    rows.append((n + 1, "and write to jane.doe(at)mail3.example.com for it", "src"))
    rows.append((n + 2, "nothing private in version 3.0.1 of 2024, all 12 of them.", "src"))
    return spark.createDataFrame(rows, "doc_id long, text string, row string")


def test_added_spans(spark):
    """Local numbers and written-out addresses are added, failing numbers and versions aren't; base spans stay."""
    docs = made(spark)
    rows = {r.doc_id: (r.text, r.private, r.gone, r.row) for r in pii.detected(docs.withColumn("copy", F.col("text")), "copy").withColumn("gone", pii.redacted(F.col("text"), F.col("private"))).collect()}
    assert len(rows) == 403 and {r[3] for r in rows.values()} == {"src"}
    for text, found, *_ in rows.values():
        assert sorted((x.start, x.place - 1, x.stop, x.kind) for x in found if x.base) == plain(text)
        assert [x for x in found if not x.base and any(y.base and x.start < y.stop and y.start < x.stop for y in found)] == []
    assert rows[400][2] == "for it, call [PHONE] today" and "jane" not in rows[401][2]
    assert rows[402][1] == []
    extra = [text[x.start : x.stop] for i, (text, found, *_) in rows.items() if i < 400 for x in found if not x.base]
    assert len(extra) <= 8, extra


def test_odd_rows(spark, odd, nothing):
    got = pii.detected(odd)
    assert got.columns == [*(c for c in odd.columns if c != "text"), "private"]
    assert got.count() == odd.count() and pii.detected(nothing).count() == 0
    twice = spark.createDataFrame([(1, "a@b.cd", "p"), (1, "a@b.cd", "p"), (None, "a@b.cd", None)], "doc_id long, text string, private string")
    assert [(r.doc_id, len(r._private)) for r in pii.detected(twice).orderBy(F.col("doc_id").desc()).collect()] == [(1, 1), (1, 1), (None, 1)]


def test_redaction_of_overlaps(spark):
    docs = spark.createDataFrame([("ä 1.2.3.4@x.org and a@b.cd.",), ("none",), (None,)], "text string")
    found = pii.detected(docs.withColumn("copy", F.col("text")), "copy")
    got = [r[0] for r in found.select(pii.redacted(F.col("text"), F.col("private"))).collect()]
    assert sorted(got, key=str) == sorted(["ä [EMAIL] and [EMAIL].", "none", None], key=str)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = pii.query(spark, folder).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        written = [f"{k}:{a}:{b}" for a, _, b, k in want]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [getattr(r, f"n_{k}") for k in pii.KINDS] == [sum(x[3] == k for x in want) for k in pii.KINDS]
        assert set(written) <= set(r.spans.split(",")) or not written


@pytest.mark.parametrize("digits, fits", [("4111111111111111", True), ("4111111111111112", False), ("0", True), ("79927398713", True)])
def test_check_digit(spark, digits, fits):
    assert spark.range(1).select(pii._luhn(F.lit(digits))).first()[0] is fits


def test_all_candidates_teach(spark):
    """Trees and thresholds see every candidate: 30,000 of one kind, more than any bound on their number."""
    rows = spark.range(30_000).select(F.col("id").alias("row"), F.lit(0).alias("start"), F.lit(9).alias("stop"), F.lit("phone").alias("kind"), (F.col("id") % 2).cast("double").alias("x"))
    rows = rows.withColumn("agrees", F.when(F.col("row") % 1000 == 1, 0.0).otherwise(F.col("x")))
    seen = []
    fit = pii.GBTClassifier.fit
    pii.GBTClassifier.fit = lambda self, df, *a: (seen.append(df.count()), fit(self, df, *a))[1]
    try:
        model = pii.model_of(rows, ["x"])
    finally:
        pii.GBTClassifier.fit = fit
    assert sum(seen) == 30_000 and model.scored(rows).count() == 30_000 and 0 < model.thresholds["phone"] < 1
