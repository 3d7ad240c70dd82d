"""Every query of the catalogue against its SQL on the smallest tables."""

import hashlib
import math
import os

import duckdb
import pytest

from ferrule.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def _alike(names, threshold):
    """Every pair of names with its similarity, by comparing all of them."""
    from ferrule.functions.columns import _jaro_winkler

    def score(a, b):
        x, y = set(a.split()), set(b.split())
        return math.floor(max(_jaro_winkler(a, b), len(x & y) / len(x | y)) * 10000 + 0.5) / 10000

    names = sorted(names)
    return [(a, b, score(a, b)) for i, a in enumerate(names) for b in names[i + 1 :] if score(a, b) >= threshold]


def plain_jaro_winkler_pairs(db):
    names = {r[0] for r in db.sql("SELECT DISTINCT p_name FROM part").fetchall()}
    return [{"a": a, "b": b, "score": s} for a, b, s in _alike(names, 0.85)]


def plain_fuzzy_flags(db):
    cores: dict[str, list[int]] = {}
    for (k,) in db.sql("SELECT s_suppkey FROM supplier").fetchall():
        base = hashlib.md5(str(k - k % 4).encode()).hexdigest()[:12].translate(str.maketrans("0123456789", "ghijklmnop"))
        name = [base, base[1:], base[:5] + base[6] + base[5] + base[7:], base][k % 4]  # the fourth has a word that the core leaves out
        cores.setdefault(name, []).append(k)
    out = [{"id": min(ids), "other": k, "score": 0.95} for ids in cores.values() for k in ids if k != min(ids)]
    pairs = [(min(cores[a]), min(cores[b]), s) for a, b, s in _alike(cores, 0.93)]
    return out + [{"id": min(a, b), "other": max(a, b), "score": s} for a, b, s in pairs]


def plain_resolver_learning(db):
    """Suppliers of even key are known by name and teach the id that the next odd one has too."""
    keys = [k for (k,) in db.sql("SELECT s_suppkey FROM supplier").fetchall()]
    return [{"ref": k, "id": k - k % 2, "round": 1 + k % 2} for k in keys if k % 2 == 0 or k - 1 in keys]


def plain_company_ladder(db):
    from test_ladder import plain as ladder

    suppliers = db.sql("SELECT s_suppkey, s_nationkey FROM supplier").fetchall()
    rows = []
    for k, nation in suppliers:
        tail = {0: " Games", 1: " Publishing", 2: f" {k}"}.get(k % 5, "")
        rows.append({"id": k, "name": f"House {nation}{tail}", "seeded": k % 10 == 3, "steam": f"s{k}" if k % 7 == 0 else None, "wikidata": f"Q{k}" if k % 4 == 0 else None, "igdb": None, "aliases": [f"Alias {k}"] if k % 6 == 1 else []})
    entries = [r for r in rows if r["id"] % 3]
    registry = {f"steam:s{k}": k + 1_000_000 for k, _ in suppliers if k % 9 == 0}
    mapped = {f"wikidata:Q{k}": k + 2_000_000 for k, _ in suppliers if k % 50 == 0}
    names: dict[str, int] = {}
    for r in rows:
        if r["id"] % 40 == 6:
            names[r["name"]] = min(names.get(r["name"], 1 << 60), r["id"] + 3_000_000)
    apart = [{k, k + 4} for k, _ in suppliers if k % 8 == 1]
    out = []
    for r in rows:
        ref = r | {"name": f"Alias {r['id']}" if r["id"] % 6 == 1 else r["name"] + " Inc."}
        found, method = ladder(ref, entries, mapped, names, registry, apart)
        out.append({"ref": r["id"], "id": found, "method": method})
    return out


PLAIN = {"jaro_winkler_pairs": plain_jaro_winkler_pairs, "fuzzy_flags": plain_fuzzy_flags, "resolver_learning": plain_resolver_learning, "company_ladder": plain_company_ladder}


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in catalogue.ORACLE:
        want = db.sql(catalogue.ORACLE[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    else:
        assert name in PLAIN, "a query without SQL needs a plain version"
        assert rows == sorted(tuple(plain(r[c]) for c in columns) for r in PLAIN[name](db))


def test_entry(spark):
    import __spark_entry__

    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


def test_reruns_agree(spark):
    one, two = (sorted(map(str, catalogue.QUERIES["content_hash"](spark, FOLDER).collect())) for _ in range(2))
    assert one == two
