"""Every query that has a DuckDB twin gives its rows, on the driver's small tables."""

import decimal
import re
import unicodedata
from difflib import SequenceMatcher
from pathlib import Path

import duckdb
import pytest

from innkeep.operators import fuzzy
from innkeep.plans import catalog, hotel_queries

QUERIES, ORACLE = catalog.QUERIES | hotel_queries.QUERIES, catalog.ORACLE | hotel_queries.ORACLE
DATA = Path("/root/testdata/sf0.001")


def norm(v):
    v = float(v) if isinstance(v, decimal.Decimal) else v
    return round(v, 5) + 0.0 if isinstance(v, float) else v


@pytest.mark.skipif(not DATA.is_dir(), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted(repr([norm(v) for v in r]) for r in df.select(*cols).collect())
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == cols
    assert got == sorted(repr([norm(r[names.index(c)]) for c in cols]) for r in want.fetchall())


@pytest.mark.skipif(not DATA.is_dir(), reason="no driver tables")
def test_queries_without_sql(spark):
    """Those that SQL can't express are held against plain Python."""
    assert set(QUERIES) - set(ORACLE) == {"normalize_unicode_text", "fuzzy_score"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}

    def plain(t):
        low = " ".join("".join(c for c in unicodedata.normalize("NFKD", t or "") if unicodedata.category(c) != "Mn").split()).lower()
        return re.sub(r"[^a-z0-9\s]", "", low)

    assert {r["doc_id"]: r["normalized"] for r in QUERIES["normalize_unicode_text"](spark, str(DATA)).collect()} == {i: plain(t) for i, t in texts.items()}
    rooms = [[(r["ord"], r["text"], set(r["tokens"]), set(r["stems"]), set(r["numeric_features"])) for r in fuzzy.normalize_rooms(side).collect()] for side in catalog._parts(spark, str(DATA))]
    best = {r["ord"]: (r["target_ord"], r["score"]) for r in QUERIES["fuzzy_score"](spark, str(DATA)).collect()}
    jaccard = lambda x, y: len(x & y) / len(x | y) if x and y else 0.0
    for o, t, tok, stem, num in rooms[0]:
        scores = []
        for p, u, tok2, stem2, num2 in rooms[1]:
            number = 1.0 if not num and not num2 else len(num & num2) / max(len(num), len(num2)) if num and num2 else 0.0
            scores.append(((jaccard(tok, tok2) * 35 + jaccard(stem, stem2) * 30 + number * 20 + round(100 * SequenceMatcher(None, t, u).ratio()) / 100 * 15) / 100 * 100, -p))
        assert best[o] == (-max(scores)[1], round(max(scores)[0], 6))
