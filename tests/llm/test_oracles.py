"""Queries of the operators that SQL can express, against their SQL."""

import duckdb
import pytest

from starloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# the smallest set has no secrets
WITH_SECRETS = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(llm, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    df = QUERIES[name](llm, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(want.fetchall())


# what SQL can say of operators whose whole result it cannot
PARTS = {
    "op8_document_fingerprints": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) // 3 AS k FROM documents),
        n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS following FROM d)
      SELECT doc_id, length(t) AS n_chars, sha256(concat(left(t, length(t) - k), left(following, k))) AS edited_sha256 FROM n""",
    "op9_secret_scans": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
      SELECT doc_id,
        len(list_filter(regexp_extract_all(t, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6)) AS n_assign,
        len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS n_access,
        len(list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda x: length(x) >= 24)) AS n_hex FROM d""",
}


@pytest.mark.parametrize("name", sorted(PARTS))
def test_part_of_query(llm, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{WITH_SECRETS}/documents.parquet'")
    want = con.execute(PARTS[name])
    columns = [d[0] for d in want.description]
    rows = sorted(want.fetchall())
    assert any(r[1] for r in rows) and any(r[-1] for r in rows)
    assert sorted(map(tuple, QUERIES[name](llm, WITH_SECRETS).select(columns).collect())) == rows


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
