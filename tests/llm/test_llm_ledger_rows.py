"""Documents without an id, and several with the same, in the token totals."""

from __future__ import annotations

import duckdb
import pytest

import compare
from qaloom.llm import queries, token_counts


@pytest.mark.parametrize("toxic", [[(2, 1), (3, 1), (9, 1), (5, 0)], [(2, 0)]])
def test_totals_of_odd_documents_as_sql(spark, tmp_path, odd_docs, toxic):
    line = queries.LICENSE
    more = [
        (9, f"a b\n{line} c d\ne", "en", "s1"), (9, "p-q r", "en", "s1"), (9, "p-q r", "de", "s2"), (9, "p-q r", "en", "s1"),
        (None, f"{line} x\ny z", "fr", "s1"), (10, "u", None, "s9"), (10, "u", "s9", None), (2, f"{line} x\ny z", "fr", "s1"),
    ]
    docs = odd_docs.select("doc_id", "text", "lang", "source")
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert compare.differences(queries.op2_token_counts(spark, str(tmp_path)), con, queries.SQL_OP2) is None


def test_parts_of_an_id(spark, tmp_path):
    ledger = token_counts.TokenLedger(spark, str(tmp_path / "ledger"))
    schema = f"{token_counts.CHANGE}, {token_counts.EXTRA}"
    changes = lambda *rows: spark.createDataFrame(rows, schema)
    totals = lambda: [(r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()]
    first = [("insert", i, "t", "s", "en", 5, p, n) for i, p, n in ((1, 7, 2), (1, 8, 1), (None, 7, 1), (2, None, None))]
    assert ledger.apply("1", changes(*first)) and totals() == [(5, 25)]
    second = [("revise", 1, "t", "s", "en", 3, 7, 2), ("delete", None, "t", None, None, None, 7, None)]
    assert ledger.apply("2", changes(*second)) and totals() == [(4, 16)]
    assert ledger.apply("3", changes(("delete", 1, "t", None, None, None, None, None))) and totals() == [(1, 5)]
