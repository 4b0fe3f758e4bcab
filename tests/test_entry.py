"""Driver contract: entry() runs; a sample of queries equals its SQL twin at sf0.001."""
import duckdb

import __spark_entry__ as E
from linea.sources.tables import TABLES

from .conftest import SF0001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["bleu"] > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(round(r[i], 9)) if isinstance(r[i], float) else repr(r[i]) for i in order)
                  for r in rows)


def test_sample_queries_match_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    for name in ["bleu_corpus", "bleu_detok", "aer", "align_jumps", "interleave_step1", "exact_match",
                 "bootstrap_acc", "dictionary", "parity_route"]:
        df = E.queries()[name](spark, SF0001)
        cur = con.execute(E.oracle_sql()[name])
        d_cols = [c[0] for c in cur.description]
        assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(cur.fetchall(), d_cols), name
