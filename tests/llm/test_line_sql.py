"""Line operators against their SQL where lines have outer blanks and digits
and the rules take effect."""

import duckdb
from oracle_check import same_rows

from squall.llm import line_spread, quality_lines
from squall.llm import queries as corpus


def lines_of(i):
    own = " ".join(f"w{i}x{k}" for k in range(55))
    return [f"  {i} of 10\t", "\t 1 Shared  Notice 12 ", f"Chapter {i % 3}", "  ", own, f"0 {i}", "1 shared notice 12"][: 3 + i % 5]


def test_queries_equal_their_sql_when_the_rules_fire(spark, tmp_path):
    rows = [(i, "\n".join(lines_of(i)) if i % 11 else None, "en", ("a", "b", None)[i % 3] if i % 2 else f"s{i % 29}", 9)
            for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name, sql, fired in (("op1_quality_rules", quality_lines.SQL, "n_frequent_lines"),
                             ("op2_line_dedup", line_spread.SQL, "n_removed_lines")):
        got, want = corpus.queries()[name](spark, str(tmp_path)).toPandas(), con.execute(sql).df()
        ok, diff = same_rows(got, want)
        assert ok and len(got) == len(want) == 400, diff
        assert want[fired].sum() > 100
