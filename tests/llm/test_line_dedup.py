import hashlib
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tests.llm import helpers  # noqa: F401
from trolley.llm import line_dedup as L

SCHEMA = "page_id long, url string, html string, host string, lines string, common int"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "n_lines", "n_dropped", "kept_sha256").collect()), key=repr)


def test_query_equals_sql(spark):
    for sf in ("sf0.01", "sf0.1"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '/root/testdata/{sf}/pages.parquet'")
        assert rows_of(L.op10_line_dedup(spark, f"/root/testdata/{sf}")) == sorted(con.sql(L.SQL).fetchall(), key=repr)


def test_shares_of_host_pages(spark):
    pages = []
    for i in range(40):
        body = "<p>everywhere</p>" + ("<li>half the pages</li>" if i % 2 else "") + f"<div>own {i}</div>" + "<p>twice</p><p>twice</p>" * (i == 3)
        pages.append((i, f"https://User@A.example:80/p{i}", body, "x", "y", 1))
    pages += [(100, None, "<p>no address</p>", None, None, None), (101, "http://b.example/", None, None, None, None), (102, "http://b.example/", "", None, None, None),
              (103, "http://b.example", "<p>everywhere", None, None, None), (103, "http://b.example", "<p>everywhere", None, None, None), (None, "x", "<br>", None, None, None)]
    got = L.drop_boilerplate(spark.createDataFrame(pages, SCHEMA), ratio=0.6).collect()
    assert len(got) == len(pages)
    by = {r["page_id"]: r for r in got}
    assert by[0]["host"] == "a.example" and by[0]["kept"] == ["own 0"] and by[1]["kept"] == ["half the pages", "own 1"]
    assert by[3]["kept"] == ["half the pages", "own 3", "twice", "twice"]
    assert by[100]["host"] == "" and by[100]["kept"] == ["no address"] and by[101]["lines"] == by[102]["lines"] == by[None]["lines"] == []
    assert by[103]["kept"] == ["everywhere"]  # on half of its host's pages


def test_small_hosts_follow_the_same_rule(spark):
    pages = [(i, "http://small.example/", f"<li>menu</li><p>own {i}</p>", None, None, None) for i in range(19)]
    pages += [(50 + i, "http://two.example/", f"<li>menu</li><p>own {i}</p>", None, None, None) for i in range(2)] + [(90, "http://one.example/", "<li>menu</li>", None, None, None)]
    got = {r["page_id"]: r["kept"] for r in L.drop_boilerplate(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert all(got[i] == [f"own {i}"] for i in range(19)) and got[50] == ["own 0"] and got[90] == ["menu"]


def test_lines_of_markup(spark):
    html = "<html><script>var x='<p>';</script><style>a{}</style><!-- <p>no</p> --><h1>A &amp;  B</h1>\n text<br/>one <b>bold</b>\t word&nbsp;&lt;p&gt;<p> </p></html>"
    long = "<p>" + "x" * 200_000 + "</p>" + "<p>y</p>" * 20_000
    found = spark.createDataFrame([(html,), (long,)], "html string").select(L.lines_of(F.col("html")).alias("l")).collect()
    assert found[0]["l"] == ["A & B", "text", "one bold word <p>"]
    assert Counter(found[1]["l"]) == {"x" * 200_000: 1, "y": 20_000}
    assert re.match(L.HOST, "http://a.b/c")[1] == "a.b"


def test_empty_table(spark):
    assert L.drop_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_is_native(spark):
    plan = L.op10_line_dedup(spark, "/root/testdata/sf0.01")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and hashlib
