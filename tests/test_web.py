from pyspark.sql import functions as F

from corvane.functions import web

PAGE = """
<a href="/url?sa=t&amp;q=https://acme.com/p%3Fa%3D1%26sa%3D2&amp;ved=1">r</a> <a href='/url?url=http://b.org/x/'>s</a>
<a href='https://acme.com/p/?z=1'>same</a> <a href="https://c.net/find?find_desc=x+y&amp;loc=1&amp;ei=3&amp;blank=#top">d</a>
<a href="https://maps.google.com/x">skipped</a> <a href="https://[bad/">bad</a> <i data-url="https://never.io/">n</i>
"""


def test_clean_url():
    c = web.clean_url_value
    assert c("https://A.com/x?b=&c=1 2&ved=3#f") == "https://A.com/x?c=1+2"
    assert [c(u) for u in ("ftp://a/b", "https:///x", "https://[bad/", None, "")] == [None] * 5


def test_organic_urls(spark):
    rows = [(0, PAGE), (1, None), (2, ""), (3, '<b data-href="https://x.io/a" data-url=\'https://x.io/a/\'>'), (4, "".join(f'<a href="https://h{i}.de/">' for i in range(20)))]
    df = spark.createDataFrame(rows, "i long, html string").withColumn("t", web.unescape("html")).withColumn("u", web.organic_urls(F.col("t")))
    got = {r.i: r.u for r in df.collect()}
    assert got[0] == ["https://acme.com/p?a=1", "http://b.org/x/", "https://c.net/find?find_desc=x+y&loc=1"]
    assert got[1] == got[2] == [] and got[3] == ["https://x.io/a"] and len(got[4]) == 10
    d = {r.i: r.d for r in df.select("i", web.diagnostics(F.col("html"), F.col("t"), F.col("u")).alias("d")).collect()}
    assert d[0].extraction_ok and d[0].zero_reason is None and d[0].redirect_hrefs == 2 and d[0].href_total == 6
    assert d[1].zero_reason == "empty response" and d[1].html_bytes == 0 and not d[1].extraction_ok


def test_diagnostics_of_walls(spark):
    long = "x" * 2000
    rows = spark.createDataFrame([("Before you Continue" + long,), ("Unusual Traffic" + long,)], "h string")
    got = rows.select(web.diagnostics(F.col("h"), F.col("h"), F.array()).alias("d")).collect()
    assert [(r.d.looks_like_consent_wall, r.d.looks_like_captcha) for r in got] == [(True, False), (False, True)]
    assert got[0].d.zero_reason.startswith("no parsable")


def test_overview(spark):
    pages = [None, "", "an AI Overview", "search?q=" + "x" * 20000, "search?q=", "ai overview" + "x" * 30000]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i long, h string")
    assert [r.o for r in df.select("i", web.overview_detected(F.col("h")).alias("o")).orderBy("i").collect()] == [None, None, True, False, None, None]


def test_quote(spark):
    from urllib.parse import quote

    texts = ["a b/c~*'(x)!", "é?&=+%", "", "日本-_."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    assert [r.q for r in df.select("i", web.quote_url(F.col("t")).alias("q")).orderBy("i").collect()] == [quote(t) for t in texts]
