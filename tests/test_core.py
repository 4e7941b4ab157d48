"""Rules and operators on invented rows, against expectations worked out by hand or by plain Python."""

from __future__ import annotations

import time
from urllib.parse import urldefrag, urljoin

import pytest
from pyspark.sql import functions as F

from prospectra.functions import arrays as A
from prospectra.functions import classify as C
from prospectra.functions import extract as X
from prospectra.functions import predicates as P
from prospectra.functions import text as T
from prospectra.functions import urls as U
from prospectra.operators import contacts as K
from prospectra.operators import keyed, leads as L, pages as O, people
from prospectra.plans import fixtures, lead_pipeline
from prospectra.plans.pages import PEOPLE_HTML, SITEMAP
from prospectra.sources import crawl, dom, sinks, tables
from prospectra.streaming import stages


def values(spark, rows, *columns):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], "a string, b string" if isinstance(rows[0], tuple) else "a string")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_text(spark):
    assert values(spark, ["\xa0 a\t\n b ", None, ""], T.clean_text("a")) == ["a b", "", ""]
    assert values(spark, ["Dr. Ann Lee -", "Mr Mrs Bo"], T.person_name("a")) == ["Ann Lee", "Mrs Bo"]
    assert values(spark, ["Dr. Ann , Lee |"], T.person_name_strict("a")) == ["Dr. Ann, Lee"]
    assert values(spark, ["Chairman Read MORE |", "View profileView bio x"], T.designation("a")) == ["Chairman", "x"]


def test_roles(spark):
    assert values(spark, ["Non-Executive Director", "Vice President", "Founder Chairman", "none"], C.role("a")["title"]) == ["Executive Director", "President", "Chairman", ""]
    rows = [("Executive Leadership", "Non-Executive Director"), ("Founder", "Founder"), ("CXO", "CEO, Example Co"), ("Board", "MANAGING DIRECTOR"), (None, "Vice Chairman and Managing Director"), ("x", "lead director")]
    assert values(spark, rows, C.leadership_type("a", "b")) == ["Board", "Unknown", "CXO", "CXO", "Board", "Board"]
    assert values(spark, ["CEO, Example Co", "Chairman", "", "x" * 181 + " director"], P.clean_designation("a")) == [False, True, False, False]


def test_scores(spark):
    rows = [("Chairman", "sibling_pair"), ("Chief Financial Officer", "sibling_pair"), ("Chairman Read more", "local_parent"), ("MANAGING DIRECTOR", "sibling_pair")]
    points = C.quality_score(F.lit("Ann Lee"), "a", F.lit(""), "b", F.lit("https://x.example/a"), F.lit("Co"))
    assert values(spark, rows, points) == [90, 100, 80, 100]


def test_names(spark):
    assert values(spark, ["Mira Tolvane", "Read More", "Ann Director", "a@b c", "Ann and Bo", "J", "Ann\n", "1" * 101], P.likely_person_name("a")) == [True, False, False, False, False, False, True, False]
    assert values(spark, ["Mira Tolvane", "Mira", "The Leadership", "A B", "Ann <b>"], P.person_like("a")) == [True, False, False, False, False]


@pytest.mark.parametrize("base", ["https://h.example/a/b", "https://h.example/a/b/", "https://h.example", "http://h.example/x?y=1"])
def test_resolve(spark, base):
    found = ["c", "/c/d", "../c", "./c/.", "?q=1", "#f", "//o.example/z", "https://o.example/", "mailto:a@b", "", "a/../b/./c#x", "../../../up", "c/", ".."]
    got = values(spark, [(base, r) for r in found], U.resolve("a", "b"))
    assert got == [urljoin(base, r) for r in found]
    assert values(spark, [(base, r) for r in found], F.regexp_replace(U.resolve("a", "b"), "#.*$", "")) == [urldefrag(urljoin(base, r))[0] for r in found]


def test_urls(spark):
    rows = ["HTTPS://u@WWW.Host.example:0443/a;p?q=1#f", "http://h.example", "ftp://h.example/", "https://h.example:x/", "https://", "http://h.example/" + "a" * 2050, "https://h.example:70000/"]
    assert values(spark, rows, U.crawl_url("a")) == ["https://host.example:443/a?q=1", "http://h.example/", "", "", "", "", ""]
    assert values(spark, ["h.example", "HTTP://H.example/A;x?b#c", ""], U.input_url("a")) == ["https://h.example/", "http://h.example/A?b", ""]
    kinds = [("https://h.example/project-management/", ""), ("https://h.example/services/contact/", ""), ("https://h.example/about_us", ""), ("https://h.example/x", "Contact  US"), ("https://h.example/", "Team"), ("https://h.example/board/Team.html", "")]
    assert values(spark, kinds, C.page_type("a", "b", F.lit("https://www.h.example"))) == ["other", "other", "about", "contact", "other", "team"]


def test_contacts_in_text(spark):
    text = ["mail a@b.test.", "A@b.test and a@b.test; x@example.com", "call +1 (555) 010-0199 or 1-555-010-0199", "1234 5678 9012 3456 1234567890123456", None]
    assert values(spark, text, F.array_join(X.emails("a"), ","), F.array_join(X.phones("a"), ",")) == [("", ""), ("a@b.test", ""), ("", "+1 (555) 010-0199"), ("", "1234 5678 9012"), ("", "")]
    assert values(spark, ["020 7946 0958 extension 12", "12345", "call +1 555 0100"], X.phone_cell("a")) == ["020 7946 0958 x 12", "", "+1 555 0100"]
    assert values(spark, ["b; A ,a|B;;c"], A.unique_join(A.split_values("a"))) == ["b | A | c"]


def test_validation(spark):
    rows = [(1, "Mira Tolvane", "Chairman"), (2, "Jonas Perrin", "Chairman with Mira Tolvane"), (3, "Mira Tolvane", "Mira Tolvane Chairman"), (4, "Ove", "Chairman"), (5, "Lena Ford", "CEO"), (6, "Jonas Perrin", "Chairman")]
    df = spark.createDataFrame(rows, "seq long, person_name string, designation string").selectExpr("*", "'Co' AS company_name", "'' AS company_domain", "'' AS leadership_type", "'' AS confidence", "'json_ld' AS extraction_method", "'https://x.example/' AS source_url")
    got = {r.seq: r.validation_reason for r in L.validate(df).collect()}
    assert got == {1: "passed_validation", 2: "designation_contains_other_person", 3: "passed_validation", 4: "invalid_person_name", 5: "invalid_designation", 6: "passed_validation"}
    assert sorted(r.seq for r in L.final_leads(L.validate(df.union(df.withColumn("seq", F.col("seq") + 10)))).collect()) == [1, 3, 6]


def test_candidate_ties(spark):
    rows = [(1, "HIGH", "semantic_card"), (2, "HIGH", "json_ld"), (3, "HIGH", "sibling_pair"), (4, "HIGH", "json_ld"), (5, "MEDIUM", "json_ld")]
    df = spark.createDataFrame(rows, "seq long, confidence string, extraction_method string").selectExpr("*", "'d' AS company_domain", "'n' AS person_name", "'t' AS designation")
    assert [r.seq for r in keyed.best_candidates(df).collect()] == [4]
    assert [r.seq for r in keyed.best_candidates(df.filter("extraction_method <> 'json_ld'")).collect()] == [1]


def test_contact_lookup(spark):
    pages = spark.createDataFrame([(1, "Co", "co.example", "", ""), (2, "Co", "other.example", "b@co.example", ""), (3, "", "x.example", "x@x.example", "555 010 0199"), (4, "Co", "co.example", "B@co.example, b@CO.example", "")], "seq long, company_name string, company_domain string, emails string, phones string")
    index = K.contact_index(K.contact_records(pages.filter("seq <> 4")))
    leads = spark.createDataFrame([(1, "co", "www.co.example"), (2, "CO", "nowhere.example"), (3, "Else", "x.example"), (4, "Else", "none.example")], "seq long, company_name string, company_domain string")
    got = {r.seq: (r.contact_status, r.company_email) for r in K.with_contacts(leads, index).collect()}
    assert got == {1: ("SOURCE_FOUND", ""), 2: ("SOURCE_FOUND", ""), 3: ("FOUND", "x@x.example"), 4: ("NOT_FOUND", "")}
    assert {r.seq: r.company_email for r in K.contact_index(K.contact_records(pages)).collect()}[1] == "b@co.example"


def test_enrichment_join_takes_the_last(spark):
    leads = spark.createDataFrame([(1, "Co", "Ann Lee", "Chair", "Board", "VALID")], "seq long, company_name string, person_name string, designation string, leadership_type string, validation_status string")
    more = spark.createDataFrame([(1, "co", "ann lee", "chair", "first"), (2, "CO", "Ann  Lee", "Chair", "second")], "seq long, company_name string, person_name string, designation string, enrichment_status string")
    row = L.master(leads, more).collect()[0]
    assert (row.enrichment_status, row.verification_status, row.lead_priority) == ("second", "VERIFIED", "LOW")


def test_people_and_page_contacts(spark):
    pages = spark.createDataFrame([(1, PEOPLE_HTML)], "page_id long, html string")
    nodes = dom.dom_nodes(pages)
    info = pages.selectExpr("page_id", "'Co' AS company_name", "'' AS company_domain", "'https://www.aldora.example/leadership' AS source_url")
    got = {(r.person_name, r.extraction_method) for r in people.page_people(nodes, info).collect()}
    assert got == {("Mira Tolvane", "json_ld"), ("Anton Vale", "json_ld"), ("Priya Kesh", "semantic_card"), ("Lena Ford", "semantic_card"), ("Jonas Perrin", "sibling_pair"), ("Sam Odell", "local_parent")}
    fetched = info.selectExpr("*", "source_url AS page_url", "'contact' AS page_type", "90 AS score", "source_url AS final_url", "200 AS status", "'text/html' AS content_type", "CAST(NULL AS STRING) AS error")
    row = O.page_contacts(fetched, nodes).collect()[0]
    assert (row.page_title, row.emails, row.mailto_emails, row.phone_numbers, row.tel_numbers, row.contact_page, row.contact_links, row.error, row.status_code) == (
        "Our & leadership", "sales@aldora.example", "Info@Aldora.example", "+1 (555) 010-0123", "+1 555 010 0199", "YES", "https://www.aldora.example/contact-us", "", "200",
    )
    assert "hidden@" not in row.page_text
    failed = O.page_contacts(fetched.withColumn("status", F.lit(404)), nodes).collect()[0]
    assert (failed.error, failed.status_code, failed.emails) == ("Page request failed", "", "")


def test_tree_of_broken_markup():
    rows = dom.tree_rows(1, "<ul><li>a<li><p>b<p>c</ul><table><tr><td>1<td>2<tr><td>3</table><br>x</div>")
    assert [(r[5], r[11]) for r in rows if r[5] in ("li", "p", "td")] == [("li", "a"), ("li", "b c"), ("p", "b"), ("p", "c"), ("td", "1"), ("td", "2"), ("td", "3")]


def test_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text('﻿Company_Name,URL\n"Aldora, Works",aldora.example\n,\nBrellin,\n', encoding="utf-8")
    assert sorted((r.company_name, r.website) for r in tables.scan_companies(spark, str(tmp_path / "in.csv")).collect()) == [("Aldora, Works", "https://aldora.example/"), ("Brellin", "")]
    assert tables.scan_companies(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path / "none.csv"))
    df = spark.createDataFrame([(1, ["a", "b"])], "x long, y array<string>")
    sinks.write_table(df, str(tmp_path / "out"), ["y", "z"], "csv")
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "out")).fillna("").collect()] == [("a; b", "")]


def test_lead_pipeline(spark, tmp_path):
    home = "<html><title>Home</title><nav><a href='/leadership'>Leadership</a><a href=/contact>Contact</a></nav></html>"
    bodies = [("https://www.aldora.example/", home), ("https://aldora.example/leadership", PEOPLE_HTML), ("https://aldora.example/contact", "<p>info@aldora.example"), ("https://aldora.example/sitemap.xml", SITEMAP)]
    snapshot = spark.createDataFrame([(i, u, u, 200, "text/xml" if "xml" in u else "text/html", b, None) for i, (u, b) in enumerate(bodies)], "page_id long, requested_url string, final_url string, status int, content_type string, body string, error string").withColumn("url_key", U.crawl_url("requested_url"))
    companies = spark.createDataFrame([(1, "Aldora Works", "www.aldora.example"), (2, "Gone", "gone.example"), (3, "aldora  works", "aldora.example")], "seq long, company_name string, website string")
    out = lead_pipeline.run(spark, companies, snapshot, str(tmp_path))
    assert {r.validation_status for r in out["companies"].collect()} == {"VALIDATED", "REQUEST_ERROR:NotInSnapshot"}
    leads = {r.person_name: r for r in out["leads"].collect()}
    assert {"Mira Tolvane", "Priya Kesh", "Lena Ford", "Jonas Perrin", "Sam Odell"} == leads.keys()
    assert leads["Mira Tolvane"].company_email == "sales@aldora.example | info@aldora.example"  # the leadership page has the higher score
    assert {r.metric: r.value for r in out["summary"].collect()}["final_records"] == "5"


def test_lead_pipeline_order_and_fallbacks(spark, tmp_path):
    """Snapshot rows for one URL twice, companies that share a host against the order of page ids, a home page that can't be read."""
    card = "<article><h3>{}</h3><p>Chief Technology Officer</p></article>"
    site = "<urlset><loc>https://brellin.example/leadership</loc><loc>https://brellin.example/x&#47;y&lt;</loc></urlset>"
    rows = [
        ("https://shared.example/", "<nav><a href=/leadership>Leadership</a></nav>", 200), ("https://shared.example/leadership", card.format("Priya Kesh"), 200),
        ("https://shared.example/leadership", "<p>busy", 503), ("https://shared.example/", "<nav></nav>", 500),
        ("https://brellin.example/", "%PDF", 200), ("https://brellin.example/sitemap.xml", site, 200), ("https://brellin.example/leadership", card.format("Jonas Perrin"), 200),
    ]
    kind = lambda u, b: "application/pdf" if b.startswith("%") else "text/xml" if "xml" in u else "text/html"
    schema = "page_id long, url_key string, requested_url string, final_url string, status int, content_type string, body string, error string"
    snapshot = spark.createDataFrame([(100 - i, u, u, u, status, kind(u, b), b, None) for i, (u, b, status) in enumerate(rows)], schema)
    companies = spark.createDataFrame([(1, "Zeta Works", "shared.example"), (2, "Alma Works", "https://shared.example/"), (3, "Brellin", "brellin.example")], "seq long, company_name string, website string")
    out = lead_pipeline.run(spark, companies, snapshot, str(tmp_path))
    assert out["companies"].count() == 3
    pages = [(r.company_name, r.page_url) for r in out["pages"].collect()]
    assert len(pages) == len(set(pages)) and ("Brellin", "https://brellin.example/leadership") in pages and ("Brellin", "https://brellin.example/x/y<") in pages
    leads = {(r.person_name, r.company_name) for r in out["leads"].collect()}
    assert leads == {("Priya Kesh", "Alma Works"), ("Jonas Perrin", "Brellin")}  # Alma comes first by name


def test_fetch_answers_once(spark):
    schema = "url_key string, requested_url string, final_url string, status int, content_type string, body string, error string"
    snapshot = spark.createDataFrame([("https://a.example/", "u", "u", s, "text/html", str(s), None) for s in (500, 200, 200)], schema)
    got = crawl.fetch(spark.createDataFrame([(1, "a.example"), (2, "https://b.example")], "seq long, site string"), "site", snapshot).collect()
    assert sorted((r.seq, r.body) for r in got if r.body) in ([(1, "200")], []) and len(got) == 2


def test_emails_in_linear_time(spark):
    rows = [("=" * 50_000,), ("!" * 50_000 + "@",), ("é=a@b.co éa@b.co x=y@c.de,z@d.fr. =@e.it .q@f.at a..b@g.ch",)]
    began = time.time()
    got = [r.e for r in spark.createDataFrame(rows, "t string").select(X.emails("t").alias("e")).collect()]
    assert got == [[], [], ["a@b.co", "x=y@c.de", "=@e.it", ".q@f.at", "a..b@g.ch"]] and time.time() - began < 20


def test_streaming(spark, tmp_path):
    docs = spark.createDataFrame([(1, "mail a@b.test now"), (2, "none")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    stream = stages.extract_contacts(stages.read_stream(spark, str(tmp_path / "in"), docs.schema))
    stages.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert {r.doc_id: r.emails for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: ["a@b.test"], 2: []}


def test_windows_and_classes_on_streams(spark, tmp_path):
    rows = [("2020-01-01 00:01:00", 1, "Chief Executive Officer"), ("2020-01-01 00:01:00", 1, "Chief Executive Officer"), ("2020-01-01 00:12:00", 2, "Independent Director")]
    typed = spark.createDataFrame(rows, "at string, k long, designation string").selectExpr("to_timestamp(at) AS at", "k", "designation", "'' AS leadership_type")
    typed.write.parquet(str(tmp_path / "in"))
    read = lambda: stages.read_stream(spark, str(tmp_path / "in"), typed.schema)
    stages.write_stream(stages.classify_leads(stages.distinct_rows(read(), "at", "k")), str(tmp_path / "out"), str(tmp_path / "a")).awaitTermination(120)
    assert sorted((r.k, r.leadership_type) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "CXO"), (2, "Board")]
    counted = stages.windowed_counts(read(), "at", "k").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    counted.awaitTermination(120)
    assert sorted((r.k, r.n) for r in spark.sql("SELECT k, n FROM counted").collect()) == [(1, 2), (2, 1)]


@pytest.mark.parametrize("name", ["validation_status", "contact_index", "page_classify", "company_contacts", "extract_emails", "page_people", "local_parent_pairs", "homepage_links", "contact_links", "visible_text"])
def test_queries_match_duckdb(spark, name):
    import duckdb

    from prospectra.plans import catalogue

    sf_dir, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in {*fixtures.TABLES.values(), "pages"}:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df, want = catalogue.queries()[name](spark, sf_dir), con.sql(catalogue.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_entry():
    import __spark_entry__ as entry

    assert entry.oracle_sql().keys() <= entry.queries().keys() and len(entry.queries()) > 100


def _against_duckdb(spark, name, tables):
    """A query's rows and its SQL's over invented tables."""
    import tempfile

    import duckdb

    from prospectra.plans import catalogue

    sf_dir, con = tempfile.mkdtemp(), duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{sf_dir}/{table}.parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet/*.parquet'")
    want = con.sql(catalogue.oracle_sql()[name])
    got = catalogue.queries()[name](spark, sf_dir).select(*want.columns)
    return sorted(map(repr, map(tuple, got.collect()))), sorted(map(repr, want.fetchall()))


def test_phones_beside_marks_and_other_digits(spark):
    texts = ["12345678(87654321 x", "12345678, 87654321", "٠١٢ 5550100199", "47796589\xa055653049", "1.2345678+2345678)3456789", "ends 555 010 0199\n"]
    got, want = _against_duckdb(spark, "extract_phones", {"documents": spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")})
    assert got == want and values(spark, texts[:2], F.array_join(X.phones("a"), ",")) == ["12345678", "12345678,87654321"]


def _pages(spark, *html):
    return {"pages": spark.createDataFrame([(100 * n, f"https://h.example/{n}", h) for n, h in html], "page_id long, url string, html string")}


def test_people_by_method_then_page(spark):
    """Pages of one host whose people and roles recur, by other methods and by the same."""
    got, want = _against_duckdb(spark, "page_people", _pages(spark, *((n, "<html><body></body></html>") for n in range(1, 26))))
    assert got == want


def test_titles_without_semicolons(spark):
    tables = _pages(spark, (1, "<html><title>A &amp; b&amp</title></html>"), (2, "<title>c &lt;d&gt; &am</title>"))
    got, want = _against_duckdb(spark, "page_title_dom", tables)
    assert got == want == [repr((100, "A & b&amp")), repr((200, "c <d> &am"))]
    found = lambda **k: [r[11] for r in dom.tree_rows(1, "<p>&amp &copyx &notit; &#65 &eacute;&#x41;</p>", **k)]
    assert found() == ["& ©x ¬it; A éA"] and found(closed=True) == ["&amp &copyx &notit; &#65 éA"]
    assert dom.tree_rows(1, "<script>a && b &amp c</script>", closed=True)[0][10] == "a && b &amp c"


def test_texts_without_semicolons(spark):
    got, want = _against_duckdb(spark, "visible_text", _pages(spark, (1, "<html><body><p>a &amp; b&amp</p><p>c&nbsp;d</p></body></html>")))
    assert got == want == [repr((100, "a & b&amp c d"))]


def test_whole_text_of_long_pages(spark):
    words = " ".join(f"word{n}" for n in range(4000))
    tables = _pages(spark, (1, f"<html><body><p>{words}</p><p>mail last@h.test or 555 010 0199</p></body></html>"))
    got, want = _against_duckdb(spark, "visible_text", tables)
    assert got == want == [repr((100, f"{words} mail last@h.test or 555 010 0199"))]
    info = {"company_name": "Co", "company_domain": "", "page_url": "u", "page_type": "other", "final_url": "u", "content_type": "text/html"}
    fetched = tables["pages"].select("page_id", *(F.lit(v).alias(k) for k, v in info.items()), F.lit(0).alias("score"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"))
    row = O.page_contacts(fetched, dom.dom_nodes(tables["pages"])).collect()[0]
    assert (row.emails, row.phone_numbers) == ("last@h.test", "555 010 0199")


def test_excerpts_of_one_file_are_dealt_out(spark, tmp_path):
    """A table read by one task is worked on by several, with the same excerpts."""
    from prospectra.plans import catalogue

    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    df = catalogue.queries()["bio_excerpt"](spark, str(tmp_path))
    assert df.rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism
    got, want = _against_duckdb(spark, "bio_excerpt", {"customer": spark.read.parquet(str(tmp_path / "customer.parquet"))})
    assert got == want and values(spark, ["\xa0\xa0a \t b\t c d\n", " ", " "], T.clean_text("a")) == ["a b c d", "", ""]


def test_addresses_are_taken_apart_once(spark):
    """Filters on a computed address don't compute it anew, and probes are what each path's own address is."""
    from prospectra.functions import rules as R
    from prospectra.operators import discovery

    anchors = spark.createDataFrame([(1, "https://h.example/", 1, "/team#a", "Our team"), (1, "https://h.example/", 2, "https://o.example/team", "Team")], "company long, homepage string, seq long, href string, anchor_text string")
    found = discovery.link_candidates(anchors)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("[^:@") == 1
    assert [(r.url, r.page_type) for r in found.collect()] == [("https://h.example/team", "team")]
    homes = ["https://www.H.example:0443/a?b#c", "http://u@h.example", "", "ftp://h.example", "https://h.example:x/", f"https://{'h' * 2027}.example/", "h.example", "https://h.example/a;b?c=/d"]
    homes += [f"https://h{'h' * n}.example/" for n in range(2010, 2035)]
    df = spark.createDataFrame(list(enumerate(homes)), "seq long, homepage string")
    plain = df.crossJoin(spark.createDataFrame(R.COMMON_PATHS, "path string, expected_type string")).withColumn("candidate", U.crawl_url(F.concat(F.lit("/"), "path"), "homepage")).filter("candidate <> ''")
    rows = lambda x: sorted((r.seq, r.path, r.candidate) for r in x.collect())
    assert rows(discovery.probes(df)) == rows(plain) and len(rows(plain)) > 100
