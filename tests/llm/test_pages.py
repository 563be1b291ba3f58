"""HTML extraction, URL filter and WARC archives: plain versions, round trips and odd rows."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import io
import html
import random
import re
import time

import pytest

from tidemark.llm import html_text, url_rules, warc
from tidemark.llm.queries import URL_RULES

SMOKE = "/root/testdata/sf0.001"

PAGE = """<!doctype html><html><head><title>Not this</title><style>p{}</style>
<script>if (a < b) document.write("<p>no</p>");</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href="/x">Menu one</a></li></ul></nav>
<div class="cookie-notice">We use cookies.</div><aside>Side matter</aside>
<main><article><h1>A &amp; B&nbsp;C</h1><p>First   para <b>bold <i>and</i></b>
 text&#33;<p>Second<br>line</p><div class="ad-box">Buy now</div><p>Short</p>
<form><label>Name</label><input name=q><button>Send</button></form><!-- <p>hidden</p> -->
<ul><li>one<li>two</ul><figure><figcaption>Caption</figcaption></figure>
<section id="comments"><p>A reader writes a long comment about all of this.</p></section>
<p data-x="a > b" title='c > d'>Last 1 &lt; 2</p></article></main><footer>&copy; 2024</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert html_text.main_text(PAGE).split("\n") == [
        "A & B C", "First para bold and text!", "Second line", "Short", "one", "two", "Caption", "Last 1 < 2",
    ]


def test_pages_without_an_article_use_the_line_lengths():
    text = ["This is the first paragraph of the story and it is long enough.", "Then.", "The second one goes on for quite a while too, as they do."]
    page = (
        "<body><div><a href=1>Home</a> <a href=2>News</a></div><div class=sidebar><p>Side note of the page.</p></div>"
        "<h2>Headline</h2>" + "".join(f"<p>{t}</p>" for t in text) + "<div><a href=3>Older</a></div></body>"
    )
    assert html_text.main_text(page).split("\n") == ["Headline", *text]
    assert html_text.main_text("<p>tiny</p>") == "tiny"
    assert html_text.main_text("no markup at all") == "no markup at all"


BODY = "".join(f"<p>Paragraph {i} of the story goes on for quite a while, as they all do.</p>" for i in range(8))


def test_an_article_is_a_weight_and_not_the_verdict():
    body = html_text.main_text(BODY)
    card = "<article><h3>Another story</h3><p>Read this.</p></article>"
    # the body lies outside the only article, a teaser
    assert html_text.main_text(f"<div>{BODY}</div>{card}") == body
    # links in an article are judged as elsewhere, but a linked headline goes with its text
    links = "".join(f"<li><a href={i}>Read story number {i}</a></li>" for i in range(9))
    assert html_text.main_text(f"<article><h1><a href=1>Title</a></h1>{BODY}<ul>{links}</ul></article>") == f"Title\n{body}"
    # short lines pass inside an article, and not beside it
    assert html_text.main_text(f"<p>By the way</p><article>{BODY}<p>The end.</p></article><p>Printed 3 May</p>") == f"{body}\nThe end."
    # text cut off from the article counts by its own length
    assert html_text.main_text(f"<article>{BODY}</article>{BODY}") == f"{body}\n{body}"


def test_a_class_word_does_not_rule_out_what_holds_the_text():
    body = html_text.main_text(BODY)
    article, side = f"<article>{BODY}</article>", f"<div class=sidebar>{BODY[:200]}</div>"
    for words in ("site no-sidebar", "has-sidebar", "with-comments", "share-enabled", "layout-sidebar-left", "widget"):
        for inside in (article, f"<main>{BODY}</main>", BODY):
            assert html_text.main_text(f"<div class='{words}'><div>{inside}</div>{side}</div>") == body
            assert html_text.main_text(f"<div id='{words}'><nav>Menu</nav>{inside}</div><footer>{BODY}</footer>") == body
    assert html_text.main_text(f"<article class='post tag-search'><div class=share-box>{BODY}</div></article>") == body


def test_the_class_of_an_article_counts():
    body = html_text.main_text(BODY)
    comment = "<p>A reader writes a long comment about all of this, and then some more.</p>"
    for own in ("class=comment", "id=comment-12", "class='related-story'", "hidden"):
        assert html_text.main_text(f"<article class='post category-social'>{BODY}</article><article {own}>{comment}</article>") == body
        assert html_text.main_text(f"<div>{BODY}</div><article {own}>{comment}</article>") == body
    # elements that hold articles but not the page's are ruled out as before
    assert html_text.main_text(f"<article>{BODY}</article><div class=comments><article>{comment * 3}</article></div>") == body
    assert html_text.main_text(f"<div>{BODY}</div><div class=related><article>{comment}</article></div>") == body


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<article>", ""), ("<article><p>cut he", "cut he"), ("<article><p>a<b>b</article>x", "ab"),
        ("<article>a &am", "a &am"), ("<article><p>a</p></p></b>c<!-- open", "a\nc"), ("<article><script>x", ""),
        ("<article>1 < 2 <3 &lt;p&gt;</article>", "1 < 2 <3 <p>"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_pages_take_linear_time():
    for part in ("<", "<a ", "<p>x", "</p>", "<!--", "&amp;", "<div class='x", "a" * 50 + " "):
        html_text.main_text("<article>" + part * 40_000)
    started = time.process_time()
    for part in ("<div>x ", "<div class=ad>x ", "<i><div><b>", "<form><p>x", "<article>x", "<a href=1>x", "<ul><li>x"):
        html_text.main_text("<i><div>" + part * 40_000 + "</i>" * 40_000)
    assert time.process_time() - started < 60  # minutes each where every line walks the open elements


def test_windows_keep_what_lies_between_lines_of_text():
    body = html_text.main_text(BODY)
    for short in ("<p>oh</p>" * 8, "<ol>" + "<li>0</li>" * 9 + "</ol>", "<p>- Yes.</p><p>- No.</p>" * 20):
        lines = re.findall(r"<(?:p|li)>(.*?)</", short)
        assert html_text.main_text(f"<article>{BODY}{short}{BODY}</article>").split("\n") == [*body.split("\n"), *lines, *body.split("\n")]
        assert html_text.main_text(f"<article>{BODY}{short}</article>") == "\n".join([body, *lines])
    link = "<p><a href=1>See the full report</a></p><ul><li><a href=2>A source</a></li><li><a href=3>Another source</a></li></ul>"
    assert html_text.main_text(f"<article>{BODY}{link}{BODY}</article>") == f"{body}\nSee the full report\nA source\nAnother source\n{body}"


def test_the_windows_decide_pages_without_helpful_classes():
    body = html_text.main_text(BODY)
    menu = "".join(f"<div><a href={i}>Topic {i}</a></div>" for i in range(12))
    more = "".join(f"<div><a href={i}>Another story with a long headline, number {i}</a></div>" for i in range(6))
    plain = f"<body><div>{menu}</div><div>Today</div>{menu}<div><h1>Title</h1>{BODY}</div>{menu}{more}<div>Printed 3 May</div></body>"
    assert html_text.main_text(plain) == f"Title\n{body}"
    assert html_text.main_text(plain.replace("<body>", "<body><form id=f>").replace("</body>", "</form></body>")) == f"Title\n{body}"


def test_forms_classes_of_text_and_own_headers():
    body = html_text.main_text(BODY)
    assert html_text.main_text(f"<form><article>{BODY}</article></form>") == body
    assert html_text.main_text(f"<article>{BODY}<form><label>Your name</label><p>We write to you.</p></form></article>") == body
    for words in ("legal", "notice", "social comment"):
        assert html_text.main_text(f"<article>{BODY}<p class='{words}'>Middle.</p>{BODY}</article>") == f"{body}\nMiddle.\n{body}"
    assert html_text.main_text(f"<article>{BODY}<div class=side-by-side>Middle.</div>{BODY}</article>") == f"{body}\nMiddle.\n{body}"
    assert html_text.main_text(f"<article>{BODY}<div class=ad-box>Buy.</div>{BODY}</article>") == f"{body}\n{body}"
    head = "<header><h1>Title</h1><p>What it is about.</p><ul><li>Share</li></ul></header>"
    assert html_text.main_text(f"<article>{head}{BODY}</article>") == f"Title\nWhat it is about.\n{body}"


def test_whole_smoke_pages(spark):
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet")
    out = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", article)]
        assert out[r["page_id"]] == "\n".join(t for b in blocks if (t := " ".join(html.unescape(b).split())))


def test_extract_keeps_other_columns_and_handles_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "t"), (None, PAGE, None), (1, None, "t")], "page_id long, html string, text string")
    out = html_text.extract(df)
    size = len(html_text.main_text(PAGE))
    assert sorted((r["page_id"] or 0, len(r["text"])) for r in out.collect()) == [(0, size), (1, 0), (1, 0)]
    assert html_text.extract(df.limit(0)).collect() == []
    clash = spark.createDataFrame([(1, "<p>x</p>", "t")], "page_id long, html string, Text string")
    assert html_text.extract(clash).collect() == [(1, "x")]


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and h]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///x", "http://COM/", "http://example.com", "http://example.com/en", "http://example.com/en/",
    "https://a.b.EXAMPLE.com/en/x?y#z", "https://www.example.com/en/1", "https://x.www.example.com/en/1", "http://notexample.com/en/1",
    "http://a.net/es/q", "http://net/fr/", "http://a.net/frr/", "http://a.net?x=/es/", "http://a.net#/es/", "a://b://c.net/es/1",
    "http://ÄÖ.net/es/ü", "http://a..net/es/", "http://.net/es/", "http://" + "a." * 5000 + "net/es/1", "http://a.net/" + "x/" * 5000, "http://a.com:80/en/",
]


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_rules_match_a_plain_version(spark, broadcast_rows):
    more = [*URL_RULES, ("a.net", "/x/x/", "block"), ("example.com", "/en", "allow"), ("net", "", "block"), ("", "/", "block")]
    for rules in (URL_RULES, more, []):
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        rows = [(i, u, "k", "v") for i, u in enumerate(URLS)] + [(0, None, "k", "v")]
        pages = spark.createDataFrame(rows, "page_id long, url string, _h string, _p string")
        out = url_rules.judge(pages, table, broadcast_rows=broadcast_rows).collect()
        got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out), key=str)
        assert got == sorted(((i, *plain_verdict(u, rules)) for i, u, *_ in rows), key=str)
    assert url_rules.judge(pages.limit(0), table).collect() == []


def warc_rows():
    big = "<p>" + "lang " * 200_000 + "</p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"
    rows = [
        (5, "http://a.example.com/x", "same"), (3, "http://b.org", "same"), (9, None, "same"), (9, None, "same"), (3, "http://b.org", "same"),
        (None, "http://c.org", "same"), (None, "http://c.org/1", "alone"), (None, "http://c.org/2", "alone"), (7, "", None), (8, "http://e", ""),
        (11, "http://x.org/a\r\nWARC-Type: fake", "é ü 🙂"), (12, "http://x.org/\u0085b", big), (13, "http://y.org", big),
    ]
    return rows + [(100 + i, f"http://h{i % 7}.org/{i % 3}", f"text {i % 40}") for i in range(200)]


def test_archives_round_trip(spark, scratch_dir):
    rows = warc_rows()
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    out = warc.archive_and_index(pages, f"{scratch_dir}/warc").collect()
    first = {}
    for i, _, text in rows:
        first[text or ""] = min((x for x in (i, first.get(text or "")) if x is not None), default=None)
    want = []
    for i, _, text in rows:
        raw, least = (text or "").encode(), first[text or ""]
        kind = "response" if i == least else "revisit"
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), digest, kind, least if kind == "revisit" else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    ordered = sorted(out, key=lambda r: (r["index_range"], r["index_place"]))
    keys = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in ordered]
    assert keys == sorted(keys)
    assert [r["index_place"] for r in ordered if r["index_range"] == ordered[0]["index_range"]][0] == 0


def test_archives_are_plain_warc_files(spark, scratch_dir):
    pages = spark.createDataFrame([(1, "http://a.org/", "x"), (2, "http://a.org/", "x")], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), f"{scratch_dir}/w")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{scratch_dir}/w/*.gz"))
    found = list(warc.parse_records(io.BytesIO(data)))
    assert {h["WARC-Record-ID"]: h["WARC-Type"] for h, *_ in found} == {"<urn:page:1>": "response", "<urn:page:2>": "revisit"}
    assert all(data[at : at + 8] == b"WARC/1.1" for *_, at, _ in found)
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(data[:-7])))


def test_empty_table_gives_an_empty_index(spark, scratch_dir):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_index(pages, f"{scratch_dir}/w").collect() == []


def test_loser_tree_merges_like_sorting():
    rng = random.Random(8)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rng.randint(0, 9), run, n) for n in range(rng.randint(0, 12))) for run in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs], lambda row: row[:1]))
        assert merged == sorted((x for r in runs for x in r), key=lambda row: (row[0], row[1]))


def test_large_pages_get_small_archives(spark, scratch_dir):
    rows = [(i, f"http://h{i % 5}.org/", f"{i % 30} " * (20_000 if i % 10 == 0 else 5)) for i in range(120)] + [(500, "http://z.org", "z" * 900_000)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, f"{scratch_dir}/w", records_per_file=50, archive_bytes=200_000)
    sizes = []
    for f in glob.glob(f"{scratch_dir}/w/*.gz"):
        with gzip.open(f) as data:
            sizes.append([len(block) for _, block, *_ in warc.parse_records(data)])
    assert sum(map(len, sizes)) == 122 and all(len(x) == 1 or sum(x) < 200_000 + 1000 * len(x) for x in sizes)
    runs = warc.store(warc.read_runs(spark, f"{scratch_dir}/w"), "warc-runs-test")
    assert runs.count() == 122 and runs.where("page_id = 500").select("record_type").distinct().count() == 1
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in runs.where("page_id < 500").collect()}
    first = {text: min(i for i, _, t in rows if t == text) for _, _, text in rows}
    assert kinds == {i: ("response", None) if first[t] == i else ("revisit", first[t]) for i, _, t in rows if i < 500}


def test_ranges_merge_stored_runs_into_one_order(spark):
    rng = random.Random(21)
    rows = []
    for run in "abcdefg":
        for n in range(rng.randint(1, 400)):
            page = rng.choice([None, rng.randint(0, 50)])
            key = rng.choice(["hot)/", "hot)/", f"k{rng.randint(0, 9)})/"])
            rows.append((page, key, f"2024-0{rng.randint(1, 3)}", 1, "D", "response", None, f"{run}{n % 3}.gz", n, 9, run))
    runs = warc.store(spark.createDataFrame(rows, warc.RUN_COLUMNS), "warc-runs-test")
    out = warc.merged_index(runs, 5).collect()
    got = [tuple(r)[:11] for r in sorted(out, key=lambda r: (r["index_range"], r["index_place"]))]
    assert got == sorted(rows, key=warc.order_of)
    assert len({r["index_range"] for r in out if r["url_key"] == "hot)/"}) > 1
    assert warc.merged_index(runs.where("false"), 5).collect() == []
