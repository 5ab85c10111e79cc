"""Operators 3 and 8."""

import hashlib
import random

from tests.conftest import SF_SMALL
from watchtally.llm import html, queries, warc


def test_layout():
    page = ("<head><title>T</title><style>x</style></head><p>a<p>b<ul><li>x<li>y<ol start=3><li>q<li>r</ol></ul>z"
            "<table><tr><td>a<td>bbb<tr><th>cccc<td>d</table>t<b>u</b> v<br>w <span style='display: none'>no</span>"
            "<div hidden>no</div><!-- no --><pre> a\n  b</pre>&amp;&lt;<dl><dt>T<dd>D</dl>")
    assert html.to_text(page) == "T\n\na\n\nb\n\n- x\n- y\n  3. q\n  4. r\n\nz\n\na     bbb\ncccc  d\n\ntu v\nw\n\n a\n  b\n\n&<\n\nT\n    D"


def test_cells_that_span_rows():
    page = "<table><tr><td rowspan=2>aa<td>b1<td>c1<tr><td>b2<td>c2<tr><td>a3<td colspan=2 rowspan=0>wide<tr><td>a4<td>x</table>end"
    assert html.to_text(page) == "aa  b1  c1\n    b2  c2\na3  wide\na4          x\n\nend"
    assert html.to_text("<table><tr><td rowspan=9>a<td>b<td rowspan=2>c<tr><td>d<tr><td>e<td>f</table>") == "a  b  c\n   d\n   e  f"


def test_style_sheets_and_white_space():
    page = "<style>/* .y{display:none} */ .h, p#x.k { color: red; display:none } i{visibility:hidden} .s{display:none}.s{display:block} @media print{.m{display:none}} .a .b{display:none}</style>"
    page += "<p class='k h'>no<p id=x class='k z'>no<p id=x>one<i>no</i><b class=s>two</b><b class=m>three</b><div class=a><span class=b>four</span></div><u class=h style='display:inline'>five</u><b class=y>six</b>"
    assert html.to_text(page).split() == ["onetwothree", "four", "fivesix"]
    assert html.to_text("<div style='white-space: pre'>a  b\n  c</div><div style='white-space:pre-wrap'> x</div><pre>p <b style='white-space:normal'>q\n r</b></pre>") == "a  b\n  c\n x\n\np q r"
    assert html.to_text("<style>.h{display:none</style><p class=h>unclosed rule shows") == "unclosed rule shows"


def test_every_visible_word_is_kept():
    rng = random.Random(2)
    tags = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<li>", "<ul>", "</ul>", "<div>", "</div>", "<pre>", "</pre>", "<b>", "</b>", "<dd>", "<br>", "<th colspan=2>", "<blockquote>", "</blockquote>"]
    for _ in range(500):
        words, parts = [], []
        for k in range(rng.randrange(40)):
            if rng.random() < 0.4:
                words.append(f"w{k}")
                parts.append(f" w{k} ")
            else:
                parts.append(rng.choice(tags))
        got = html.to_text("".join(parts)).replace(">", " ").split()
        assert sorted(x for x in got if x.startswith("w")) == sorted(words)


def test_broken_pages_never_fail():
    rng = random.Random(3)
    bits = ["<p>", "<table>", "<", "&", "<!--", "-->", "<script>", '"', "'", ">", "<a href=\"x", "x", "</", "<![CDATA[", "]]>", "&#xD800;", "&#999999999;"]
    for _ in range(2000):
        html.to_text("".join(rng.choice(bits) for _ in range(rng.randrange(50))))
    assert html.to_text(None) == html.to_text("") == ""
    assert html.to_text("<div>" * 3000 + "deep") == "deep"


def test_formulas_drawings_and_fallbacks_are_visible():
    assert html.to_text("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow>"
                        "<annotation encoding='t'>x=\\frac</annotation></semantics></math> holds") == "so x= 1 2 holds"
    page = "<p>a<svg><title/><title>no</title><desc>no</desc><metadata>no</metadata><defs><text>no</text></defs><defs/><g><path d='M0'/><text>one</text><text>two <tspan>more</tspan></text></g></svg>b"
    assert html.to_text(page) == "a\none\ntwo more\nb"
    assert html.to_text("<svg><g display='none'><text>no</text></g><foreignObject><p>yes</p></foreignObject></svg>") == "yes"
    assert html.to_text("<object data=x><param name=a>fall <b>back</b></object><noscript><style>no</style>needs script</noscript>") == "fall backneeds script"
    assert html.to_text("<svg><defs><g><p>after an unclosed drawing") == "after an unclosed drawing"
    assert html.to_text("<iframe>no</iframe><template>no</template><datalist><option>no</datalist>yes") == "yes"


def test_hidden_elements_below_the_depth_limit():
    for depth in (0, 150, 199, 200, 201, 300, 5000):
        page = "<div>" * depth + "<div hidden>no<div>no</div>no</div><p style='display:none'>no</p><script>no</script>yes<table><tr><td>a<td>b</table>" + "</div>" * depth + "end"
        assert html.to_text(page).split() == ["yes", "a", "b", "end"], depth
    assert html.to_text("<div hidden>" + "<div>" * 400 + "</div>" * 400 + "no</div>yes") == "yes"
    assert html.to_text("<div>" * 60_000 + "x" + "</div>" * 60_000) == "x"


def test_extract_query(spark):
    got = queries.op3_html_extraction(spark, SF_SMALL)
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    odd = spark.createDataFrame([(1, None, None, 5), (1, "u", "<p>x", 5), (None, "u", "", 5)], "page_id long, url string, html string, text int")
    assert sorted((r.page_id or 0, r.text) for r in html.extract(odd).collect()) == [(0, ""), (1, ""), (1, "x")]
    assert html.extract(odd.where("false")).count() == 0


LONG = "<p>" + "same payload " * 20
PAGES = [(5, "http://www.b.example.org/x?b=2&a=1", LONG), (3, "https://b.example.org/x?a=1&b=2", LONG), (9, None, LONG), (None, "http://c.example", LONG), (7, "", "tiny"), (8, "http://c.example/", "tiny"),
         (2, "http://[bad", None), (2, "http://d.example/\n%1E", ""), (10, "http://e.example/é", "é" * 60), (11, "http://e.example:8080/", "é" * 60)]


def pages_of(spark):
    return spark.createDataFrame([(*p, "extra", 1) for p in PAGES], "page_id long, url string, html string, digest string, offset int").repartition(3)


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    captures = warc.write_archives(pages_of(spark))
    index = warc.write_index(captures, rows_each=3)
    got = warc.read_records(warc.lookup_all(index, pages_of(spark)), with_payload=True).collect()
    assert len(got) == len(PAGES)
    want = []
    for i, url, page in PAGES:
        data = (page or "").encode()
        same = [j for j, _, q in PAGES if (q or "").encode() == data and j is not None]
        ref = min(same) if len(data) >= 100 and same and min(same) != i else None
        want.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "response" if ref is None else "revisit", ref))
    assert sorted(want, key=str) == sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")
    assert {c["page_id"] for c in warc.lookup(index, "http://B.example.org:80/x?a=1&b=2#f")} == {3, 5}
    assert warc.lookup(index, "http://nowhere.example/") == []


def test_warc_empty(spark):
    none = pages_of(spark).where("false")
    index = warc.write_index(warc.write_archives(none))
    assert warc.read_records(warc.lookup_all(index, pages_of(spark))).count() == 0


def test_warc_query(spark):
    got = {r.page_id: r for r in queries.op8_warc(spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(rows)
    assert all(got[r.page_id].payload_digest == hashlib.sha256((r.html or "").encode()).hexdigest() for r in rows)
