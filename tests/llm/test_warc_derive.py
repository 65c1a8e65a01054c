import html.parser
import json
import re
import time

from hypothesis import given
from hypothesis import strategies as st

from emberfold.llm import warc_derive as wd
from emberfold.llm.common import table

from .conftest import SF

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><meta name="d" content="x > y"><style>p{}</style></head>
<body><script>var t="</p>";</script><!-- no --><nav><ul><li><a href='/a?x=1&amp;y=2'>One</a></li></ul></nav>
<p>Two<br>three <b>bold</b>er &lt;i&gt;</p><img src=pic.png alt="a>b"><div>last</div></body></html>"""


class Text(html.parser.HTMLParser):
    """Text of a page by the standard parser, block elements as line ends."""

    def __init__(self):
        super().__init__()
        self.out, self.skip, self.links = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.skip += 1
        if tag in wd._BLOCKS:
            self.out.append("\n")
        link = dict(attrs).get(wd._LINKS.get(tag, "-"))
        if link:
            self.links.append(link)

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.skip -= 1
        if tag in wd._BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_page_text_and_links():
    assert wd.page_text(PAGE) == "One\nTwo\nthree bolder <i>\nlast"
    found = wd.page_metadata(PAGE)
    assert found["title"] == "A & B" and found["metas"] == [{"name": "d", "content": "x > y"}]
    assert [x["url"] for x in found["links"]] == ["/a?x=1&y=2", "pic.png"]
    assert wd.page_text("") == "" and wd.page_text("<unclosed 'quote") == "<unclosed 'quote"
    assert wd.page_text("<p" * 20_000 + "x") and wd.page_metadata("<a href=" * 20_000) is not None


def test_records_of_all_pages(spark):
    pages = table(spark, SF, "pages")
    by_id = {r.page_id: r for r in pages.collect()}
    responses = {r.page_id: r for r in wd.page_responses(pages).collect()}
    records = wd.warc_files(wd.derive(wd.page_responses(pages), "page_id")).collect()
    assert len(records) == 2 * len(by_id) and len({r.record_id for r in records}) == len(records)
    for r in records:
        page = by_id[r.source]
        parser = Text()
        parser.feed(page.html)
        assert r.refers_to == responses[r.source].record_id and r.target_uri == page.url
        assert r.payload_digest == wd.digest(page.html.encode()) and r.block_digest == wd.digest(r.block)
        [(headers, block)] = wd.read_warc(r.warc)
        assert block == r.block and headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Type"] == r.record_type
        if r.record_type == "conversion":
            lines = [" ".join(x.split()) for x in "".join(parser.out).split("\n")]
            assert block.decode() == "\n".join(x for x in lines if x)
        else:
            data = json.loads(block)
            assert data["http"]["status"] == "HTTP/1.1 200 OK" and data["http"]["headers"][0][0] == "Content-Type"
            assert [x["url"] for x in data["html"]["links"]] == parser.links


def test_odd_responses(spark):
    rows = [("<urn:uuid:1>", None, None, None, None), ("<urn:uuid:2>", "u", "d", "sha1:X", b"\xff no headers")] * 2
    made = wd.derive(spark.createDataFrame(rows, wd.RESPONSE).selectExpr("*", "1 AS source2")).collect()
    assert len(made) == 8
    first = [r for r in made if r.refers_to == "<urn:uuid:1>"]
    assert {r.payload_digest for r in first} == {wd.digest(b"")} and b"Target-URI" not in wd.warc_bytes(first[0].asDict())
    second = next(r for r in made if r.refers_to == "<urn:uuid:2>" and r.record_type == "conversion")
    assert second.payload_digest == "sha1:X" and second.block.decode() == "� no headers"
    nulls = spark.createDataFrame([(1, None, None)], "page_id BIGINT, url STRING, html STRING")
    assert wd.derive(wd.page_responses(nulls), "page_id").count() == 2
    assert wd.derive(spark.createDataFrame([], wd.RESPONSE)).count() == 0


def test_unclosed_elements_take_linear_time():
    for opening in ("<script>", "<!--", "<title>", "<style", "<title", "<p", "<a b=\"", "<p'\""):
        start = time.perf_counter()
        wd.page_text(opening * 100_000 + "end")
        wd.page_metadata(opening * 100_000 + "end")
        assert time.perf_counter() - start < 10, opening
    assert wd.page_text("a<script>b<style>c</style>d") == "ab d"
    assert wd.page_text("<!-- x --><SCRIPT>y</script ><title>t</title>z<!-- open") == "z<!-- open"


def test_responses_without_ids():
    response = {"record_id": None, "target_uri": None, "date": None, "payload_digest": None, "block": b"a"}
    one, other = wd.derive_records(response), wd.derive_records({**response, "block": b"b"})
    assert one == wd.derive_records(response) and one[0]["refers_to"] is None
    assert len({r["record_id"] for r in one + other}) == 4


def test_pages_without_ids(spark):
    pages = spark.createDataFrame([(None, None, "a"), (None, None, "b"), (None, None, None)], "page_id long, url string, html string")
    assert wd.page_responses(pages).select("record_id").distinct().count() == 3


@given(st.lists(st.sampled_from(["<p", "<a href=", "</p", ">", '"', "'", "<!", "<?x", "x", " ", "<"]), max_size=14).map("".join))
def test_tags_as_a_backtracking_free_pattern_finds_them(page):
    whole = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>")
    want = [(m.start(), m.end(), bool(m[1]), (m[2] or "").lower()) for m in whole.finditer(page)]
    assert [t[:4] for t in wd._tags(page)] == want
