import html
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import page_diff, queries
from caseflow.llm.page_diff import page_lines, shared_lines

SF = "/root/testdata/sf0.01"


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def is_subsequence(xs, ys):
    it = iter(ys)
    return all(x in it for x in xs)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14), st.sampled_from([1, 8, 1 << 20]))
def test_shared_lines_are_a_longest_common_subsequence(a, b, bits):
    taken = [a[i] for i in sorted(shared_lines(a, b, bits))]
    assert is_subsequence(taken, b) and len(taken) == lcs_length(a, b)


def test_long_pages():
    a = [f"x{i % 7}" for i in range(30_000)]
    assert len(shared_lines(a, a[100:] + ["y"])) == 29_900
    assert page_lines("<a" * 50_000) == [(page_diff.PLAIN, "<a" * 50_000)]
    assert len(page_lines("<p>x" * 50_000)) == 50_000
    assert page_lines("<!--" * 50_000) == []


def test_blocks_and_furniture():
    source = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li>Menu</ul></nav><div class="ad-box">Buy</div><!-- <p>no</p> --><div id=cookie-notice><p>We use</div>
    <article><header>Site</header><h1>A &amp; B</h1><p>one <b>two</b><br>three&nbsp;four<p title="a > b">five<div class="comments"><p>nice!</div>
    <form>name</form><aside>more</aside><p>6 &lt; 7 &am x</article><footer>&copy; me</footer></body></html>"""
    lines = page_lines(source)
    assert [t for place, t in lines if place == page_diff.ARTICLE] == ["A & B", "one two three four", "five", "6 < 7 &am x"]
    assert page_lines(None) == [] and page_lines("") == [] and page_lines("plain &amp; text") == [(page_diff.PLAIN, "plain & text")]


def truth(source):
    body = re.search(r"<article>(.*?)</article>", source, re.S)
    parts = re.split(r"</?(?:h1|p)>", body[1] if body else "")
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " , re.sub("</?b>", "", x))).split()) for x in parts]
    return "\n".join(x for x in parts if x)


def test_query_against_the_pages_own_structure(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op10_page_text(spark, SF).collect()
    assert len(got) == len(pages)
    whole = {k for k, p in pages.items() if p.html and "</article>" in p.html}
    assert len(whole) > 0.9 * len(pages)
    for r in got:
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
        if r.page_id in whole:
            assert r.text == truth(pages[r.page_id].html)


def brute(rows):
    """Pages in order, each against its nearer neighbour."""
    def key(r):
        place = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", r[1] or "")
        place = re.split(r"[?#]", place)[0]
        host = re.split(r"[/:]", place)[0].lower()
        return host, (place[place.index("/"):] if "/" in place else "").rstrip("/")

    rows = sorted(rows, key=lambda r: (*key(r), r[1] is not None, r[1] or "", r[0]))
    out = []
    for i, r in enumerate(rows):
        host, path = key(r)
        near = [rows[j] for j in (i - 1, i + 1) if 0 <= j < len(rows) and key(rows[j])[0] == host]
        near.sort(key=lambda o: -page_diff._nearness(path, key(o)[1]))
        out.append((r[0], page_diff.main_text(page_lines(r[2]), page_lines(near[0][2]) if near else None)))
    return sorted(out)


def test_pairs_do_not_depend_on_ranges(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(120):
        host = "hot.example" if i % 2 else f"h{i % 9}.example"
        site = [f"site {host} {k}" for k in range(4)]
        lines = site[:2] + [f"own {i} {rnd.random()}"] + (["Section"] if i % 3 else []) + site[2:]
        rows.append((i, f"http://{host}/{rnd.choice('abc')}/{rnd.randrange(500)}.html?x={i}", "".join(f"<p>{x}" for x in lines)))
    rows += [(200, None, "<p>a"), (201, None, None), (202, "http://one.example", ""), (203, "HTTP://One.Example:80/x", "<p>alone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = brute(rows)
    assert any("site" not in t and "own" in t for _, t in want)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "5", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted((r.page_id, r.text) for r in page_diff.extract_text(df).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert page_diff.extract_text(df.limit(0)).count() == 0


def test_repeated_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "http://a.b/x", "<p>t<p>u", "h"), (1, "http://a.b/x", "<p>t<p>u", "h"), (None, "http://a.b/y", "<article><p>t</article>", None)], "page_id long, url string, html string, host string")
    got = sorted(((r.page_id, r.text) for r in page_diff.extract_text(df).collect()), key=str)
    assert got == [(1, ""), (1, ""), (None, "t")]


def test_broken_markup_is_linear():
    for part in ("<!", "<?", "<!--", "</b>", "</p>", "<p", "<a ", "<a x='", "<div>", "<script>", "a" * 50 + "<", "<" + "a" * 50, "&amp", "<li><p>"):
        source = part * (1_000_000 // len(part))
        began = time.process_time()
        page_lines(source)
        assert time.process_time() - began < 10, part
    began = time.process_time()
    page_lines("<" + "a" * 1_000_000)
    page_lines("<div>" * 100_000 + "</span>" * 100_000)
    assert time.process_time() - began < 10


def test_unclosed_and_unmatched():
    assert page_lines("a<p>b<!DOCTYPE c") == [(page_diff.PLAIN, "a"), (page_diff.PLAIN, "b")]
    assert page_lines("<div>a</section>b</div></div>c") == [(page_diff.PLAIN, x) for x in "abc"]
    assert page_lines("<article>a</main>b</article>c") == [(page_diff.ARTICLE, "a"), (page_diff.ARTICLE, "b"), (page_diff.PLAIN, "c")]
