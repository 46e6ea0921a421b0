import hashlib
import html
import re
import time
import zlib

import pytest

from tidecast.llm import html_text, language, pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
ODD = [
    "", None, "a@b", "a@@b.c", "x@y.z@w.v", "a.b@c.d.e. and a@b.c", "..%@-.-", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.2.3.4", "01.002.3.255", "1.2.3.",
    "4539 1488 0343 6467", "4539-1488-0343-6467x", "0000000000000", "1 2 3 4 5 6 7 8 9 0 1 2", "+1 (212) 555-0100", "+12", "+1 (", "+1.2", "++49 30 1234567",
    "é😀 mail: ü@x.de +49 (0)30-1234 5678.", "9" * 30, "1.1.1.1" * 3, "@a.b c@d.e", "a@b.c,d@e.f", "call 0301234567 now", "12 12 12 12 12 12 12",
]


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            g = m.group()
            if kind == "ip" and any(int(p) > 255 for p in g.split(".")):
                continue
            if kind == "card" and not (12 <= len(digits(g)) <= 19 and luhn(digits(g))):
                continue
            if kind == "phone" and not 9 <= len(digits(g)) <= 15:
                continue
            found.append((m.start(), order, kind, m.end()))
    return sorted(found)


def test_base_spans_equal_plain_patterns(make_docs, table):
    docs = [(r["doc_id"], r["text"]) for r in table("documents")] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    got = {r.doc_id: r for r in pii.personal_data(make_docs(docs)).collect()}
    for doc_id, text in docs:
        want = base_spans(text)
        line = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in want)
        row = got[doc_id]
        assert row.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), text
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == s[2] for s in want) for k, _ in PATTERNS]
        assert set(line.split(",")) <= set(row.spans.split(","))
        assert len(row.scores) == len([s for s in row.spans.split(",") if s])


def test_added_kinds_need_a_checksum_or_context():
    kinds = lambda text: [s[0] for s in pii.find(text)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 here") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 here") == []
    assert kinds("her ssn is 123-45-6789") == ["ssn"] and kinds("number 123-45-6789") == []
    assert kinds("phone 030 1234 567") == ["tel"] and kinds("order 030 1234 567") == []


def test_redaction_keeps_columns_and_nulls(make_docs):
    docs = make_docs([(1, "mail a@b.co now"), (2, None), (3, "clean")])
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out == {1: "mail [email] now", 2: None, 3: "clean"}


def article_of(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner))
    return " ".join(b for b in blocks if b)


def test_pages_equal_their_articles(spark, table):
    pages = table("pages", "/root/testdata/sf0.01")
    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("*", "'x' as text", "1 as n_chars")
    got = {r.page_id: r for r in html_text.page_text(frame).collect()}
    for p in pages:
        want = article_of(p["html"])
        assert (got[p["page_id"]].text, got[p["page_id"]].n_chars, got[p["page_id"]].url) == (want, len(want), p["url"])


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain text", "plain text"),
        ("<body><nav><a href=x>Home</a></nav><p>First long paragraph of the page.</p><p>ok</p><footer>f</footer>", "First long paragraph of the page. ok"),
        ("<main><header>h</header><h1>T</h1><p>one&nbsp;&amp;\n two</p><aside>no</aside></main>", "T one & two"),
        ("<article><p>Body te<b>xt</b><img src=a>s here.</p><section class='comments'><p>I like it very much</p></section></article>", "Body texts here."),
        ("<article><p>Body text here.</p><article><p>a reader says</p></article></article><div class=cookie-banner>We use cookies</div>", "Body text here."),
        ("<article><form><p>Name</p></form><script>var a = '<p>no</p>';</script><style>p{}</style><p>Yes.<!-- no --></p></article>", "Yes."),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"),
    ],
)
def test_page_shapes(page, want):
    assert html_text.main_text(page) == want


def test_null_and_repeated_pages(spark):
    frame = spark.createDataFrame([(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in html_text.page_text(frame).collect() if r.page_id) == [(1, "u", "x", 1)] * 2
    assert html_text.page_text(frame.where("false")).count() == 0


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_language_edge_cases(make_docs):
    rows = [(i, f"the cat and the dog number {i}", "en", "s") for i in range(9)] + [(20 + i, f"der hund und die katze nummer {i}", "de", "s") for i in range(9)]
    rows += [(50, None, "en", None), (51, "", "de", None), (52, "123 !!", "en", None), (None, "the dog and the cat", None, None), (54, "漢字", None, None)]
    got = {r.doc_id: (r.lang_pred, r.held_out) for r in language.identify(make_docs(rows)).collect()}
    assert [got[i][0] for i in (50, 51, 52)] == ["und"] * 3 and got[None] == ("en", False) and got[54][0] in ("en", "de")
    assert got[0][0] == "en" and got[20][0] == "de"
    none = {r.lang_pred for r in language.identify(make_docs([(1, "abc"), (2, None)])).collect()}
    assert none == {"und"}
    assert language.recognised(make_docs(rows), [(0, 0.02)]).where("doc_id in (50, 51, 52)").count() == 0


def test_predictions_ignore_the_label(make_docs):
    rows = [(i, f"the cat and the dog number {i}", "en", "s") for i in range(9)] + [(20 + i, f"der hund und die katze nummer {i}", "de", "s") for i in range(9)]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    changed = [(i, t, "xx" if (i, t, lang, s) in held else lang, s) for i, t, lang, s in rows]
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(make_docs(rows)).collect()}
    assert held and one == {r.doc_id: (r.lang_pred, r.score) for r in language.identify(make_docs(changed)).collect()}


def test_long_runs_of_zeros(make_docs):
    texts = ["0" * 5000 + "1.2.3.4", "1." + "0" * 6000 + ".0.7", "1.2.3." + "9" * 5000, "0" * 9000]
    rows = {r.doc_id: r for r in pii.personal_data(make_docs(list(enumerate(texts)))).collect()}
    assert [rows[i].n_ip for i in range(4)] == [1, 1, 0, 0]


ARTICLE = "This is a long sentence of the article, which goes on for a while. " * 6


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'>{}</div>", "<div id=page class='no-sidebar comments-open'><p>{}</p></div>",
        "<article class='post-with-comments ad-free'><p>{}</p></article>", "<div class=sidebar-wrapper><div class=related><p>{}</p></div></div>",
        "<div class=comments><p>{}</p></div><p>short</p>", "<div class='content'><p>{}</p><div class=ad>Buy!</div><div class='site-nav'><a>x</a></div></div>",
        "<article><p>{}</p><div class=comments><p>I think so too, and more of it.</p></div></article>",
    ],
)
def test_names_are_hints_only(page):
    got = html_text.main_text(page.format(ARTICLE))
    assert got.startswith(ARTICLE.strip()) and "Buy" not in got and "think" not in got


def test_paragraphs_and_articles_side_by_side():
    got = html_text.main_text(f"<article><p>{ARTICLE}</p><p class='related-work'>Related work is old.</p><p class=notice>No.</p></article>")
    assert got == ARTICLE.strip() + " Related work is old."
    two = f"<main><article><p>{ARTICLE}</p></article><article><p>{ARTICLE}The second.</p></article></main>"
    assert html_text.main_text(two) == f"{ARTICLE.strip()} {ARTICLE}The second."


@pytest.mark.parametrize("open_", ["<div>", "<div><b>", "<p><span>", "<ul><li>", "<table><tr><td>"])
def test_time_grows_with_the_page_only(open_):
    begin = time.process_time()
    page = open_ * 40_000 + "inmost" + "</i></b></p></em>" * 20_000
    assert html_text.main_text(page) == "inmost"
    assert time.process_time() - begin < 20
