"""Names and headings that look like boilerplate do not decide alone; extra columns change nothing."""

import pytest

from loomseq.llm import html_text

W = lambda n, w="word": " ".join([w] * n)
TOP = f"<h1>Title</h1><p>{W(60)}</p>"
CASES = {
    "discussion": (f"<section><h2>Discussion</h2><p>{W(80, 'more')}</p></section>", f"Discussion {W(80, 'more')}"),
    "market share": (f"<div class='market-share'><p>{W(80, 'more')}</p><p>{W(60, 'and')}</p></div>", f"{W(80, 'more')} {W(60, 'and')}"),
    "social history": (f"<blockquote class='social-history'><p>{W(40, 'more')}</p></blockquote>", W(40, "more")),
    "social links": ("<div class='social-share'><a>x</a> <a>y</a></div>", ""),
    "cookies": (f"<div class='cookie-notice'>{W(40, 'more')}</div>", ""),
    "reader comments": (f"<div><h3>Comments (3)</h3><div><p>{W(40, 'more')}</p></div></div>", ""),
    "counted discussion": (f"<div><h3>Discussion (12)</h3><div><p>{W(40, 'more')}</p></div></div>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_inside_an_article(name):
    part, want = CASES[name]
    got = html_text.main_text(f"<body><nav><a>x</a></nav><article>{TOP}{part}</article><footer>end</footer>", html_text.grown())
    assert got == f"Title {W(60)} {want}".strip()


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, "u", f"<article>{TOP}</article>", "text", 9), (2, None, None, "t", None), (1, "u", f"<article>{TOP}</article>", "text", 9)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r.page_id, r.url or "", r.text, r.n_chars) for r in html_text.extract(df).collect())
    text = f"Title {W(60)}"
    assert got == [(1, "u", text, len(text))] * 2 + [(2, "", "", 0)]
