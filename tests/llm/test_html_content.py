"""Main text of pages: marked parts go, all of the article stays."""

from tidemark.llm import html_content, queries

ARTICLE = "<h1>Head</h1><p>One <b>bo</b>ld, and\n two.<br><p>Three &amp;&lt;p&gt; &#233;; four, five.</p><p>Six.</p>"
TEXT = "Head One bold, and two. Three &<p> é; four, five. Six."


def test_parts_that_go():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header><p>Site, name.</p></header><nav><ul><li><a href=/>Menu</a></ul></nav><!-- <p>no</p> -->"
        "<div class='ad-box'>Buy, now.</div><div class=\"cookie-notice\">We, use.</div>"
        f"<article>{ARTICLE}<form><p>Mail, please.</p></form><aside>More, here.</aside></article>"
        "<section id=comments><p>First, comment by a reader.</p></section><footer>&copy; us.</footer>"
    )
    assert html_content.main_text(page) == TEXT
    assert html_content.main_text(page + "</body></html>") == TEXT


def test_without_marks_the_ratios_decide():
    body = "".join(f"<p>A long sentence, number {i}, with words; and more of them, until it ends.</p>" for i in range(9))
    links = "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(30))
    page = f"<html><body><div><ul>{links}</ul></div><div><h2>Head</h2>{body}<p>End.</p></div><div>Top</div></body></html>"
    text = html_content.main_text(page)
    assert text.startswith("Head A long sentence, number 0,") and text.endswith("ends. End.") and "Link" not in text


def test_hard_pages(spark, tmp_path):
    long = "<article>" + "<p>Words, and more words.</p>" * 20_000 + "</article>"
    rows = [
        (1, "u", None),
        (2, None, ""),
        (3, "u", "<nav>menu</nav>"),
        (4, "u", "plain < text, no tags"),
        (5, "u", "<p>open <!-- never closed <p>x"),
        (5, "u", "<p>open <!-- never closed <p>x"),
        (None, "u", f"<article>{ARTICLE}"),
        (6, "u", "</p></div><div><div><p>Stray, tags.</b></div>"),
        (7, "u", long),
        (8, "u", "<div " * 2000 + "a='" + "<p>\x00</p>"),
        (9, "u", "<script>only"),
    ]
    rows = [(*r, "clash", 1) for r in rows]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string, k0 int").write.parquet(
        f"{tmp_path}/pages.parquet"
    )
    got = queries.op2_html_content(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    text = {r.page_id: r.text for r in got}
    assert [text[i] for i in (1, 2, 3, 9)] == [""] * 4
    assert text[4] == "plain < text, no tags" and text[5] == "open" and text[None] == TEXT
    assert text[6] == "Stray, tags." and text[7] == " ".join(["Words, and more words."] * 20_000)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op2_html_content(spark, str(tmp_path)).count() == 0


def test_sections_of_unequal_length():
    long, short = "Words, and more of them. " * 16, "A short part, of two clauses."
    both = f"<h1>H</h1><div><p>{long}</p></div><div><p>{short}</p></div>"
    want = f"H {long.strip()} {short}"
    menu = "<div><ul><li>One<li>Two<li>Three<li>Four</ul></div>"
    for page in (
        f"<article>{both}</article>",
        f"<main><section>{both}</section></main>",
        f"<html><body>{both}</body></html>",
        f"<html><body>{menu}<div>{both}</div></body></html>",
    ):
        assert html_content.main_text(page) == want
    cells = f"<article><table><tr><td><p>{long}</p><td><p>{short}</p></table><div>End</div></article>"
    assert html_content.main_text(cells) == f"{long.strip()} {short} End"
