"""Main text of pages, whole small pages by hand."""

import pytest
from pyspark.sql import functions as F

from llm import html_text
from llm.html_text import main_text

PARAGRAPHS = "".join(f"<p>Paragraph {i} tells the story in a sentence of some length.</p>" for i in range(4))
STORY = " ".join(f"Paragraph {i} tells the story in a sentence of some length." for i in range(4))
LINKS = "<ul>" + "".join(f'<li><a href="/{i}">A link to page {i} with a long title</a></li>' for i in range(20)) + "</ul>"


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("   ", ""), ("just  text", "just text"), ("<p>a<p>b", "a b"),
    ("<script>var t='<p>no</p>'</script><style>p{}</style><!-- no -->", ""),
    ("<article><h1>T</h1><p>Short.</article>", "T Short."),
    ("<article><p>a<b>b</b>c <i>d</i><br>e</article>", "abc d e"),
    ("<article><p>1 &lt; 2 &amp;&amp; 3 < 4 &copy &#65;&#x42; &am</article>", "1 < 2 && 3 < 4 © AB &am"),
    ("<article>a\n\t b&nbsp;c</article>", "a b c"), ("<p>cut <a href='", "cut"), ("<p>x</p></div></span>y", "x y"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></article>", "a b c d e"),
    ("<nav>menu</nav><header>top</header><footer>foot</footer><aside>side</aside><form>form</form>", ""),
    ("<p hidden>gone<p style='display:none'>gone<p aria-hidden=true>gone<p>kept", "kept"),
])
def test_small_pages(source, text):
    assert main_text(source) == text


def test_density_finds_the_story_without_an_article():
    page = f"""<html><body><div class=wrap><div>{LINKS}</div><div><h1>The title of it</h1>{PARAGRAPHS}</div>
        <div>{LINKS}</div></div><div><a href=x>imprint</a></div></body></html>"""
    assert main_text(page) == "The title of it " + STORY


def test_a_second_part_over_the_threshold():
    page = f"""<body><div><div>{PARAGRAPHS}</div><div>{LINKS}</div><div>{PARAGRAPHS.replace('Paragraph', 'Section')}</div></div>"""
    assert main_text(page) == STORY + " " + STORY.replace("Paragraph", "Section")


def test_named_noise_goes_and_layout_classes_stay():
    page = f"""<body class="has-sidebar menu-open"><div class="page with-comments sidebar-left"><div id="cookieNotice">{PARAGRAPHS}</div>
        <main><article class="post"><h2>Head</h2>{PARAGRAPHS}<div class="share-bar">share this</div>
        <section id="comments"><p>{STORY}</p></section></article></main>
        <div role="complementary">{PARAGRAPHS}</div></div></body>"""
    assert main_text(page) == "Head " + STORY


def test_an_article_beats_longer_text_beside_it_only_if_alone():
    page = f"<div><p>{STORY}</p><p>{STORY}</p><article>Short news</article></div>"
    assert main_text(page) == "Short news"
    two = f"<div><article>{PARAGRAPHS}</article><article>{PARAGRAPHS}</article></div>"
    assert main_text(two) == STORY + " " + STORY


def test_deep_and_long_pages():
    assert main_text("<div>" * 50_000 + "deep") == "deep"
    assert main_text("<p><b>x" * 20_000) == " ".join(["x"] * 20_000)
    assert main_text("<a '\"=" * 20_000 + "x") == ""


def test_rows(spark):
    rows = [(1, "u", f"<article>{PARAGRAPHS}</article>"), (1, "u", f"<article>{PARAGRAPHS}</article>"), (None, None, "<p>a &eacute;"),
            (2, None, None), (3, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.select("*", *[F.lit(7).alias(c) for c in ("text", "n_chars", "column")])
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "u", STORY, len(STORY))] * 2 + [(None, None, "a é", 3), (2, None, "", 0), (3, "v", "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0
    for row in rows:
        assert html_text.extract(spark.createDataFrame([row], "page_id long, url string, html string")).count() == 1
