import random
import time

import pytest

from conftest_llm import SF, prose
from ledgerlark.llm import pages
from ledgerlark.llm.registry import QUERIES

RUNNING = "The reader of this page will find that it is about the ways in which a text can be told from all that stands around it."


def test_blocks_keep_what_stands_in_them():
    found = pages.blocks("<p>One <b>bo</b>ld &amp; <i>two\n\t three</i>&nbsp;&#233;&lt;p&gt; &copy<p>next<br>line</P><div>a < b <3 <a href='x'>li nk</a>")
    assert [b.text for b in found] == ["One bold & two three é<p> ©", "next line", "a < b <3 li nk"]
    assert [b.links for b in found] == [0, 0, 5]


@pytest.mark.parametrize("noise", [
    "<nav><ul><li><a href=/a>Alpha</a><li><a href=/b>Beta</a></ul></nav>", "<header><h1>Site of all</h1></header>",
    f"<footer>&copy; x.com &middot; {RUNNING}</footer>", f"<aside><p>{RUNNING * 3}</p></aside>", f"<div class='ad'>{RUNNING * 3}</div>",
    f'<div id="cookie-banner" role=alert><div><p>{RUNNING * 3}</p></div></div>', f"<form action=/s><label>{RUNNING}</label><input name=q></form>",
    f"<script>var t='<p>{RUNNING}</p>';</script>", f"<style>p{{content:'{RUNNING}'}}</style>", f"<!-- <p>{RUNNING}</p> -->",
    f"<section id=comments><h3>Comments</h3><article><p>{RUNNING * 4}</p></article></section>", f'<div class="postComments"><p>{RUNNING * 4}</p></div>',
    f"<div hidden><p>{RUNNING * 3}</p></div>", f"<div style='display: none'>{RUNNING * 3}</div>", "<ul><li><a href=1>Read this</a><li><a href=2>And that</a></ul>"])
@pytest.mark.parametrize("container", ["article", "main", "div"])
def test_noise_around_and_inside_goes(noise, container):
    text = [RUNNING * 3, "Yes.", RUNNING * 4, "No, not at all.", RUNNING * 2]
    body = "".join(f"<p>{t}</p>" for t in text)
    want = "\n\n".join(text)
    inside = "".join(f"<p>{t}</p>" for t in text[:3]) + noise + "".join(f"<p>{t}</p>" for t in text[3:])
    for page in (f"<html><head><title>t</title></head><body>{noise}<{container}>{body}</{container}>{noise}</body></html>",
                 f"<body>{noise}<{container}>{body}</{container}>"):
        assert pages.main_text(page) == want
    if not noise.startswith("<header") or container == "div":      # an article may have a header of its own
        assert pages.main_text(f"<body><{container}>{inside}</{container}></body>") == want


@pytest.mark.parametrize("page,want", [
    ("<article>Sthe.</article>", "Sthe."),
    ("<article><h1 id='related-work'>Related</h1><p>x</p></article>", "Related\n\nx"),
    ("<div class='has-sidebar'><article><p>ok</p></article></div>", "ok"),
    (f"<form id=page><div><article><p>{RUNNING}</p></article></div></form>", RUNNING),
    (f"<div class=menu><main><p>{RUNNING}</p></main></div><p>{RUNNING}</p>", RUNNING),
    ("<article><p title='a > b' class=x>quoted</p><p>un<a href=\"y>closed</p></article>", "quoted\n\nunclosed"),
    ("<article><a href=/x><p>never closed</article><p>after", "never closed"),
    (f"<div><p>{RUNNING * 3}</p><p>and that is it</p><ul><li><a href=1>l</a></ul><p>other</p></div>", RUNNING * 3 + "\n\nand that is it"),
    ("<article><table><tr><td>one<td>two<tr><td>three</table></article>", "one\n\ntwo\n\nthree"),
    ("<p>too short to tell</p>", ""), (None, ""), ("", ""), ("  \n", ""), ("<!-- open", ""), ("<article><script>x", ""),
    ("<article><p>kept<!-- a --> whole</p><![CDATA[gone]]><svg><text>no</text></svg></article>", "kept whole"),
    ("<ARTICLE><P>loud<SCRIPT>x</sCript ></P></ARTICLE>", "loud")])
def test_pages(page, want):
    assert pages.main_text(page) == want


def test_text_in_no_known_language_is_kept_by_length():
    words = " ".join(f"zxq{n}" for n in range(60))
    assert pages.main_text(f"<div><p>{words}</p><p>zxq</p><p>{words}</p></div><ul><li><a href=1>zxq</a></ul>") == f"{words}\n\nzxq\n\n{words}"


@pytest.mark.parametrize("unit", ["<", "<a href=\"", "<p", "<div>", "</div>", "<!--", "<a ='", "&", "<script>", "<li><a href=x>y", "<p>a</p>", "<x ="])
def test_time_grows_with_the_page(unit):
    def seconds(n):
        start = time.perf_counter()
        pages.main_text("<article>" + unit * n)
        return time.perf_counter() - start
    seconds(1000)
    assert seconds(80_000) < 0.2 + 16 * seconds(10_000)


def test_random_articles_come_back(spark):
    rng, rows, want = random.Random(3), [], {}
    for n in range(60):
        text = [prose(rng, rng.choice([1, 3, 20, 200])) for _ in range(rng.randint(1, 12))]
        marked = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}<br></p>"]).format(t.replace("&", "&amp;")) for t in text)
        rows.append((n, f"http://x/{n}", f"<html><body><nav><a href=1>Home</a></nav><article>{marked}</article><footer>© all</footer>", n))
        want[n] = "\n\n".join(text)
    rows += [(100, None, None, None), (101, "u", "", 0), (102, "u", "<article><p>" + "long " * 100_000, 0), (None, "u", "<main>x</main>", 1), (7, *rows[7][1:])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, `n_chars` long").repartition(3)
    found = pages.extract_text(df).collect()
    assert len(found) == len(rows) and df.count() == len(rows)
    for r in found:
        assert r["n_chars"] == len(r["text"])
        expected = want.get(r["page_id"], {100: "", 101: "", 102: ("long " * 100_000).strip(), None: "x"}.get(r["page_id"]))
        assert r["text"] == expected
    assert pages.extract_text(df.limit(0)).collect() == []
    renamed = pages.extract_text(df.withColumnRenamed("html", "text").drop("n_chars"), html="text").columns
    assert renamed == ["page_id", "url", "text", "n_chars"]


def test_query_on_the_tables(spark):
    import re
    from html import unescape

    found = {r["page_id"]: r for r in QUERIES["op11_html_text"](spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(found) == len(table)
    for r in table:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<b>", "").replace("</b>", "")
        parts = (" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert found[r["page_id"]]["text"] == "\n\n".join(p for p in parts if p)
        assert found[r["page_id"]]["url"] == r["url"]
