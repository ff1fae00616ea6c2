"""Article text: nesting, quotes, paragraphs, against a plain scanner with a stack."""

import random
import re

import pytest

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep.functions import html

PAGES = {
    "<article>one<article>inner</article>two</article>three": "one\n\ninner\n\ntwo",
    "<article>a<article>b<article>c</article></article>d<article>e</article></article><article>f</article>": "a\n\nb\n\nc\n\nd\n\ne",
    "<article>one<article>inner</article>two": "one\n\ninner",
    '<article><a title="a > b">one</a> two</article>': "one two",
    "<article><a title='a > b' href=\"</article>\">one</a></article>": "one",
    '<a title="<article>no">x</a><article>yes</article>': "yes",
    "<article><p>one</p><p>two<br>three</p> <ul><li>x</li><li>y</li></ul>end</article>": "one\n\ntwo\nthree\n\nx\n\ny\n\nend".replace("x\n\ny", "x\ny"),
    "<article>in<b>lin</b>e <i>and</i> <!-- c -->more</article>": "inline and more",
    "<article><table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table></article>": "1 2\n3",
    "<article>it isn't <p class=x>un\"quoted</p> a=\"b > c\" end</article>": "it isn't\n\nun\"quoted\n\na=\"b > c\" end",
    "<article>x<script>if (a<b) '</article>'</script>y<style>p>a{}</style>z</article>": "xyz",
    "<article>\x01p\x02 \x03 a\x04b &#3; &#10;c</article>": "p ab \x03 \nc",
    "<ARTICLE\nCLASS = 'a>b'\n>T<P/>U</ARTICLE >": "T\n\nU",
    "<articles>no</articles><article>yes</article>": "yes",
    "<article></article>": "",
    "</article></article><article>x</article>": "x",
}


def texts(spark, pages, **options):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r["text"] for r in op.extract_article(df, **options).orderBy("i").collect()]


def test_articles_with_nesting_quotes_and_breaks(spark):
    got = dict(zip(PAGES, texts(spark, PAGES), strict=True))
    assert got == PAGES


def test_null_page(spark):
    assert texts(spark, [None, "<article>x</article>"]) == [None, "x"]
    df = spark.createDataFrame([(None,)], "html string")
    assert df.select(fn.page_title("html"), fn.article_text("html")).first() == (None, None)


def plain(page):
    """Character by character, with a stack of open articles."""
    marks, i, low = [], 0, page.lower()
    while i < len(page):
        hidden = next((h for h in (("<!--", "-->"), ("<script", "</script>"), ("<style", "</style>")) if low.startswith(h[0], i)), None)
        if hidden:
            end = low.find(hidden[1], i + len(hidden[0]))
            i = len(page) if end < 0 else end + len(hidden[1])
            continue
        name = re.match(r"</?[a-z][a-z0-9]*", low[i:])
        if name:
            j, quote = i + name.end(), None
            while j < len(page) and (quote or page[j] not in "<>"):
                if quote:
                    quote = None if page[j] == quote else quote
                elif page[j] in "\"'" and page[:j].rstrip().endswith("="):
                    quote = page[j] if page.find(page[j], j + 1) >= 0 else None
                j += 1
            if j < len(page) and page[j] == ">":
                marks.append(("tag", name[0][1:]))
                i = j + 1
                continue
        marks.append(("text", page[i]))
        i += 1
    open_, first, last = [], None, None
    for at, (kind, value) in enumerate(marks):
        if kind == "tag" and value == "article":
            open_.append(at)
            first = at if first is None else first
        elif kind == "tag" and value == "/article" and open_:
            open_.pop()
            last = at
            if not open_:
                break
    if last is None:
        return ""
    out = []
    for kind, value in marks[first:last]:
        tag = value.lstrip("/")
        out.append(value if kind == "text" else "\x03" if tag in html.PARAGRAPHS.split() else "\x04" if tag in html.LINES.split() else "")
    lines = []
    for paragraph in re.sub(r"[ \n]+", " ", "".join(out)).split("\x03"):
        lines.append("\n".join(line for line in (x.strip() for x in paragraph.split("\x04")) if line))
    return "\n\n".join(p for p in lines if p)


@pytest.mark.parametrize("seed", range(4))
def test_generated_pages_against_a_plain_scanner(spark, seed):
    r = random.Random(seed)
    bits = ["<article>", "</article>", "<article class='x>y'>", '<p a="1">', "</p>", "<br>", "<li>", "<b>", "</b>", "word", " ", "\n", "a < b", "x > y", "<!-- <article> -->",
            "<script>'</article>'</script>", "<style>a>b</style>", '<i t="</article>">', "it's", 'q="', "=", "<", "<1", "</", "<img alt='it>s' src=x>"]
    pages = ["<article>" * r.randint(0, 1) + "".join(r.choice(bits) for _ in range(r.randint(1, 40))) + "</article>" * r.randint(0, 2) for _ in range(300)]
    assert texts(spark, pages) == [plain(p) for p in pages]


@pytest.mark.parametrize("bit", ["<br>", "<p>", " <b> ", '<a ="', "<a ='x' ", "<a =", "<article></article>", "<article>", "<!", "&", "<p\n", "</article>", "="])
def test_broken_and_repetitive_pages_take_one_pass(spark, bit):
    page = "<article>" + bit * 200_000 + "</article>"
    assert len(texts(spark, [page, bit * 200_000])) == 2
