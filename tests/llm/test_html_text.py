import random

import pytest

from rankmatch.llm.html_text import extract, page_text


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<title>no</title><p>one<p>two", "one\n\ntwo"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<div>a</div><div>b <b> c</b>d</div>", "a\nb cd"),
        ("<ul><li>x<li>y<ol start=3><li>i<li>j</ol><li>z</ul>", "- x\n- y\n  3. i\n  4. j\n- z"),
        ("<table><tr><th>Name<th>N<tr><td>long one<td>1</table>", "Name      N\nlong one  1"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>x", "a  b\n   c\n\nx"),
        ("<table><caption>Cap</caption><tr><td colspan=2>wide<tr><td>p<td>q</table>", "Cap\nwide\np     q"),
        ("<pre>\n a\n   b</pre>c", " a\n   b\n\nc"),
        ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"),
        ("<style>.x, #y {display:none}</style><i class='a x'>no</i><i id=y>no</i>yes", "yes"),
        ("<script>if (a < b) '</p>'</script><noscript>no</noscript>yes", "yes"),
        ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
        ("<select><option>A<option selected>B</select>", "B"),
        ("1 &lt; 2 &amp;&nbsp;&eacute;", "1 < 2 &\xa0é"),
        ("a < b and <3", "a < b and <3"),
        ("x<!-- no <p> -->y<!---->z", "xyz"),
        ("</p>a</td></li>b", "ab"),
        ("<td>a<td>b", "a\nb"),
        ("<a title='x > y'>t</a> <a href=\"u", "t"),
    ],
)
def test_layout(page, text):
    assert page_text(page) == text


def test_wide_cells_are_padded_for():
    wide = "x" * 100
    assert page_text(f"<table><tr><td>{wide}<td>next<tr><td>a<td>b</table>") == f"{wide}  next\na{' ' * 101}b"


def test_cells_over_many_rows_and_columns():
    rows = "<tr><td>b" * 299
    assert page_text(f"<table><tr><td rowspan=300>a<td>b{rows}</table>").split("\n") == ["a  b"] + ["   b"] * 299
    assert page_text(f"<table><tr><td rowspan=0>a<td>b{rows}</table>").split("\n") == ["a  b"] + ["   b"] * 299
    # A cell does not reach out of its section.
    text = page_text("<table><thead><tr><th rowspan=0>h<th>i<tr><th>j</thead><tbody><tr><td rowspan=9>a<td>b</tbody></table>")
    assert text == "h  i\n   j\na  b"
    assert page_text("<table><tr><td>a<td rowspan=2>b<td rowspan=3>c<tr><td>d<tr><td>e<td>f</table>") == "a  b  c\nd\ne  f"
    cells = "".join(f"<td>{i % 10}" for i in range(150))
    lines = page_text(f"<table><tr>{cells}<td>x<tr><td colspan=150>w<td>x</table>").split("\n")
    assert lines[0].index("x") == lines[1].index("x") == 450


def test_tables_of_wide_spans_stay_small():
    for cell in ("<td colspan=1000>", "<td colspan=1000 rowspan=0>"):
        assert page_text(f"<table><tr>{cell * 20_000}x{'<tr><td>y' * 500}</table>").count("y") == 500


def test_cells_too_wide_to_pad_for_stay_apart():
    wide = "x" * 50_000
    lines = page_text(f"<table><tr><td>{wide}<td>next{'<tr><td>a<td>b' * 1000}</table>").split("\n")
    assert lines == [f"{wide}  next"] + ["a  b"] * 1000


@pytest.mark.parametrize(
    "sheet, text",
    [
        ("@media print{.a{display:none}}", "A B C"),
        ("@media (max-width:600px){.a{display:none}}", "A B C"),
        ("@media screen and (min-width:40em) and (max-width:2000px){.a{display:none}}", "C"),
        ("@media (400px <= width <= 700px), print{.a{display:none}} .b{display:none}", "A C"),
        ("@media not print{.b{display:none}}", "A C"),
        ("@media not (min-width:9999px){@supports (display:grid){.b{display:none}}}", "A C"),
        ("@supports not (display:grid){.a{display:none}}", "A B C"),
        ("@keyframes x{from{visibility:hidden}} @import 'x'; .b{display:none}", "A C"),
        ("/* .a{display:none} */ .b/**/{/*}*/display:none}", "A C"),
        ("i{content:'}.a{display:none}'} .b{display:none", "A C"),
        (".a{display:none} .a{display:block}", "A B C"),
        (".a{display:none!important} .a{display:block}", "C"),
        ("#x{display:none} .a{display:inline}", "C"),
        (".a{display:none} i.a{display:inline}", "A B C"),
        (".a{display:none} .a:hover{display:inline} .z .a{display:inline}", "C"),
        (".a{@media print{display:none}}", "A B C"),
        (".sm\\:on{display:inline} .b{display:none}", "A C"),
        (":not(.a,.b,.c){display:none}", "A B C"),
        ("#x{visibility:hidden} .b{visibility:visible}", "B C"),
    ],
)
def test_style_sheets(sheet, text):
    page = f"<style>{sheet}</style><i class='a' id=x>A <b class='b'>B</b></i> <u>C</u>"
    assert page_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds", "so x=1 2 holds"),
        ("<math><semantics><msup><mi>c</mi><mn>2</mn></msup><annotation>c^2</annotation></semantics></math>", "c 2"),
        ("<math><mphantom><mi>no</mi></mphantom><mspace/><mi>y</mi></math>", "y"),
        ("a<svg><title>no</title><desc>no</desc><g>no<text>A<tspan>B</tspan></text><text>C</text></g></svg>b", "a AB C b"),
        ("<svg><defs><text>no</text></defs><metadata>no</metadata><title/><defs/><rect/><text>yes</text></svg>", "yes"),
        ("<svg><foreignObject><div>in</div></foreignObject></svg>out", "in\nout"),
        ("<svg><switch><foreignObject><p>one</p></foreignObject><text>two</text></switch></svg>", "one"),
        ("<svg/>a<svg><path d='M0 0'>no<p>yes", "a\n\nyes"),
        ("<svg style='visibility:hidden'><text>no</text></svg><text>y</text>es", "yes"),
        ("<map name=m><a href=x>yes</a><area alt=no></map>", "yes"),
        ("<input value=a> <input type=email value=b><input type=hidden value=no><input type=password value=no>", "a b"),
        ("<input type=checkbox value=no><input type=radio value=no>x<input type=submit value=go>", "x go"),
    ],
)
def test_formulas_drawings_maps_and_inputs(page, text):
    assert page_text(page) == text


def test_styles_of_elements_and_of_media():
    assert page_text("<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p>no</div>") == "yes"
    assert page_text("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>") == "  yes"
    assert page_text("<style>.x{display:none!important}</style><i class=x style='display:block'>no</i>yes") == "yes"
    assert page_text("<style>.x{display:none}</style><i class=x style='display:block'>yes</i>") == "yes"
    assert page_text("<style>.x{display:flex}</style><i class=x hidden>yes</i><i hidden>no</i>") == "yes"
    assert page_text("<style media=print>i{display:none}</style><i>yes</i>") == "yes"
    assert page_text("<noscript><style>i{display:none}</style></noscript><i>yes</i>") == "yes"


def test_broken_and_deep_drawings_never_fail():
    rng = random.Random(9)
    parts = ["<svg>", "</svg>", "<text>", "<g/>", "<math>", "<mi>", "</mi>", "<p>", "x", "<foreignObject>", "</table>", "<table>", "<td>"]
    for _ in range(5000):
        page_text("".join(rng.choice(parts) for _ in range(rng.randint(0, 20))))
    assert page_text("<svg>" + "<g>" * 50_000 + "<text>x") == "x" == page_text("<math>" + "<mrow>" * 50_000 + "x")


def test_broken_style_sheets_never_fail():
    rng = random.Random(8)
    parts = ["{", "}", ";", ":", "@media", "(", ")", "print", ".a", "#", "display:none", "/*", "*/", "\"", "@", "\\", "not", "min-width", "<", ","]
    for _ in range(5000):
        page_text("<style>" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) + "</style><i class=a>x")


def test_every_visible_word_stays_in_order():
    rng = random.Random(5)
    tags = "p div ul li table tr td b i h1 section span blockquote dl dt dd thead".split()
    for _ in range(2000):
        parts, words = [], []
        for i in range(rng.randint(0, 25)):
            tag = rng.choice(tags)
            parts.append(rng.choice([f"<{tag}>", f"</{tag}>", f" w{i} "]))
            if parts[-1][0] == " ":
                words.append(f"w{i}")
        shown = [w for w in page_text("".join(parts)).split() if w.startswith("w")]
        # What stands in a table but in no cell comes before its rows.
        assert sorted(shown) == sorted(words)
        if "<table>" not in parts:
            assert shown == words


def test_broken_and_deep_pages_never_fail():
    rng = random.Random(7)
    parts = ["<p", ">", "<", "\"", "'", "</table>", "<td>", "<tr>", "<!--", "<script>", "=", "&#x;", "<pre>", "x", "<select>"]
    for _ in range(5000):
        page_text("".join(rng.choice(parts) for _ in range(rng.randint(0, 20))))
    for page in ("<div>" * 50_000 + "x", "<table><tr><td>" * 300 + "x", "<ul><li>" * 2000 + "x", '<a "' * 30_000):
        page_text(page)


def test_pages(spark):
    rows = [(1, "<p>a", "k"), (2, None, "k"), (2, "", "k"), (None, "<b>x</b>", "k"), (1, "<p>a", "k")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted(map(tuple, extract(pages).collect()), key=repr)
    assert got == sorted([(1, "a", 1), (2, "", 0), (2, "", 0), (None, "x", 1), (1, "a", 1)], key=repr)
    assert extract(pages.limit(0)).count() == 0
