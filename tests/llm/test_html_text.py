import pytest

from wardline.llm.html_text import extract, render

CASES = {
    "blocks": ("<h1>A</h1><div>b</div><div>c</div><p>d<p>e", "A\n\nb\nc\n\nd\n\ne"),
    "lists": ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>x", "- a\n- b\n  3. c\n  4. d\n\nx"),
    "table": ("<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td colspan=2>all<tr><td>x<td>10</table>", "Name       Qty\nApple pie  3\nall\nx          10"),
    "rowspan": ("<table><tr><td rowspan=2>Z<td>1<tr><td>22</table>", "Z  1\n   22"),
    "hidden": ("<head><title>t</title></head><p hidden>a</p><p style='display: NONE'>b</p><div style='visibility:hidden'>c<b style='visibility:visible'>d</b></div><script>e</script><template>f</template>g", "d\ng"),
    "pre": ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"),
    "entities": ("a &amp; b&nbsp;&#65; 1 < 2 &unknown;", "a & b\xa0A 1 < 2 &unknown;"),
    "space": ("  a\n\t b <b> c</b> ", "a b c"),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "details": ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
    "quotes": ("<a title='a>b' href=it's>x</a>", "x"),
    "raw text": ("<script>if (a</b>) '<p>'</script><style></p></style><textarea><p>1\n2</textarea>", "<p>1\n2"),
    "stray": ("</td></div><td>a</p>b<tr>c", "a\n\nbc"),
    "unfinished": ("a<b>b<!-- c", "ab"),
    "unfinished tag": ("a<p class='x", "a"),
    "blockquote": ("<blockquote>a<p>b</blockquote>c", "    a\n\n    b\n\nc"),
}


@pytest.mark.parametrize("name", CASES)
def test_render(name):
    source, want = CASES[name]
    assert render(source) == want


def test_no_markup_is_too_deep_or_slow():
    assert render("<b>" * 100_000 + "x") == "x"
    assert render("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    for source in ("<a " * 100_000, "<" * 100_000, "</p>" * 20_000, "<table><tr><td>" * 500, "&" * 100_000, "<!" * 50_000, "<td colspan=999999>" * 100):
        render(source)
    wide = render("<table>" + "<tr><td>" + "x" * 10_000 + "<td>y" + "<tr><td>a<td>b" * 1000 + "</table>")
    assert len(wide) < 20_000


def test_every_word_outside_hidden_elements_is_there(spark):
    import re
    from html import unescape

    rows = extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert rows
    for r in rows:
        body = re.sub(r"(?s)<(script|style|title)\b.*?</\1>|<!--.*?-->", " ", r["html"])
        plain = unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert sorted(plain) == sorted(w for w in r["text"].replace("\n- ", "\n").split() if w != "-")


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "<p>a", "k"), (3, "<p>a", "k"), (None, "<p>b", None)], "page_id long, html string, TEXT string")
    out = extract(df)
    assert len(out.columns) == 3 and sorted((r[0] or 0, r[2]) for r in out.collect()) == [(0, "b"), (1, ""), (2, ""), (3, "a"), (3, "a")]
    assert extract(df.limit(0)).count() == 0
