"""Layout of rendered pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from docketry.llm.htmltext import extract

CASES = {
    "<p>one<p>two<div>three</div>four": "one\n\ntwo\n\nthree\nfour",
    "a <b>b</b>c<i> d </i> e": "a bc d e",
    "<ul><li>a<li>b<ol start=9><li>x<li>y</ol><li>c</ul>z": "- a\n- b\n  9. x\n  10. y\n- c\n\nz",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n    d\nu",
    "<table><tr><th>Name<th>No<tr><td>x<td>1<tr><td>longer<td>22</table>": "Name    No\nx       1\nlonger  22",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c</table>": "wide cell  z\na  b  c",
    "<td>stray</td> cell": "stray\ncell",
    "<pre>\n a  b\n\n  c</pre>d": " a  b\n\n  c\n\nd",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<p hidden>x</p><p style='display: NONE'>x</p><script>x</script><style>x</style><template>x</template>y": "y",
    "<div style='visibility:hidden'>x <b style='visibility:visible'>y</b></div>": "y",
    "<details><summary>s</summary>x</details><details open><summary>t</summary>u</details>": "s\nt\nu",
    "<title>x &lt; y</title><h1>h</h1>t": "h\n\nt",
    "&lt;&copy;&#233;&amp;amp; &nbsp;|": "<©é&  |".replace("é&", "é&amp;"),
    "<!-- a > b -->x<!-- open": "x",
    "<b>x<p>y</b>z</p>": "x\n\nyz",
    "a <notatag": "a",
    "1 < 2 <> 3": "1 < 2 <> 3",
    "": "",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert extract(html)[1] == CASES[html]


SHOWN = {
    "a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b": "a x=2 b",
    "<math><semantics><mrow><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow><annotation encoding='tex'>no</annotation><annotation-xml><ci>no</ci></annotation-xml></semantics><mspace/></math> end": "1 2 end",
    "<p>a<svg><title>no</title><desc>no</desc><metadata>no</metadata><defs><text>no</text></defs>no<g><circle r='1'/><text>Jan</text><text>Fe<tspan>b</tspan></text></g></svg>z": "a Jan Feb z",
    "<svg><defs/><style/><title/><text><![CDATA[x < y]]></text></svg>": "x < y",
    "<svg><foreignObject><p>one</p><p>two</p></foreignObject><text>a <text>b</text> c</text></svg>": "one\n\ntwo\n\na b c",
    "<svg><text>shown</text><text visibility='x' style='display:none'>no</text></svg> <svg hidden><text>no</text></svg>after": "shown after",
    "<object data='x.swf'><param name='a' value='no'>Get the <b>player</b></object>": "Get the player",
    "<text>plain</text> <annotation>tags</annotation>": "plain tags",
}


@pytest.mark.parametrize("html", SHOWN)
def test_formulas_drawings_and_objects(html):
    assert extract(html)[1] == SHOWN[html]


def test_title_and_null():
    assert extract("<html><head><title> a\n b </title><body>c") == ("a b", "c")
    assert extract(None) == (None, "")


@pytest.mark.parametrize("html", ["<div>" * 50_000 + "x", "<table><tr><td>" * 500 + "x", "<ul><li>" * 500 + "x", "<" * 20_000, '<a "' * 5_000, "<b>" * 5_000 + "x" + "</i>" * 5_000])
def test_deep_and_broken_pages(html):
    assert isinstance(extract(html)[1], str)


class Plain(HTMLParser):
    """All text outside elements that are never shown, by the standard library, without layout."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title", "head")
        self.parts.append(" " if tag in ("p", "li", "div", "h1", "br", "article", "nav", "ul", "footer", "body") else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title", "head")

    def handle_data(self, data):
        self.parts.append("" if self.hidden else data)


def test_no_visible_word_is_lost():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    for html in pages:
        plain = Plain()
        plain.feed(html)
        # Only the markers of list items are added.
        assert [w for w in extract(html)[1].split() if w != "-"] == [w for w in "".join(plain.parts).split() if w != "-"]
