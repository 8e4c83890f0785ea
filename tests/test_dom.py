"""H1 tree-builder rules (pure Python)."""

from leadforge.operators.dom import parse_html


def by_tag(elems, tag):
    return [e for e in elems if e["tag"] == tag]


def test_void_tags_do_not_nest():
    text, _, elems = parse_html("<p>a<br>b<img src=x>c</p>")
    p = by_tag(elems, "p")[0]
    br, img = by_tag(elems, "br")[0], by_tag(elems, "img")[0]
    assert br["end"] == br["id"] and img["end"] == img["id"]
    assert br["parent"] == p["id"] and img["parent"] == p["id"]
    assert text == "abc"


def test_end_tag_closes_to_nearest_and_stray_end_ignored():
    _, _, elems = parse_html("<div><b>x<i>y</div><span>z</span></p>")
    div, b, i, span = (by_tag(elems, t)[0] for t in ("div", "b", "i", "span"))
    assert div["end"] == i["id"]          # </div> closes b and i too
    assert span["parent"] == 0            # after </div>, back at top level


def test_unclosed_tags_close_at_eof():
    _, _, elems = parse_html("<html><body><p>one<p>two")
    ps = by_tag(elems, "p")
    assert ps[1]["parent"] == ps[0]["id"]  # html.parser rules: no implicit </p>
    assert all(e["end"] == len(elems) for e in by_tag(elems, "html"))


def test_script_style_comment_not_text():
    html = '<p>a<script>var t="</p>";</script>b<style>p{}</style><!-- c -->d</p>'
    text, stext, elems = parse_html(html)
    assert text == "abd"
    script = by_tag(elems, "script")[0]
    assert script["raw"] == 'var t="</p>";'
    assert by_tag(elems, "p")[0]["raw"] is None


def test_attrs_last_wins_class_split_and_charrefs():
    _, _, elems = parse_html('<a href="/x" href="/y" class=" a  b\nc" title="A &amp; B" data-v>t&eacute;</a>')
    a = elems[0]
    attrs = dict(a["attrs"])
    assert attrs["href"] == "/y"
    assert a["cls"] == ["a", "b", "c"]
    assert attrs["title"] == "A & B"
    assert attrs["data-v"] == ""


def test_text_offsets_and_stripped_text():
    text, stext, elems = parse_html("<div> x <p> y </p>\n<p>z</p></div>")
    div, p1, p2 = elems
    assert text[div["tf"]:div["tt"]] == " x  y \nz"
    assert stext[div["sf"]:div["st"]] == "xyz"
    assert stext[p1["sf"]:p1["st"]] == "y"
    assert p2["prev"] == p1["id"] and p1["prev"] == 0


def test_subtree_intervals():
    _, _, elems = parse_html("<nav><ul><li><a href='/x'>x</a></li></ul></nav><p>y</p>")
    nav, a, p = by_tag(elems, "nav")[0], by_tag(elems, "a")[0], by_tag(elems, "p")[0]
    assert nav["id"] < a["id"] <= nav["end"]       # a is inside nav
    assert not (nav["id"] < p["id"] <= nav["end"])  # p is not


def test_missing_page():
    assert parse_html(None) == (None, None, None)


def test_string_containers_at_any_depth_are_not_text():
    text, _, elems = parse_html("<p>a<ruby>b<rt>x<b>y</b></rt></ruby><template><i>t</i></template>c</p>")
    assert text == "abc"


def test_script_text_only_from_direct_content():
    _, _, elems = parse_html("<script>var a=1;</script><p>x</p>")
    assert by_tag(elems, "script")[0]["raw"] == "var a=1;"


def test_rejected_markup_is_a_failed_page():
    assert parse_html("<p>ok</p><![;x") == (None, None, None)
    assert parse_html("<![if !IE]><p>x</p><![endif]>")[0] == "x"  # conditional comments parse


def test_rejection_rolls_back_only_that_page():
    from leadforge.operators.dom import _TreeBuilder

    b = _TreeBuilder()
    assert b.page_or_none("<p>one</p>") == ("one", "one")
    assert b.page_or_none("<div><b>x</b><![;x") is None
    assert b.page_or_none("<i>two</i>") == ("two", "two")
    assert b.tag == ["p", "i"] and len(b.attr_off) == 3 and len(b.cls_off) == 3


def test_blank_text_nodes_collapse():
    assert parse_html("<b>Czech</b>   <b>Republic</b>")[0] == "Czech Republic"
    assert parse_html("<b>a</b> \n\t <b>b</b>")[0] == "a\nb"
    assert parse_html("<pre><b>a</b>   <b>b</b></pre><textarea>  </textarea>")[0] == "a   b  "
    assert parse_html("<b>a</b>\xa0\xa0<b>b</b>")[0] == "a\xa0\xa0b"


def test_offsets_count_bytes_and_next_span():
    text, stext, elems = parse_html("<p>é ü</p><i>x</i><span>ß</span><b>y</b>")
    p, i, span, b = elems
    assert text.encode()[span["tf"]:span["tt"]].decode() == "ß"
    assert p["nspan"] == i["nspan"] == span["id"] and span["nspan"] == b["nspan"] == 0
