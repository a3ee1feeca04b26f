"""Any text parses to a well-formed tree."""

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.pages.tree import NODE_FIELDS, parse_page

TAGS = (
    "html head body title style script textarea p div span b i a ul li br img table tr td th tbody "
    "h1 h2 dl dt dd form select option pre article x-y svg"
).split()
token = st.one_of(
    st.sampled_from([f"<{t}>" for t in TAGS]),
    st.sampled_from([f"</{t}>" for t in TAGS]),
    st.sampled_from(
        ["<p class='a b'", "<div id=x>", "<a href=\"y>", "<!--", "-->", "<!doctype html>", "<?x?>", "<", ">",
         "&amp;", "&#xD800;", "&#0;", "</", "<b/>", "\x00", " ", " \n ", "text", "😀", "编辑：", "<DIV>", "</ p>",
         "<td colspan='2'>", "<![CDATA[x]]>", "'", "\""]
    ),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(token, max_size=40).map("".join))
def test_tree_is_well_formed(html):
    rows, pieces = parse_page(html)
    nodes = [dict(zip(NODE_FIELDS, r)) for r in rows]
    assert [n["tag"] for n in nodes[:2]] == ["html", "head"]
    assert sum(n["tag"] == "body" and n["parent"] == 0 for n in nodes) == 1
    for at, n in enumerate(nodes):
        assert n["node"] == at and at <= n["last"] < len(nodes)
        if at:
            parent = nodes[n["parent"]]
            assert parent["node"] < at <= n["last"] <= parent["last"]
            assert n["depth"] == parent["depth"] + 1
            assert n["cut"] or not parent["cut"]
            start, stop = n["first_piece"], n["first_piece"] + n["n_pieces"]
            assert parent["first_piece"] <= start
            assert stop <= parent["first_piece"] + parent["n_pieces"]
        inside = pieces[n["first_piece"] - 1: n["first_piece"] - 1 + n["n_pieces"]]
        assert all(at <= p[0] <= n["last"] for p in inside)
        assert sum(at <= p[0] <= n["last"] for p in pieces) == n["n_pieces"]
        live = " ".join("".join(t for _, cut, t in inside if not cut).split(" ")).strip(" ")
        while "  " in live:
            live = live.replace("  ", " ")
        if not n["cut"]:
            assert n["text_len"] == len(live.encode("utf-16-le")) // 2
    assert all(text for _, _, text in pieces)
