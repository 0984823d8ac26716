"""License scan and template extraction."""

import pytest
from cases import awkward, awkward_rows, empty, in_order, words

from terrace.llm import licenses, templates


def brute_base(text):
    w, places = words(text), []
    for phrase, label in licenses.BASE:
        p = phrase.split(" ")
        places += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    starts = [k for k, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), sorted({label for _, label in places})


def test_base_phrases_match_brute_force(spark):
    docs = awkward(spark)
    found = licenses.license_scan(docs)
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found.collect()]
    assert in_order(got) == in_order((i, *brute_base(t)) for i, t, *_ in awkward_rows())
    assert licenses.license_scan(empty(spark)).count() == 0


@pytest.mark.parametrize(
    "text,spans",
    [
        ("Released under the MIT licence.", [("mit", 1, 4, 1)]),
        ("x under  the/mit license y", [("mit", 1, 4, 0)]),
        ("Apache Lisense, Version 2", [("apache-2", 0, 3, 1)]),
        ("apache licence version 2 and all right reserved", [("apache-2", 0, 3, 1), ("all-rights-reserved", 5, 7, 1)]),
        ("licensed under the GNU general publik license version 3", [("gpl-3", 1, 8, 1)]),
        ("under the gnu general public license version 2", [("gpl-2", 0, 7, 0)]),
        ("cc by nd", []),
        ("", []),
    ],
)
def test_notices_with_edits(text, spans):
    found = licenses.NoticeScanner()(text.encode())
    assert [s[:4] for s in found["spans"]] == spans
    assert found["score"] == (1.0 if found["n_base"] else max((s[4] for s in found["spans"]), default=0.0))


def test_every_edit_within_the_bound_is_found():
    scanner = licenses.NoticeScanner(notices=licenses.NOTICES[:1])
    phrase = licenses.NOTICES[0][0]
    for k in range(1, len(phrase) - 1):
        for changed in (phrase[:k] + "q" + phrase[k:], phrase[:k] + phrase[k + 1 :], phrase[:k] + "q" + phrase[k + 1 :]):
            found = scanner(f"so it is {changed} indeed".encode())
            assert [s[0] for s in found["spans"]] == ["mit"], changed


def test_edited_notice_before_an_exact_one_is_found():
    found = licenses.NoticeScanner()(b"x under the mit licence under the mit license y")
    assert [s[:4] for s in found["spans"]] == [("mit", 1, 4, 1), ("mit", 5, 8, 0)]


def test_pieces_cover_the_phrase():
    for phrase, _ in licenses.NOTICES:
        parts = licenses.pieces(phrase, licenses.edits_allowed(phrase) + 1)
        assert "".join(p for _, p in parts) == phrase and all(phrase[o : o + len(p)] == p for o, p in parts)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body>
<div id="cookie-notice"><p>We use cookies</p></div><header>Site</header><nav><ul><li>A<li>B</ul></nav>
<div class="layout"><div class="side sidebar">side</div><div class="text post-{n}"><h1>Title &amp; {n}</h1><p>First   line<br>second <b>bold</b>
line<p>Third &lt;p&gt;{n}<form><input value="a>b">x</form></div><section class="comments"><p>me too</p></section></div>
<!-- <p>hidden</p> --><aside>more</aside><footer>&copy;</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, slot string, text string")


def test_main_text_of_a_host(spark):
    rows = [(n, f"http://h.example/{n}", PAGE.format(n=n), "clash", "x", "y") for n in range(6)]
    got = {r["page_id"]: r["text"] for r in templates.main_text(pages(spark, rows)).collect()}
    assert got == {n: f"Title & {n}\nFirst line\nsecond bold line\nThird <p>{n}" for n in range(6)}


def test_pages_alone_and_awkward_pages(spark):
    rows = [
        (1, "http://a.example/", "<article><h1>One</h1><p>two", None, None, None),
        (1, "http://a.example/", "<article><h1>One</h1><p>two", None, None, None),
        (2, None, None, None, None, None),
        (None, "no url", "", None, None, None),
        (3, "http://b.example/x", "plain &lt; text", None, None, None),
        (4, "http://b.example/y", "<div>" * 3000 + "deep", None, None, None),
        (5, "http://b.example/z", "<p>" + "long " * 50_000 + "</p>", None, None, None),
        (6, "http://c.example/z", "<nav>only menu</nav>", None, None, None),
        (7, "http://c.example/q", "a < b <unclosed", None, None, None),
    ]
    got = [(r["page_id"], r["url"], r["text"]) for r in templates.main_text(pages(spark, rows)).collect()]
    want = {1: "One\ntwo", 2: "", None: "", 3: "plain < text", 4: "deep", 5: ("long " * 50_000).strip(), 6: "", 7: "a < b <unclosed"}
    assert in_order(got) == in_order((i, u, want[i]) for i, u, *_ in rows)
    assert templates.main_text(pages(spark, [])).count() == 0


@pytest.mark.parametrize(
    "page,text",
    [
        ('<body class="no-sidebar has-search"><div class="with-nav"><p>kept</p></div></body>', "kept"),
        ('<body class="sidebar"><article id="how-to-share-files"><section id="related"><h2 id="search">Find</h2><p>it</p></section></article>', "Find\nit"),
        ('<div><section id="related-work"><p>kept</p></section><div class="site-footer">out</div></div>', "kept"),
        ('<p>some <span class="advert">buy <span>now</span> this</span>text</p>', "some text"),
    ],
)
def test_names_exclude_as_a_whole(page, text):
    assert templates.article(page, None) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ("<p>one <img src=x> two <custom-el>three</custom-el> four</p>", "one two three four"),
        ("<p>one <svg><title>x</title><div>y</div></svg> two<select><option>a</select></p><p>three", "one two\nthree"),
        ("<p title=don't>one two</p><p>it's</p>", "one two\nit's"),
        ("<p title='a>b' data-x=\"c<d\">one<br/>two</p>", "one\ntwo"),
        ("<div class=x><p>" + "we set cookies " * 50 + "</p></div><article><h1>A</h1><p>b</p></article>", "A\nb"),
        ("<button>unclosed <p>kept</p>", "unclosed\nkept"),
        ("<title>not this</title><p>" + "<a b='c' " * 300, "<a b='c' " * 300),
    ],
)
def test_markup_within_a_line(page, text):
    assert templates.article(page, None) == text.strip()


SITE = """<html><body><div class="m">Home Products About us Contact and a long line that all pages share</div>
<div class="w"><div class="h"><h1>Title {n}</h1></div><div class="t">{paragraphs}</div></div><div class="z">Terms and privacy</div></body></html>"""


def site(n):
    return SITE.format(n=n, paragraphs="".join(f"<p>Words {n} {k}</p>" for k in range(1 + n % 3)))


def main(n):
    return "\n".join([f"Title {n}", *[f"Words {n} {k}" for k in range(1 + n % 3)]])


def test_odd_pages_do_not_undo_a_template(spark):
    rows = [(n, f"http://h.example/{n}", site(n), None, None, None) for n in range(9)]
    odd = "<html><body><div class='m'>Home</div><p>Error</p></body></html>"
    swapped = site(20).replace('<div class="z">Terms and privacy</div>', "").replace("<body>", '<body><div class="z">Terms and privacy</div>')
    twice = SITE.format(n=21, paragraphs='<p>Words 21 0</p></div><div class="t"><p>more</p>')
    more = [(30, "http://h.example/e", odd), (20, "http://h.example/s", swapped), (21, "http://h.example/t", twice)]
    rows += [(*r, None, None, None) for r in more]
    got = {r["page_id"]: r["text"] for r in templates.main_text(pages(spark, rows)).collect()}
    # The odd page has no slot of the host and is read by itself.
    assert got == {**{n: main(n) for n in range(9)}, 20: main(20), 21: "Title 21\nWords 21 0\nmore", 30: "Home\nError"}


def brute_template(htmls):
    """The template from whole occurrence vectors, orders and texts of every page, in plain lists."""
    seen = [{s.token.token: s for s in templates.page_summary(h)} for h in htmls]
    need = len(htmls) * templates.SUPPORT
    classes = {}
    for token in set().union(*seen):
        vector = tuple(p[token].times if token in p else 0 for p in seen)
        if sum(v > 0 for v in vector) >= need and sum(v == 1 for v in vector) >= need:
            classes.setdefault(vector, []).append(token)
    skeleton = []
    for vector, tokens in classes.items():
        orders = [tuple(sorted(tokens, key=lambda t: p[t].first)) for p, v in zip(seen, vector) if v]
        if max(map(orders.count, orders)) < len(orders) * templates.SUPPORT:
            continue
        for token in tokens:
            here = [p[token] for p in seen if token in p]
            said = [s.said for s in here]
            constant = len(htmls) >= templates.FEWEST and max(map(said.count, said)) >= need
            own = here[0].token
            skeleton.append(own._replace(size=sum(s.token.size for s in here), outs=sum(s.token.outs for s in here), constant=constant))
    return skeleton


def test_template_matches_brute_force(spark):
    import random

    rng = random.Random(5)
    hosts = {}
    for host in range(12):
        names = rng.sample("abcdefgh", 5)
        for n in range(rng.randint(1, 9)):
            parts = [f'<div class="{c}">{"same" if c < "d" else f"text {n} " * rng.randint(1, 4)}<p>{c}</p></div>' for c in names if rng.random() < 0.85]
            if rng.random() < 0.3:
                rng.shuffle(parts)
            hosts.setdefault(f"h{host}", []).append("<body>" + "".join(parts * rng.choice((1, 1, 2))) + f"<!--{n}--></body>")
    rows = [(h, n, page) for h, many in hosts.items() for n, page in enumerate(many)]
    tokens = templates.page_tokens(spark.createDataFrame(rows, "host string, page long, html string")).cache()
    got = {}
    for r in templates.valid_classes(tokens, templates.equivalence_classes(tokens)).collect():
        got.setdefault(r["host"], set()).add(templates.Token(*(r[c] for c in templates.Token._fields)))
    want = {h: set(brute_template(many)) for h, many in hosts.items()}
    assert got == {h: s for h, s in want.items() if s}
    slots = {r["host"]: templates.Template(r["slot"], r["furniture"]) for r in templates.host_templates(tokens).collect()}
    assert slots == {h: found for h, s in want.items() if (found := templates.deduce(list(s)))}
    tokens.unpersist()


def test_equal_occurrence_vectors_share_a_class(spark):
    rows = [("h", p, t, 0, "", n, 0, 0, 0, 0) for p, times in enumerate([(1, 1, 2, 2), (1, 1, 3, 3), (1, 1, 1, 1)]) for t, n in enumerate(times)]
    found = {r["token"]: r["class"] for r in templates.equivalence_classes(spark.createDataFrame(rows, templates.TOKENS)).collect()}
    assert found[2] == found[3] != found[1] == found[0]
