import random

import numpy as np
import pytest

from agendario.llm import html_blocks

SCHEMA = "page_id long, url string, html string, text string, n_chars string"
TREE = html_blocks.Tree(*html_blocks.labelled_table())

PAGES = {
    "plain": ("<html><head><title>no</title><style>p{}</style></head><body><nav><a href=/>Menu</a></nav><article><h1>Head</h1><p>One &amp; two&nbsp;&lt;3&gt;.<p>Be.</p><script>var x='<p>no</p>'</script></article><footer>&copy; no</footer></body></html>", "Head\n\nOne & two <3>.\n\nBe."),
    "unclosed": ("<div class=\"ad\">Buy a very long list of things now and here.</div><article><p><b>Bold start.<br>next\n\tline<p>Last", "Bold start. next line\n\nLast"),
    "cut in a tag": ("<article><p>All of it.</p><p>And &am</", "All of it.\n\nAnd &am"),
    "comments": ("<article><p>Text of the piece.</p><section id='comments'><p>I liked this piece very much and want to read more of it soon.</p></section></article>", "Text of the piece."),
    "forms": ("<article><p>Text.</p><form><p>Your name here</p><input><button>Send</button></form><!-- <p>no</p> --><p>End.</p></article><aside><p>Other long words that stand beside the main text of this page.</p></aside>", "Text.\n\nEnd."),
    "notice": ("<div class='cookie-banner'><p>We use files of many kinds to see what you read, say yes.</p></div><main><header><h1>Own head</h1></header><p>A link <a href='>'>in it</a> stays.</p></main>", "Own head\n\nA link in it stays."),
    "hidden": ("<article><p>Seen.</p><div hidden><p>Not seen by any reader of the page.</p></div></article>", "Seen."),
    "wrapper": ("<body class='with-sidebar'><div class='has-sidebar'><article class='post comments-open'><p>Kept all the same.</p></article></div></body>", "Kept all the same."),
    "unclosed controls": ("<article><p>a</p><button>Send<p>All the rest of it.</p><svg class=x/><p>End.</p><svg><path d=x></svg><p>Very end <select><option>no</select> yes</p><button>x</button></article>", "a\n\nSend\n\nAll the rest of it.\n\nEnd.\n\nVery end yes"),
    "a name in a name": ("<div class='text-latest-release'><h1>New release</h1><p>The new release brings a long list of changes that people have waited for since spring.</p><p>Get it now.</p></div>", "New release\n\nThe new release brings a long list of changes that people have waited for since spring.\n\nGet it now."),
    "plain notice": ("<div><p>We use cookies to give you the best experience on our pages, by going on you agree to that.</p></div><div><h1>T</h1><p>Some text of the article that is long enough to count as such.</p><p>And more of it follows here, in words.</p></div>", "T\n\nSome text of the article that is long enough to count as such.\n\nAnd more of it follows here, in words."),
    "plain notice before an article": ("<div><p>We use cookies to give you the best experience on our pages, by going on you agree to that.</p></div><article><h1>T</h1><p>Some text.</p></article>", "T\n\nSome text."),
    "empty": ("", ""),
    "no text": ("<nav><a href=x>y</a></nav>", ""),
}


def test_the_tree_fits_its_table():
    x, y = html_blocks.labelled_table()
    assert np.mean([TREE.predict(r) == t for r, t in zip(x, y)]) >= 0.95


def used(node):
    return set() if isinstance(node, int) else {html_blocks.FEATURES[node[0]]} | used(node[2]) | used(node[3])


def test_the_tree_splits_on_words_and_links_of_neighbours():
    assert {"words", "links", "words_before", "links_before", "links_after"} <= used(TREE.root)


def test_names_do_not_matter_where_elements_tell():
    page = "<html><body><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two words</a></li></ul></nav><div {}>Buy a kettle of the best kind today.</div><article {}><h1>Head</h1><p><b>Bold.<br><p>Long enough text of the article with a <a href=x>link</a> in it.<p>Be.</p></article><footer {}>&copy; me</footer></body></html>"
    texts = {html_blocks.main_text(page.format(a, b, c), TREE) for a in ("class=ad", "class=zzq", "id=main-content") for b in ("", "class='post latest comments-open'") for c in ("", "id=text")}
    assert texts == {"Head\n\nBold.\n\nLong enough text of the article with a link in it.\n\nBe."}


def test_pages(spark):
    rows = [(i, name, html, "clash", "x") for i, (name, (html, _)) in enumerate(PAGES.items())] + [(None, None, None, "", ""), (0, "plain", PAGES["plain"][0], "", "")]
    got = [tuple(r) for r in html_blocks.extracted(spark.createDataFrame(rows, SCHEMA)).collect()]
    expected = [(i, n, PAGES.get(n, ("", ""))[1]) for i, n, *_ in rows]
    assert got == [(*e, len(e[2])) for e in expected]
    assert html_blocks.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


PARTS = ("The council met on Monday and agreed on a plan for the new bridge that many had asked for.", "Work begins in spring.", "Costs are shared by the two towns over a span of ten years, said the mayor of the larger one.")
WHOLE = "\n\n".join(["Head line", *PARTS])
#: Names that tell nothing come last.
COMMENTS = "comments-area comment reader-comments user-comments discussion responses zzq k3x".split()
ADVERTS = "ad ad-box ad-slot sponsored promo banner advert-box zzq".split()


def page_with(wrap, inside="", before="", after="", beside="", lead=""):
    return f"<nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav><{wrap}>{before}<h1>Head line</h1>{lead}<p>{PARTS[0]}</p><p>{PARTS[1]}</p>{inside}<p>{PARTS[2]}</p>{after}</{wrap}>{beside}<footer>me</footer>"


@pytest.mark.parametrize("wrap", ["article", "div"])
def test_comments_of_readers_go_whatever_their_names(wrap):
    for one in ("<p>I liked this piece very much and want more of it.</p>", "<p>Anna, 3 May 2020</p><p>I liked this piece very much and want more of it.</p>", "<div>Anna</div><p>Me too.</p>"):
        for c in COMMENTS:
            for box in (f"<section class={c}><h3>3 comments</h3>" + f"<div class=u>{one}</div>" * 3 + "</section>", f"<div class={c}>" + f"<div class=u>{one}</div>" * 3 + "</div>", f"<div class={c}>{one}</div>" * 3, f"<div class='{c}'>{one}</div>"):
                assert html_blocks.main_text(page_with(wrap, after=box), TREE) == WHOLE, box
                assert html_blocks.main_text(page_with(wrap, beside=box), TREE) == WHOLE, box


@pytest.mark.parametrize("wrap", ["article", "div"])
def test_adverts_and_notices_go_whatever_their_names(wrap):
    for text in ("Buy a kettle of the best kind today.", "<p>Buy a kettle of the best kind today.</p>", "<a href=x>Buy a kettle</a> of the best kind today.", "<p>We use cookies to give you the best of our pages, go on and you agree.</p>"):
        for c in [*ADVERTS, "cookie-note", "notice-bar", "legal"]:
            for place in ("inside", "before", "after"):
                assert html_blocks.main_text(page_with(wrap, **{place: f"<div class={c}>{text}</div>"}), TREE) == WHOLE, (c, place, text)


@pytest.mark.parametrize("wrap", ["article", "div"])
def test_bare_text_sections_and_frames_named_after_what_they_hold_stay(wrap):
    bare = "Bare text that opens the piece and runs on a while."
    for lead in (bare, f"<div>{bare}</div>"):
        assert html_blocks.main_text(page_with(wrap, lead=lead), TREE) == "\n\n".join(["Head line", bare, *PARTS])
    assert html_blocks.main_text(f"<nav><a href=x>y</a></nav><{wrap}>{bare}<p>{PARTS[0]}</p><p>{PARTS[2]}</p></{wrap}>", TREE) == "\n\n".join([bare, PARTS[0], PARTS[2]])
    part = f"<section class=q><h2>Part</h2><p>{PARTS[0]}</p><p>{PARTS[1]}</p></section>"
    assert html_blocks.main_text(page_with(wrap, after=part * 2), TREE) == "\n\n".join([WHOLE, *["Part", PARTS[0], PARTS[1]] * 2])
    assert html_blocks.main_text(f"<body class='with-sidebar'><div class='content has-comments'>{page_with(wrap)}</div></body>", TREE) == WHOLE


def random_page(rng):
    """A page of random make, and its main text by blocks. Every block begins with its own number."""
    number, kept = iter(range(10**6)), []

    def words(low, high):
        return f"W{next(number)} " + " ".join(["word"] * rng.randint(max(1, low), high))

    def keep(low, high):
        kept.append(words(low, high))
        return kept[-1]

    def name():
        return "".join(rng.choice("abcdefghij") for _ in range(5))

    def paragraph():
        kind = rng.random()
        if kind < 0.85:
            return f"<p>{keep(6, 60) if kind < 0.7 else keep(1, 8)}</p>"
        if kind < 0.92:
            return "<ul>" + "".join(f"<li>{keep(1, 12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        return f"<h2>{keep(1, 7)}</h2><p>{keep(5, 40)}</p>" if kind < 0.96 else f"<blockquote><p>{keep(5, 30)}</p></blockquote>"

    def advert():
        return f"<div class={name()}>" + rng.choice(["{}", "<p>{}</p>", "<a href=x>{}</a>"]).format(words(4, 16)) + "</div>"

    def comments():
        child = name()
        some = "".join(f"<div class={child}><p>{words(1, 3)}</p><p>{words(3, 40)}</p></div>" for _ in range(rng.randint(2, 6)))
        return f"<section class={name()}>{some}</section>"

    wrap, head, n = rng.choice(["article", "main", "div"]), f"<h1>{keep(2, 10)}</h1>", rng.randint(3, 10)
    advert_at = rng.randint(2, n) if rng.random() < 0.5 else n
    text = "".join((advert() if k == advert_at else "") + paragraph() for k in range(n))
    inside, beside = (comments(), "") if rng.random() < 0.4 else ("", comments())
    menu = "".join(f"<li><a href=x>{words(1, 2)}</a></li>" for _ in range(rng.randint(2, 7)))
    return f"<nav><ul>{menu}</ul></nav><{wrap} class={name()}>{head}{text}{inside}</{wrap}>{beside}<footer>{words(2, 10)}</footer>", kept


def test_random_pages_with_names_that_tell_nothing():
    rng = random.Random(21)
    lost = extra = n = other = 0
    for _ in range(400):
        page, kept = random_page(rng)
        got = html_blocks.main_text(page, TREE).split("\n\n")
        lost, extra, n, other = lost + len(set(kept) - set(got)), extra + len(set(got) - set(kept)), n + len(kept), other + len(html_blocks.blocks(page)) - len(kept)
    assert lost <= 0.005 * n and extra <= 0.03 * other


def test_a_layout_that_was_left_out_is_mostly_read_right(monkeypatch):
    layouts, right, n = html_blocks.LABELLED, 0, 0
    for k in range(0, len(layouts), 12):
        monkeypatch.setattr(html_blocks, "LABELLED", layouts[:k] + layouts[k + 1 :])
        tree = html_blocks.Tree(*html_blocks.labelled_table(4))
        monkeypatch.setattr(html_blocks, "LABELLED", layouts[k : k + 1])
        x, y = html_blocks.labelled_table(4)
        right, n = right + sum(tree.predict(a) == b for a, b in zip(x, y)), n + len(y)
    assert right >= 0.85 * n


def test_very_deep_nesting_takes_linear_time():
    assert html_blocks.main_text("<div>" * 100000 + "<p>Text.</p>" * 3, TREE).count("Text.") in (0, 3)


def test_a_very_long_page():
    body = "".join(f"<p>Paragraph number {i} of many &amp; more.</p>" for i in range(20000))
    text = html_blocks.main_text(f"<nav><a>m</a></nav><article>{body}</article>", TREE)
    assert text.count("\n\n") == 19999 and text.endswith("19999 of many & more.")


def test_no_class_leads_to_quadratic_time():
    assert html_blocks.main_text("<p a=\"" * 2000, TREE) == ""
