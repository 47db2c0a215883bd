"""Pages of odd shapes, learned weights and hostile pages."""

import time

import pytest

from byteloom.llm import common, html

WORDS = "Some words of <a href=x>a link</a> in a paragraph that is long enough to be one."
BODY = "<h1>Title here</h1>" + f"<p>{WORDS}</p>" * 4
TEXT = "\n\n".join(["Title here", *["Some words of a link in a paragraph that is long enough to be one."] * 4])
NAV, FOOT = "<nav><ul><li><a href=a>Menu</a></li></ul></nav>", "<footer>copyright words</footer>"
READERS = f'<section id="comments"><article class="comment"><p>{"a reader says many words " * 30}</p></article></section>'
SECTION = '<section id="related-work"><h2>Related work</h2><p>Earlier people did some things that matter.</p></section>'

SHAPES = {
    "has-sidebar": (f'{NAV}<div class="has-sidebar"><article>{BODY}</article></div>{FOOT}', TEXT),
    "no-sidebar": (f'{NAV}<div class="no-sidebar"><div class="content">{BODY}</div></div>{FOOT}', TEXT),
    "ad-free": (f'<body class="ad-free">{NAV}<article>{BODY}</article>{READERS}{FOOT}</body>', TEXT),
    "search-results": (f'{NAV}<div class="search-results"><article>{BODY}</article></div>{FOOT}', TEXT),
    "wrapper": (f'<div class="single-post comments-open">{NAV}<article>{BODY}</article>{READERS}</div>{FOOT}', TEXT),
    "article": (f'{NAV}<article class="post comments-open">{BODY}</article>{READERS}{FOOT}', TEXT),
    "form": (f'<form id="page">{NAV}<div id="main">{BODY}</div>{FOOT}</form>', TEXT),
    "section": (
        f"{NAV}<article>{BODY}{SECTION}</article>{FOOT}",
        f"{TEXT}\n\nRelated work\n\nEarlier people did some things that matter.",
    ),
    "two": (f"{NAV}<main><article>{BODY}</article><article>{BODY}</article></main>{FOOT}", f"{TEXT}\n\n{TEXT}"),
    "two in the body": (f"{NAV}<article>{BODY}</article><article>{BODY}</article>{READERS}{FOOT}", f"{TEXT}\n\n{TEXT}"),
    "advert": (f'{NAV}<article>{BODY}<div class="ad">Buy this</div><p>Last.</p></article>{FOOT}', f"{TEXT}\n\nLast."),
    "hidden": (f"{NAV}<article>{BODY}<p hidden>Not shown</p></article>{FOOT}", TEXT),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(shape):
    page, want = SHAPES[shape]
    assert html.main_text(page, html.PLAIN) == want


def test_weights_are_learned(spark):
    """A class that no prior knows is left out once marked pages show it outside their articles, and only then."""
    common.share_package(spark)
    box = '<div class="zeta"><p>Words of a box that stands on every page of this site.</p></div>'
    marked = [(i, "u", f"{NAV}{box}<article>{BODY}</article>{FOOT}") for i in range(20)]
    pages = spark.createDataFrame(marked, "page_id bigint, url string, html string")
    fitted = html.fit(pages)
    unmarked = f'{NAV}<div class="x">{BODY}{box}</div>{FOOT}'
    assert html.main_text(unmarked, fitted) == TEXT
    assert html.main_text(unmarked, html.PLAIN) == f"{TEXT}\n\nWords of a box that stands on every page of this site."
    assert fitted.parts["zeta"] < -2 and fitted.names["p"] > fitted.names["nav"]


def test_region_of_whole_pages():
    """The scan's region of every shape has the highest sum of all runs of its items."""
    for page, _ in SHAPES.values():
        parsed = html.parse(page)
        low, lean = html.PLAIN.around(parsed, html.wrappers_of(parsed, True))
        scores = html.PLAIN.scores(parsed, lean)
        start, end = html.best_region(scores)
        sums = [0.0]
        for s in scores:
            sums.append(sums[-1] + s)
        best = max(sums[j] - sums[i] for i in range(len(sums)) for j in range(i, len(sums)))
        assert sums[end] - sums[start] == pytest.approx(best)


@pytest.mark.parametrize("piece", ["<a ", '<a x="', "<a '\"", "<div>", "<div class=ad>", "<article>x y ", "<!-", "<script "])
def test_hostile_pages_take_linear_time(piece):
    def seconds(n):
        started = time.process_time()
        html.main_text(piece * n, html.PLAIN)
        return time.process_time() - started

    assert seconds(80_000) < 10 * seconds(20_000) + 0.5


def test_clashing_columns_and_bodies_of_many_kinds(spark):
    common.share_package(spark)
    rows = [(1, "u", SHAPES["two"][0], "t", 5), (1, "u", SHAPES["two"][0], "t", 5), (None, None, None, None, None), (3, "", "<p", "", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = html.extract(pages, html.PLAIN).collect()
    assert [(r.page_id, r.text) for r in got][:2] == [(1, f"{TEXT}\n\n{TEXT}")] * 2
    assert sum(r.n_chars for r in got if r.page_id is None) == 0
