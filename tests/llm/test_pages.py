"""Main text of pages that are labelled by hand: what is text, block by block, and what is not."""

import pytest

from lexloom.llm import htmltext

LONG = "The committee met in the old town hall on Monday evening and spoke for some hours about the plans for the bridge, which many in the town want to keep as it is, while others ask for a new one."
MORE = "It was built by hand in the last century, and its stones come from the hills nearby; nobody knows who drew the plans, but two families say that it was one of theirs."
THIRD = "In the end they agreed to wait for a report, which is to be ready in spring, and to ask everyone who lives near the river."
SELL = "Buy our new garden chairs today and save a third of the price, as long as stocks last, with free delivery to every house in the country and a year to think about it, only this week."

#: (name, page, the text that it has).
LABELLED = [
    ("a section named after work", f'<article><h1>Bridges</h1><p>{LONG}</p><section class="related-work"><h2>Related work</h2><p>{MORE}</p><p>{THIRD}</p></section></article>', f"Bridges {LONG} Related work {MORE} {THIRD}"),
    ("related posts", f'<article><h1>Bridges</h1><p>{LONG}</p><section class="related-posts"><h2>Related posts</h2><p>{MORE}</p></section></article>', f"Bridges {LONG}"),
    ("a page in a strange name", f'<div class="promotion-law"><h1>Law</h1><p>{LONG}</p><p>{MORE}</p></div>', f"Law {LONG} {MORE}"),
    ("a page in a strong name", f'<div class="cookies recipe"><h1>Cookies</h1><p>{LONG}</p><p>{MORE}</p></div>', f"Cookies {LONG} {MORE}"),
    ("a short list", f"<div><h1>Head</h1><p>{LONG}</p><ul><li>One</li><li>Two</li></ul><p>{MORE}</p></div>", f"Head {LONG} One Two {MORE}"),
    ("reader comments by another name", f'<article><h1>Head</h1><p>{LONG}</p></article><div id="responses"><p>{MORE}</p><p>I like this a lot, thank you.</p></div>', f"Head {LONG}"),
    ("comments without an article", f'<div><h1>Head</h1><p>{LONG}</p><p>{THIRD}</p></div><div class="user-comments"><p>{MORE}</p></div>', f"Head {LONG} {THIRD}"),
    ("an advert in a plain element", f"<article><h1>Head</h1><p>{LONG}</p><p>{MORE}</p></article><div><p>{SELL}</p></div>", f"Head {LONG} {MORE}"),
    ("an advert in the article", f'<article><h1>Head</h1><p>{LONG}</p><div class="content-ad"><p>{SELL}</p></div><p>{MORE}</p></article>', f"Head {LONG} {MORE}"),
    ("a section about prices", f'<article><p>{LONG}</p><section class="share-price"><h2>Price</h2><p>{MORE}</p><p>{THIRD}</p></section></article>', f"{LONG} Price {MORE} {THIRD}"),
    ("menus around", f'<header class="site-header"><a href=/>Home</a></header><nav><ul><li><a href=/a>News</a></li><li><a href=/b>Sport</a></li></ul></nav><div id="content"><h1>Head</h1><p>{LONG}</p></div><div class="sidebar-left"><p>{SELL}</p></div><footer>About us</footer>', f"Head {LONG}"),
    ("a cookie notice", f'<div id="cookie-banner"><p>We use cookies to make this site better for you and for us.</p></div><main><h1>Head</h1><p>{LONG}</p></main>', f"Head {LONG}"),
    ("text in a page of small articles", f'<div><h1>Head</h1><p>{LONG}</p><p>{MORE}</p><p>{THIRD}</p></div><article><p>A teaser of one line.</p></article>', None),
    ("nothing but an advert", '<div class="ad">Buy this thing now.</div>', ""),
    ("a table in an article", f"<article><p>{LONG}</p><table><tr><th>Year</th><th>Stones</th></tr><tr><td>1900</td><td>12</td></tr></table></article>", f"{LONG} Year Stones 1900 12"),
]


@pytest.mark.parametrize("name,page,want", LABELLED, ids=[x[0] for x in LABELLED])
def test_labelled_pages(name, page, want):
    got = htmltext.extract(page)
    assert LONG in got if want is None else got == want


def test_the_cut_labels_other_blocks_than_the_scores():
    """On the labelled pages the cut turns some labels of single blocks, and always to the right side."""
    turned = 0
    for _, page, want in LABELLED:
        own = htmltext.blocks(page)
        for b, s, kept in zip(own, htmltext.scores(own), htmltext.labels(own), strict=True):
            if (s > 0) != kept and want is not None:
                turned += 1
                assert kept == (b.text in want)
    assert turned
