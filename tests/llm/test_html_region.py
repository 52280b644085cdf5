"""Content beside the largest container, and lists of links in the article, stay."""

from scriptorium.llm.html_extract import main_text

P = "A paragraph of the article that goes on for quite a while, so that it counts as content, number {}."
NAV = '<nav><ul><li><a href="a">One</a></li><li><a href="b">Two</a></li><li><a href="c">Three</a></li></ul></nav>'


def article(first, n):
    return "<article>" + "".join(f"<p>{P.format(k)}</p>" for k in range(first, first + n)) + "</article>"


def test_sibling_articles():
    page = f"<body>{NAV}<main>{article(0, 6)}{article(6, 4)}</main><footer>Foot</footer></body>"
    assert main_text(page) == "\n".join(P.format(k) for k in range(10))


def test_heading_and_intro_beside_the_body():
    body = "".join(f"<p>{P.format(k)}</p>" for k in range(9))
    page = f'<body>{NAV}<div><h1>The title</h1><div><p>{P.format("intro")}</p></div><div>{body}</div></div><footer>Foot</footer></body>'
    assert main_text(page) == "\n".join(["The title", P.format("intro"), *(P.format(k) for k in range(9))])
    page = f"<body>{NAV}<div><h1>The title</h1><div>{body}</div></div></body>"
    assert main_text(page).startswith("The title\n")


def test_list_of_sources():
    sources = "".join(f'<li><a href="/{k}">Source {k}</a></li>' for k in range(5))
    paragraphs = "".join(f"<p>{P.format(k)}</p>" for k in range(4))
    page = f'<body>{NAV}<article>{paragraphs}<h2>Sources</h2><ul>{sources}</ul><ul class="share"><li><a href="x">Post</a></li><li><a href="y">Send</a></li><li><a href="z">Print</a></li></ul></article></body>'
    assert main_text(page) == "\n".join([*(P.format(k) for k in range(4)), "Sources", *(f"Source {k}" for k in range(5))])


# --- names

L = "A long sentence of prose that goes on for a while, so that its ratio of text to tags is high, and which has no link in it anywhere at all, to be sure."


def paragraphs(n):
    return f"<p>{L}</p>" * n


def test_a_layout_name_hides_nothing():
    for name in ("page has-sidebar", "no-comments", "withSidebar", "page without_ads has-cookie-notice"):
        assert main_text(f'<div class="{name}">{paragraphs(2)}</div>') == "\n".join([L] * 2), name


def test_names_that_only_begin_like_furniture():
    for tag in ("section id=search-algorithms", "section class=social-history", "div class=menu-costs", "p class=related", "div class=notice-board", "div class=commentary", "div class=adverbs", "div class=ad-hoc"):
        name = tag.split()[0]
        inner = f"<{tag}>{L} X" if name == "p" else f"<{tag}><p>{L} X</p>"
        page = f"<body>{NAV}<article><h1>T</h1><p>{L}</p>{inner}</{name}><p>{L}</p></article><footer>Foot</footer></body>"
        assert main_text(page) == "\n".join(["T", L, f"{L} X", L]), tag


def test_readers_comments_in_articles_of_their_own():
    comments = f'<section class="comments"><h2>Comments</h2><article><p>{L} said one</p></article><article class="comment"><p>{L} said two</p></article></section>'
    assert main_text(f"<main><article>{paragraphs(3)}</article>{comments}</main>") == "\n".join([L] * 3)
    assert main_text(f"<main><article>{paragraphs(3)}{comments}</article></main>") == "\n".join([L] * 3)
    side = f'<div class="side-bar"><article><p>{L} a teaser</p></article></div>'
    assert main_text(f"<main>{side}<article>{paragraphs(3)}</article></main>") == "\n".join([L] * 3)


def test_furniture_by_compound_names():
    for name in ("cookie-notice", "site-footer", "comment-list", "commentList", "ad_slot_3", "sidebar-left", "SideBar", "related-posts", "newsletter-signup", "post-comments", "breadcrumb-nav"):
        page = f'<body>{NAV}<article>{paragraphs(3)}</article><div class="{name}"><p>Something else here</p></div></body>'
        assert main_text(page) == "\n".join([L] * 3), name
        page = f'<body>{NAV}<article>{paragraphs(2)}<div class="{name}"><p>Something else here</p></div>{paragraphs(1)}</article></body>'
        assert main_text(page) == "\n".join([L] * 3), name


def test_random_names_change_no_page():
    """Names that mean nothing change no result; pages without names of furniture have the same text under any names."""
    import random
    import re

    rng = random.Random(3)
    pages = [
        f"<body>{NAV}<main>{article(0, 6)}{article(6, 4)}</main><footer>Foot</footer></body>",
        f"<body>{NAV}<div class=x><h1>The title</h1><div class=y>{paragraphs(5)}</div></div></body>",
        f"<body><div class=top>{NAV}</div><div class=x>{paragraphs(3)}<ul class=z><li>One thing</li><li>Another</li></ul>{paragraphs(2)}</div></body>",
    ]
    for page in pages:
        want = main_text(page)
        assert want
        for _ in range(20):
            renamed = re.sub(r"<(div|p|ul|li|section|h1)(?: class=\w+)?>", lambda m: f'<{m[1]} class="{"".join(rng.choices("bcdfghjklm", k=7))}-{rng.choice(["alpha", "zeta9", "qq"])}">', page)
            assert main_text(renamed) == want


# --- a plain second form of the method, over lists of numbers


def plain_content(ratios, linked, priors):
    import numpy as np

    n = len(ratios)
    x = np.arange(n)
    kernel = np.exp(-((x[:, None] - x[None, :]) ** 2) / 2.0) * (np.abs(x[:, None] - x[None, :]) <= 3)
    smoothed = (kernel * np.array(ratios)).sum(axis=1) / kernel.sum(axis=1)
    score = np.array(priors) * (1 - 0.9 * np.minimum(1, np.array(linked))) * np.log1p(smoothed)
    low, high = score.min(), score.max()
    for _ in range(30):
        far = np.abs(score - low) > np.abs(score - high)
        near_tie = np.abs(score - (low + high) / 2) < 1e-12
        a, b = score[~far | near_tie], score[far & ~near_tie]
        if not len(a) or not len(b) or (a.mean(), b.mean()) == (low, high):
            break
        low, high = a.mean(), b.mean()
    if high - low < 1.5:
        return [p >= 0.5 * max(priors) for p in priors]
    return [s >= (low + high) / 2 for s in score]


def test_clusters_against_a_plain_form():
    import random

    from scriptorium.llm.html_extract import Line, content_lines

    rng = random.Random(11)
    for _ in range(200):
        lines = []
        for k in range(rng.randrange(1, 40)):
            line = Line(0, rng.choice([1.0, 1.0, 0.5, 0.1, 0.05]), 1.0, k)
            text = "x" * rng.choice([3, 8, 30, 90, 400])
            line.tags, line.linked = rng.randrange(6), rng.choice([0, 0, len(text) // 2, len(text)])
            lines.append((line, text))
        want = plain_content([len(t) / max(1, x.tags) for x, t in lines], [x.linked / len(t) for x, t in lines], [x.prior for x, _ in lines])
        assert content_lines(lines) == want
