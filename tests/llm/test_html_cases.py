"""Main text: golden pages, pages made from parts with a known answer, and what each step of the method decides."""

import html
import random

import pytest

from scriptorium.llm import html_extract
from scriptorium.llm.html_extract import main_text

L = "A long sentence of prose that goes on for a while, so that its ratio of text to tags is high."
P = f"<p>{L}</p>"
MENU = "<ul><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a href=c>Sport</a></li></ul>"

GOLDEN = {
    "a head that is never closed": (f"<html><head><title>T</title><meta charset=x><body>{P}</body>", [L]),
    "text right after an open head": ("<html><head><title>T</title>Hello there", ["Hello there"]),
    "an article with a furniture word": (f'<nav>{MENU}</nav><article class="post related-news">{P}{P}</article>', [L, L]),
    "a block with a furniture word and a content word": (f'<nav>{MENU}</nav><div class="post related-news">{P}{P}</div>', [L, L]),
    "two posts of a length": (f'<nav>{MENU}</nav><div class="post">{P}<p>One</p></div><div class="post">{P}<p>Two</p></div>', [L, "One", L, "Two"]),
    "paragraphs around a large article": (f"<main><p>Lead.</p>{P}<article>{P * 9}</article><p>After.</p></main>", ["Lead.", L, *[L] * 9, "After."]),
    "a reading list": (f"<article><h1>T</h1>{P}{MENU}{P}<p>End.</p></article>", ["T", L, "Home", "News", "Sport", L, "End."]),
    "an advert inside a line": (f'<article>{P}<p>one <span class="ad">a</span>x two</p></article>', [L, "one x two"]),
    "an unclosed advert inside a line": (f'<article>{P}<p>one <span class="ad">a</p><p>two</p></article>', [L, "one", "two"]),
    "a short article and long comments": (f'<article><h1>T</h1><p>Small.</p></article><div class="comments">{P * 3}<article class="comment">{P}</article></div>', ["T", "Small."]),
    "a short article and a long footer": (f"<nav>{MENU}</nav><article><h1>Hi</h1><p>Yes.</p></article><footer>{L}</footer>", ["Hi", "Yes."]),
    "an advert between articles": (f'<article>{P}</article><div class="ad">{P}</div><article>{P}</article>', [L, L]),
    "furniture inside an article": (f'<article>{P}<div class="cookie-notice">{P}</div><form><label>Name</label></form><aside>{P}</aside>{P}</article>', [L, L]),
    "an article inside a form": (f"<form><nav>{MENU}</nav><article>{P}{P}</article></form>", [L, L]),
    "an article inside a block with a furniture word": (f'<div class="page no-sidebar widget">{P}<article>{P}{P}</article></div>', [L, L]),
    "hidden text": (f"<article>{P}<div hidden>{P}</div><p style='display: none'>{L}</p></article>", [L]),
    "comments only": (f'<div class="comments">{P}{P}</div>', []),
    "an aside only": (f"<aside>{P}</aside><nav>{MENU}</nav>", []),
    "menus only": (f"<nav>{MENU}</nav><footer>Foot</footer>", []),
    "one letter": ("<p>x", ["x"]),
    "flat paragraphs": (f"<p>One</p>{P}<p>Two</p>", ["One", L, "Two"]),
}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden(name):
    page, want = GOLDEN[name]
    assert main_text(page) == "\n".join(want)


#: No tag or class of this page says what is what.
BARE = f"<body><div>{MENU}</div><h1>A title</h1><div>{P}<p>Short.</p>{P}</div><div>{MENU}{MENU}</div></body>"


def test_threshold_decides(monkeypatch):
    want = "\n".join(["A title", L, "Short.", L])
    assert main_text(BARE) == want
    monkeypatch.setattr(html_extract, "two_means", lambda scores: min(scores))
    assert main_text(BARE) != want  # menus come along
    named = GOLDEN["a short article and long comments"]
    assert main_text(named[0]) != "\n".join(named[1])


def test_smoothing_decides(monkeypatch):
    page = f"<body><div>{MENU}</div><h1>Title</h1><div>{P}{P}{P}</div><div>{MENU}</div></body>"
    assert main_text(page) == "\n".join(["Title", L, L, L])
    monkeypatch.setattr(html_extract, "smooth", lambda values: values)
    assert main_text(page) == "\n".join([L, L, L])  # a short title alone is no content


def test_pages_made_from_parts():
    rng = random.Random(7)

    def sentence(n):
        return " ".join(rng.choice(["Größe", "l'été", "a<b", "R&D", "plain", "words", "año", "x"]) for _ in range(n))

    furniture = [f"<nav>{MENU}</nav>", "<footer>&copy; us</footer>", '<div class="ad">Buy now</div>', '<section id="comments"><p>Great read, thanks a lot for it!</p></section>', "<script>var a='</p>';</script>",
                 "<style>p{}</style>", "<aside><p>About the author</p></aside>", "<form><label>Mail</label><input><button>Go</button></form>", "<!-- note -->", '<div class="cookie-banner"><p>We use cookies</p></div>']
    for _ in range(200):
        blocks = [sentence(rng.randrange(1, 60)) for _ in range(rng.randrange(1, 12))]
        tags = [rng.choice(["p", "h2", "blockquote", "li", "pre"]) for _ in blocks]
        inner = []
        for tag, text in zip(tags, blocks):
            words = [f"<{t}>{html.escape(w)}</{t}>" if (t := rng.choice(["", "", "", "b", "em", "a"])) else html.escape(w) for w in text.split()]
            inner.append(f"<{tag}>{rng.choice([' ', chr(10), '  '])}{rng.choice([' ', chr(10)]).join(words)}</{tag}>" + (rng.choice(furniture) if rng.random() < 0.3 else ""))
        around = [rng.choice(furniture) for _ in range(rng.randrange(0, 5))]
        page = f"<html><head><title>x</title></head><body>{''.join(around[:2])}<article>{''.join(inner)}</article>{''.join(around[2:])}</body></html>"
        assert main_text(page) == "\n".join(blocks)


def test_long_page():
    n = 20_000
    page = f"<body><nav>{MENU}</nav><article>" + "".join(f"<p>{L} {k}<br>and on" for k in range(n)) + "</article>"
    assert main_text(page) == "\n".join(f"{L} {k} and on" for k in range(n))
    assert main_text("<div>" * 3000 + L) == L
