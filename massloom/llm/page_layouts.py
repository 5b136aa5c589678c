"""Labelled pages to learn from: texts set into layouts of many kinds, main text inside ``x-main``."""

from __future__ import annotations

import html
import random

# Words that pages name their parts by, and elements that hold them.
PARTS = {
    "menu": (["nav", "div", "ul", "header"], "nav menu navbar navigation breadcrumb breadcrumbs topbar tabs links toolbar skip pagination pager language"),
    "header": (["header", "div"], "header masthead banner branding logo top site-title tagline page-header head"),
    "footer": (["footer", "div"], "footer copyright legal colophon bottom imprint site-info credits foot"),
    "sidebar": (["aside", "div", "section"], "sidebar aside widget rail related recommended trending popular side secondary recent more-stories teaser also"),
    "notice": (["div", "section", "aside", "dialog"], "cookie consent notice alert gdpr privacy modal popup overlay message warning toast newsletter paywall"),
    "advert": (["div", "aside", "section"], "ad ads advert advertisement sponsored promo promotion banner-ad adsense commercial sponsor dfp outbrain"),
    "form": (["form", "form", "div", "fieldset"], "form search login subscribe signup contact register feedback poll"),
    "comments": (["section", "div", "ol", "aside"], "comments comment commentlist respond discussion replies reply responses disqus reader-comments feedback-thread thread"),
    "share": (["div", "ul"], "share social sharing tools buttons follow tags meta print"),
}
MAIN = "content article post entry story body text main article-body entry-content post-content story-body articleBody page-content maincontent"
WRAPPERS = "page wrapper container root layout site outer row columns grid inner wrap app col"


def _words(texts: list[str], draw: random.Random, least: int, most: int) -> str:
    words: list[str] = []
    n = draw.randint(least, most)
    while len(words) < n:
        words += draw.choice(texts).split() or ["text"]
    start = draw.randint(0, len(words) - n)
    return html.escape(" ".join(words[start : start + n]), quote=False)


def _named(draw: random.Random, names: str) -> str:
    name = draw.choice(names.split())
    if draw.random() < 0.3:
        name = draw.choice(["site-{}", "{}-left", "c-{}", "{}_1", "js-{}", "{}-area", "main-{}", "the{}", "page-{}", "{}-box", "{}-list", "article-{}", "{}-container"]).format(name)
    return f' {draw.choice(["class", "class", "id"])}="{name}"'


def _list(texts: list[str], draw: random.Random, linked: bool = True) -> str:
    items = [_words(texts, draw, 1, draw.choice([2, 4, 8])) for _ in range(draw.randint(1, 8))]
    return "<ul>" + "".join(f'<li><a href="/{k}">{t}</a></li>' if linked else f"<li>{t}</li>" for k, t in enumerate(items)) + "</ul>"


def _paragraph(texts: list[str], draw: random.Random) -> str:
    text = _words(texts, draw, *draw.choice([(1, 3), (3, 12), (10, 40), (30, 150)]))
    if draw.random() < 0.2:
        words = text.split()
        k = draw.randrange(len(words))
        mark = draw.choice(["b", "em", "i", "strong", "span", 'a href="/x"'])
        words[k] = f"<{mark}>{words[k]}</{mark.split()[0]}>"
        text = " ".join(words)
    if draw.random() < 0.1:
        return f"<p><b>{text}<br>"
    return f"<p>{text}" + ("</p>" if draw.random() < 0.9 else "")


def _other(kind: str, texts: list[str], draw: random.Random) -> str:
    """A part that is no main text; where its name says nothing, its element does."""
    tags, names = PARTS[kind]
    tag = draw.choice(tags)
    telling = tag in ("nav", "header", "footer", "aside", "form")
    name = "" if telling and draw.random() < 0.5 else _named(draw, names)
    short = lambda most=6: _words(texts, draw, 1, most)
    prose = lambda: "".join(_paragraph(texts, draw) for _ in range(draw.randint(1, 3)))
    inside = {
        "menu": lambda: _list(texts, draw),
        "header": lambda: draw.choice([f"<h1>{short()}</h1>", f"<div>{short()}</div>", f"<p>{short(12)}</p>", short(), f"<h2>{short()}</h2>{_list(texts, draw)}"]),
        "footer": lambda: draw.choice([f"&copy; {short(20)}", f"<p>{short(30)}</p>", prose(), _list(texts, draw) + f"<p>&copy; {short()}</p>"]),
        "sidebar": lambda: f"<h{draw.randint(2, 4)}>{short()}</h3>" + draw.choice([_list(texts, draw), prose(), _list(texts, draw, False)]),
        "notice": lambda: draw.choice([short(30), f"<p>{short(40)}</p><button>{short(2)}</button>", prose()]),
        "advert": lambda: draw.choice([short(20), f'<a href="/buy">{short()}</a>', prose(), f"<span>{short()}</span>"]),
        "form": lambda: f"<label>{short()}</label><input><select><option>{short()}<option>{short()}</select><textarea>{short()}</textarea><button>{short(2)}</button>"
        + draw.choice(["", prose(), f"<p>{short(12)}</p>"]),
        "comments": lambda: f"<h3>{short()}</h3>"
        + "".join(draw.choice([f'<div class="comment">{prose()}</div>', f"<li>{short(30)}</li>", prose(), f"<article>{prose()}</article>"]) for _ in range(draw.randint(1, 4))),
        "share": lambda: draw.choice([_list(texts, draw), short(), f"<span>{short()}</span> <span>{short()}</span>"]),
    }[kind]()
    return f"<{tag}{name}>{inside}</{tag}>"


def _main(texts: list[str], draw: random.Random, titled: bool = True) -> str:
    parts = [f"<h1>{_words(texts, draw, 1, 14)}</h1>"] if titled and draw.random() < 0.85 else []
    for _ in range(draw.choice([1, 3, 6, 12, 20])):
        roll = draw.random()
        if roll < 0.75:
            parts.append(_paragraph(texts, draw))
        elif roll < 0.82:
            parts.append(f"<h{draw.randint(2, 4)}>{_words(texts, draw, 1, 8)}</h2>")
        elif roll < 0.88:
            parts.append(_list(texts, draw, draw.random() < 0.2))
        elif roll < 0.92:
            parts.append(f"<blockquote>{_paragraph(texts, draw)}</blockquote>")
        elif roll < 0.95:
            parts.append(f"<table><tr><td>{_words(texts, draw, 1, 6)}</td><td>{_words(texts, draw, 1, 6)}</td></tr></table>")
        elif roll < 0.98:
            parts.append(f"<figure><img><figcaption>{_words(texts, draw, 3, 12)}</figcaption></figure>")
        else:
            parts.append(f"<div>{_words(texts, draw, 10, 60)}</div>")
    return "".join(parts)


def _some(kinds: list[str], most: int, texts: list[str], draw: random.Random) -> str:
    return "".join(_other(kind, texts, draw) for kind in draw.sample(kinds, draw.randint(0, most)))


def _mark(body: str, draw: random.Random, texts: list[str]) -> str:
    """The main text in an element of one of the usual kinds, at times with other parts inside."""
    pieces = [f"<x-main>{body}</x-main>"]
    # Adverts, notices and the like stand between the paragraphs too, the rest below them.
    for kind in draw.sample(["advert", "share", "sidebar", "form", "notice", "menu", "footer"], draw.choice([0, 0, 1, 2, 3, 4])):
        at = draw.choice([len(pieces), draw.randint(0, len(pieces))])
        pieces.insert(at, _other(kind, texts, draw))
        if at == len(pieces) - 1 and draw.random() < 0.5:
            pieces.append(f"<x-main>{_main(texts, draw, titled=False)}</x-main>")
    if draw.random() < 0.25:
        pieces.append(_other("comments", texts, draw))
    inside = "".join(pieces)
    roll = draw.random()
    if roll < 0.4:
        return f"<article{_named(draw, MAIN) if draw.random() < 0.4 else ''}>{inside}</article>"
    if roll < 0.5:
        return f"<main>{inside}</main>"
    if roll < 0.65:
        return f"<main><article{_named(draw, MAIN) if draw.random() < 0.6 else ''}>{inside}</article>{_some(['comments', 'share', 'form'], 1, texts, draw)}</main>"
    if roll < 0.9:
        return f"<{(t := draw.choice(['div', 'div', 'section', 'td']))}{_named(draw, MAIN)}>{inside}</{t}>"
    return f'<div role="main">{inside}</div>'


def page(texts: list[str], draw: random.Random) -> str:
    """One page; what stands inside ``x-main`` is its main text."""
    top = _some(["menu", "header", "notice", "advert", "form", "share"], 4, texts, draw)
    middle = _mark(_main(texts, draw), draw, texts)
    beside = _some(["sidebar", "advert", "form", "menu"], 2, texts, draw)
    middle = beside + middle if draw.random() < 0.4 else middle + beside
    for _ in range(draw.choice([0, 0, 1, 2])):
        middle = f"<div{_named(draw, WRAPPERS) if draw.random() < 0.7 else ''}>{middle}</div>"
    end = _some(["comments", "sidebar", "advert", "notice", "form", "share"], 3, texts, draw) + (_other("footer", texts, draw) if draw.random() < 0.8 else "")
    whole = top + middle + end
    if draw.random() < 0.3:
        whole = f"<div{_named(draw, WRAPPERS)}>{whole}</div>"
    tail = "</body></html>" if draw.random() < 0.9 else ""
    return f"<!DOCTYPE html><html><head><title>{_words(texts, draw, 1, 9)}</title><style>p{{}}</style></head><body>{whole}{tail}"
