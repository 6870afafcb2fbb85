"""Made-up page layouts that the block labeller learns from.

A page is a list of blocks (tag path, text, linked characters, 1 for article). Containers
are drawn from the usual tags and class names of each part; ``odd`` names carry no meaning,
so the labeller does not rely on their absence.
"""

from __future__ import annotations

import random

import numpy as np

Block = tuple[tuple[str, ...], str, int, int]

# Class names by part of a page (fixed values).
PARTS = {
    "menu": "nav navigation navbar menu topnav breadcrumb breadcrumbs links toolbar tabs pagination pager",
    "header": "header masthead banner top topbar branding logo hero",
    "footer": "footer bottom copyright legal colophon imprint",
    "side": "sidebar side aside widget related recommended trending popular toc rail more tags",
    "notice": "cookie cookies consent notice alert popup modal gdpr overlay newsletter subscribe "
              "privacy message toast disclaimer",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion commercial adbox",
    "form": "form search login signup register contact poll survey",
    "comments": "comments comment commentlist discussion replies reply responses disqus respond feedback",
    "share": "share sharing social follow buttons tools",
}
BODY = ("content main article post entry story body text article-body post-content entry-content "
        "main-content story-body page blog news maincontent articlebody").split()
ODD = "wrap wrapper container row col inner outer box grid flex left right module block site x a b c".split()
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()

_draw = random.Random(11)
MADE_UP = ["".join(_draw.choices(SYLLABLES, k=_draw.randrange(1, 5))) for _ in range(4000)]


def page(rng: np.random.Generator) -> list[Block]:
    pick = lambda xs: xs[rng.integers(len(xs))]
    chance = lambda p: rng.random() < p

    def sentence(lo: int, hi: int) -> str:
        stop = pick(["", ".", ".", ".", "!", "?"])
        some = rng.integers(len(MADE_UP), size=rng.integers(lo, hi + 1))
        return " ".join([MADE_UP[i] for i in some]).capitalize() + stop

    def prose() -> str:
        return " ".join(sentence(1, 20) for _ in range(rng.integers(1, int(pick([2, 3, 6, 14])))))

    def names(text: str) -> tuple[str, ...]:
        return tuple(f".{x}" for x in text.split("-"))

    def odd() -> tuple[str, ...]:
        return ("div", *(names(pick(ODD)) if chance(0.7) else ())) if chance(0.3) else ()

    def classed(part: str, tags: list[str]) -> tuple[str, ...]:
        extra = names(pick(ODD)) if chance(0.2) else ()
        return (pick(tags), *names(pick(PARTS[part].split())), *extra)

    def listed(top: tuple[str, ...], lo: int, hi: int) -> list[Block]:
        kind = pick([("ul", "li", "a"), ("a",), ("ul", "li"), ("p", "a"), ("div", "a")])
        out = []
        for _ in range(rng.integers(lo, hi)):
            t = sentence(1, 3)
            out.append((top + kind, t, len(t) if "a" in kind else 0, 0))
        return out

    def plain(top: tuple[str, ...], lo: int, hi: int, long: bool = False) -> list[Block]:
        out = []
        for _ in range(rng.integers(lo, hi)):
            kind = pick([(), ("p",), ("span",), ("div",), ("h2",), ("h3",), ("p", "a"), ("ul", "li")])
            t = prose() if long and chance(0.6) else sentence(1, 14)
            out.append((top + kind, t, len(t) if "a" in kind else 0, 0))
        return out

    def menu(top):
        return listed(top + (("nav",) + (names(pick(ODD)) if chance(0.1) else ()) if chance(0.6)
                             else classed("menu", ["div", "ul", "section", "nav"])), 1, 12)

    def header(top):
        here = top + (("header",) if chance(0.6) else classed("header", ["div", "section", "header"]))
        return plain(here, 1, 4) + (menu(here) if chance(0.4) else [])

    def footer(top):
        here = top + (("footer",) if chance(0.6) else classed("footer", ["div", "section", "footer"]))
        return plain(here, 1, 4, True) + (listed(here, 1, 6) if chance(0.4) else [])

    def side(top):
        here = top + (("aside",) if chance(0.5) else classed("side", ["div", "aside", "section"]))
        return plain(here, 1, 5, True) + (listed(here, 1, 6) if chance(0.5) else [])

    def notice(top):
        return plain(top + classed("notice", ["div", "section", "p", "aside"]), 1, 4, True)

    def advert(top):
        return plain(top + classed("advert", ["div", "div", "aside", "section", "p"]), 1, 3, True)

    def form(top):
        here = top + (("form",) + (names(pick(PARTS["form"].split())) if chance(0.4) else ())
                      if chance(0.8) else classed("form", ["div", "section"]))
        return [(here + pick([("label",), ("button",), ("p",), ("fieldset", "legend"), ()]),
                 sentence(1, 8), 0, 0) for _ in range(rng.integers(1, 5))]

    def comments(top):
        here = top + classed("comments", ["div", "section", "ol", "ul"])
        out = [(here + (pick(["h2", "h3"]),), sentence(1, 4), 0, 0)] if chance(0.6) else []
        for _ in range(rng.integers(1, 7)):
            one = here + pick([("div", ".comment"), ("li",), ("article", ".comment"), ("div",),
                               ("li", ".comment"), ()])
            out += [(one + pick([("p",), ("div",), ()]), prose(), 0, 0)
                    for _ in range(rng.integers(1, 3))]
        return out

    def share(top):
        return listed(top + classed("share", ["div", "ul", "section"]), 1, 5)

    def article(top):
        here = top + pick([("article",), ("article",), ("main",), ("main", "article"),
                           ("article", *names(pick(BODY))), ("div", *names(pick(BODY))),
                           ("section", *names(pick(BODY))), ("main", "div", *names(pick(BODY))),
                           ("article", "div", *names(pick(BODY)))])
        head = here + (("header",) if chance(0.12) else ())
        out: list[Block] = []
        if chance(0.85):
            out.append((head + ("h1",), sentence(1, 14), 0, 1))
        wide = int(pick([1, 3, 8, 20]))
        for _ in range(rng.integers(1, wide + 2)):
            r = rng.random()
            if r < 0.54:
                inside = pick([("p",), ("p",), ("p",), ("p", "b"), ("p", "span"), ("p", "em"), ("div",), ()])
                t = prose() if chance(0.85) else sentence(1, 4)
                out.append((here + inside, t, int(len(t) * rng.random() * 0.4) if chance(0.2) else 0, 1))
            elif r < 0.64:
                out.append((here + (pick(["h2", "h3", "h4"]),), sentence(1, 8), 0, 1))
            elif r < 0.72:
                kind = pick([("ul", "li"), ("ol", "li"), ("dl", "dd"), ("ul", "li", "p")])
                out += [(here + kind, sentence(1, 15), 0, 1) for _ in range(rng.integers(1, 6))]
            elif r < 0.78:
                out.append((here + pick([("blockquote",), ("blockquote", "p"), ("pre",), ("figure", "figcaption")]),
                            prose(), 0, 1))
            elif r < 0.82:
                kind = ("table", "tbody", "tr", pick(["td", "td", "th"]))
                out += [(here + kind, sentence(1, 4), 0, 1) for _ in range(rng.integers(2, 9))]
            else:
                out += pick([advert, advert, side, share, notice, form, menu])(here)
        if chance(0.12):
            out += pick([comments, footer, share])(here)
        return out

    body = ("html", "body")
    wrap = body + odd()
    out: list[Block] = []
    before = [f for f, p in ((notice, 0.2), (header, 0.4), (menu, 0.7), (advert, 0.5), (form, 0.15),
                             (side, 0.15), (share, 0.1)) if chance(p)]
    after = [f for f, p in ((share, 0.15), (advert, 0.25), (comments, 0.35), (side, 0.3), (form, 0.2),
                            (menu, 0.1), (footer, 0.8), (notice, 0.2)) if chance(p)]
    for f in before:
        out += f(pick([body, wrap]))
    out += article(wrap) if chance(0.97) else []
    for f in after:
        out += f(pick([body, wrap]))
    return out
