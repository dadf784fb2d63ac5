"""Main texts: blocks, costs and the cut restated plainly, and pages in which the cut decides."""

import itertools
import random
import re
import time

import pytest

from gridloom.llm import mincut

LONG = "This is a sentence of some length that any article could have in it, and so it goes on."


def score(piece, marked, held, away):
    """Log odds of content, term by term."""
    node, n = piece.node, len(piece.text)
    heading, running = node.tag in {"h1", "h2", "h3", "h4", "h5", "h6"}, node.tag in {"p", "pre", "blockquote"}
    terms = [0.3, min(n, 200) / 100 - 0.6, -(1.5 if node.inside and not node.doubt else 3.5) * piece.linked / n, 0.8 if re.search(r"[.!?…。！？:;][\"'”’)\]]*$", piece.text) else -0.2]
    terms.append(2.5 if heading else 1.5 if running else -0.5 if node.tag in {"li", "td", "div", ""} else 0.0)
    if node.inside and not node.doubt:
        terms.append(2.0)
    elif marked:
        terms.append(-1.2)
    if node.doubt:
        terms.append(-(7.0 - min(held, 2000) / 400 - min(n, 300) / 300 - 1.5 * node.here))
    if away:
        terms.append(-7.0)
    if "©" in piece.text or "all rights reserved" in piece.text.lower():
        terms.append(-4.4)
    return sum(terms)


def energy(pieces, labels):
    """What a labelling costs."""
    loose = lambda p: len(p.text) - p.linked
    marked = any(p.node.inside and not p.node.doubt for p in pieces)
    counted = [p for p in pieces if p.node.form or not p.node.away]
    around = {p.node.form for p in counted if p.node.form and 2 * sum(loose(q) for q in counted if q.node.form == p.node.form) > sum(map(loose, counted))}
    total = 0.0
    for i, (p, content) in enumerate(zip(pieces, labels, strict=True)):
        away = p.node.away or bool(p.node.form) and p.node.form not in around
        s = score(p, marked, sum(loose(q) for q in pieces if q.node.doubt == p.node.doubt), away)
        total += max(-s, 0) if content else max(s, 0)
        if i and labels[i - 1] != content:
            q = pieces[i - 1]
            alike = (p.node.away, p.node.form, p.node.doubt) == (q.node.away, q.node.form, q.node.doubt)
            total += 5.0 * (p.shared / max(p.node.depth, q.node.depth)) ** 3 * (1 if alike else 0.25)
        before = [j for j in range(i) if max(pieces[j].node.up, 0) == max(p.node.up, 0)]
        if before and before[-1] != i - 1 and labels[before[-1]] != content:
            total += 0.4
    return total


def tree(rng, depth, said):
    """A random page as text, and its blocks (text, tag) read off the tree."""
    html, out, line = [], [], []

    def text(words):
        html.append(words)
        line.append(words)

    def end(tag):
        if "".join(line).split():
            out.append((" ".join("".join(line).split()), tag))
        line.clear()

    def grow(tag, level):
        for _ in range(rng.randrange(1, 4)):
            kind = rng.choice(["text", "text", "inline", "link", "hidden", "block", "gone"])
            if kind == "text":
                text(rng.choice([LONG, "Short", "© all of it.", " two  words "]) + " ")
            elif kind in ("inline", "link"):
                html.append("<b>" if kind == "inline" else "<a href=x>")
                text("marked ")
                html.append("</b>" if kind == "inline" else "</a>")
            elif kind == "hidden":
                html.append(rng.choice(["<span hidden>{}</span>", "<i style='display: none'>{}</i>", "<b aria-hidden=true>{}</b>"]).format("unseen words"))
            elif level < depth:
                end(tag)
                inner = rng.choice(["div", "section", "article", "nav", "footer", "ul", "h2", "form", "blockquote", "aside", "label"])
                name = rng.choice(["", "", " class=sidebar", " id=content"])
                html.append(f"<{inner}{name}{' hidden' if kind == 'gone' else ''}>")
                if kind == "gone":
                    html.append("never seen <p>nor this</p>")
                else:
                    grow(inner, level + 1)
                    end(inner)
                html.append(f"</{inner}>")

    grow("", 0)
    end("")
    return "".join(html), out


@pytest.mark.parametrize("seed", range(40))
def test_blocks_and_least_labelling(seed):
    page, want = tree(random.Random(seed), 4, [])
    pieces = mincut.blocks(page)
    assert [(p.text, p.node.home.tag if p.node.tag not in mincut.BLOCK else p.node.tag) for p in pieces] == want
    few = pieces[:11]
    found = mincut.content(few)
    best = min(energy(few, labels) for labels in itertools.product([False, True], repeat=len(few)))
    assert energy(few, found) == pytest.approx(best, abs=1e-6)


ARTICLE = f"<h1>A heading</h1><p>{LONG}</p><p>{LONG}</p><p>All rights reserved.</p><p>{LONG}</p>"
TEXT = "\n".join(["A heading", LONG, LONG, "All rights reserved.", LONG])


def test_neighbours_decide():
    """Each block by itself would lose a line of the article, or keep one of its surroundings; the cut does neither."""
    page = f"<nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer><p>All rights reserved.</p></footer>"
    pieces = mincut.blocks(page)
    alone, cut = mincut.content(pieces, smooth=0.0), mincut.content(pieces)
    assert alone != cut and mincut.main_text(page) == TEXT
    assert "\n".join(p.text for p, keep in zip(pieces, alone, strict=True) if keep) == TEXT.replace("All rights reserved.\n", "")
    # without marks, the lines between paragraphs and the short line after the last
    page = f"<div><p>{LONG}</p><div>Short words</div><div>More of them</div><p>{LONG}</p></div><div><div><div>Small print</div></div></div>"
    assert mincut.main_text(page) == "\n".join([LONG, "Short words", "More of them", LONG])
    pieces = mincut.blocks(page)
    assert mincut.content(pieces, smooth=0.0) != mincut.content(pieces)


def test_links_within_an_article():
    """A few links in a list are carried by the paragraphs around them, a menu and a long list of nothing but links are not."""
    page = lambda inner: f"<body><article><p>{LONG}</p>{inner}<p>{LONG}</p></article></body>"
    items = lambda n: "<ul>" + "<li><a href=x>A link to it</a></li>" * n + "</ul>"
    assert [mincut.main_text(page(items(n))).count("A link") for n in (1, 3, 20)] == [1, 3, 0]
    assert mincut.main_text(page(f"<nav>{items(3)}</nav>")) == f"{LONG}\n{LONG}"
    assert mincut.main_text(page(f"<ul>{'<li>An item</li>' * 20}</ul><table>{'<tr><td>7</td></tr>' * 20}</table>")).count("\n") == 41


@pytest.mark.parametrize("mark", ["hidden", "aria-hidden=true", "style='color:red; display:none'"])
def test_hidden_text_is_no_text(mark):
    assert mincut.main_text(f"<p>{LONG} <span {mark}>unseen <b>either</b></span>More.</p>") == f"{LONG} More."
    assert mincut.main_text(f"<article><p>{LONG}</p><div {mark}><p>{LONG}</p></div></article>") == LONG


def test_forms():
    article = f"<article><p>{LONG}</p><p>{LONG}</p></article>"
    assert mincut.main_text(f"<form id=page>{article}</form>") == f"{LONG}\n{LONG}"
    assert mincut.main_text(f"<form id=page><p>{LONG}</p><p>{LONG}</p><nav><a href=x>Menu</a></nav></form>") == f"{LONG}\n{LONG}"
    assert mincut.main_text(f"{article}<form><label>Your name</label><input><p>Your address is not shown to anyone.</p></form>") == f"{LONG}\n{LONG}"


def test_depth_and_length_take_time_in_proportion():
    took = []
    for n in (5_000, 20_000):
        start = time.process_time()
        assert mincut.main_text("<div>" * n + f"<p>{LONG}</p>") == LONG
        assert len(mincut.blocks("<div>x" * n)) == n
        took.append(time.process_time() - start)
    assert took[1] < 12 * took[0] + 0.5
    many = mincut.main_text("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>")
    assert many.count("\n") == 2999


def test_pages_as_rows(spark):
    rows = [(1, f"<p>{LONG}</p>", 7, "a"), (1, f"<p>{LONG}</p>", 7, "a"), (2, None, None, None), (None, "<p>" + "word " * 200_000 + ".</p>", 1, "b")]
    found = mincut.extract(spark.createDataFrame(rows, "page_id long, html string, node long, text string")).collect()
    assert [c for c in found[0].__fields__] == ["page_id", "html", "node", "text"]
    by = sorted(((r.page_id or 0, r.node, len(r.text)) for r in found), key=repr)
    assert by == sorted([(1, 7, len(LONG)), (1, 7, len(LONG)), (2, None, 0), (0, 1, 1_000_001)], key=repr)
