"""Ranked search, phrase mining and page extraction against brute force, and on odd input."""

import collections
import html
import math
import random
import re

import numpy as np
import pytest

from massloom.llm import double_array, page_extract, page_layouts, phrase_mining, shared_search
from massloom.llm.page_blocks import blocks

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like results and helpers."""
    texts = [
        (1, "alpha beta gamma"),
        (2, "Alpha, beta; gamma"),
        (2, "Alpha, beta; gamma"),
        (3, None),
        (4, ""),
        (5, " \t\n.,!"),
        (None, "alpha beta gamma"),
        (6, "x" * 300_000),
        (7, "ab cd " * 60_000),
        (8, "Ünïcode ÜNÏCODE wide \x00 null"),
    ]
    extra = "score long, rank int, n long, item int, block int, word string, ids binary, part int"
    rows = [(i, t, None if k == 1 else "de" if k % 2 else "und", *([None] * 8)) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {extra}")


# --- double-array tries


@pytest.mark.parametrize("length", [1, 2, 3])
def test_trie_finds_just_its_sequences(length):
    draw = np.random.default_rng(length)
    # A third of all sequences start with one symbol, and one has children without end.
    rows = draw.integers(0, 400, (6000, length))
    rows[::3, 0] = 7
    words = np.unique(rows, axis=0).astype(np.int32)
    trie = double_array.build(words)
    asked = draw.integers(0, 410, (20_000, length)).astype(np.int32)
    asked[::2] = words[draw.integers(0, len(words), 10_000)]
    at, states = double_array.walk(trie, list(asked.T))
    known = set(map(tuple, words.tolist()))
    assert set(at.tolist()) == {k for k, row in enumerate(asked.tolist()) if tuple(row) in known}
    assert len(set(trie.accepts.tolist())) == len(words)
    place = {int(s): tuple(w) for s, w in zip(trie.accepts, trie.words.tolist())}
    assert all(place[int(s)] == tuple(asked[k]) for k, s in zip(at, states))


# --- phrase mining


def phrases(rows, top=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for at in range(len(words) - k + 1):
                    counts[lang][tuple(words[at : at + k])] += 1
    out = set()
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        scored = []
        for p, a in kept.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in kept.items() if len(q) > 2 and len(p) == 2):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("top", [2000, 7])
def test_phrases_equal_brute_force(docs, top, monkeypatch):
    # Small tries, blocks and chunks, so that there are many of each.
    monkeypatch.setattr(phrase_mining, "PHRASES_A_TRIE", 20)
    monkeypatch.setattr(phrase_mining, "TRIES_A_PASS", 2)
    monkeypatch.setattr(phrase_mining, "WORDS_A_BLOCK", 50)
    got = [tuple(r) for r in phrase_mining.collocations(docs, top).collect()]
    assert len(got) == len(set(got)) and set(got) == phrases([(r.lang, r.text) for r in docs.collect()], top)


def test_phrases_of_odd_rows(odd):
    got = {tuple(r) for r in phrase_mining.collocations(odd).collect()}
    assert got == phrases([(r.lang, r.text) for r in odd.collect()]) and got
    assert phrase_mining.collocations(odd.where("false")).count() == 0


def test_phrase_scores_pass_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 900_000_000_000_007, 900_000_000_000_011, 900_000_000_000_009
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrase_mining._score("a", "l", "r")).first()
    assert row[0] == 1_000_000 * a * a // (left * right)


# --- ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, top=20):
    rows = [(i, collections.Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    count, length = len(rows), sum(n for _, _, n in rows)
    df = collections.Counter(w for _, c, _ in rows for w in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c, n in rows:
            m = 100 - 25 + 25 * n * count // length
            s = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 12 * m))
                for w in terms(text)
                if w in c
            )
            scores.append((-s, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("chars", [1_000_000, 900])
def test_search_equals_brute_force(spark, sf, docs, chars, monkeypatch):
    monkeypatch.setattr(shared_search, "BLOCK_CHARS", chars)
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    got = sorted((tuple(r) for r in shared_search.search(docs, items).collect()), key=repr)
    assert got == ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_search_of_odd_rows(spark, odd):
    asked = [(1, "alpha ALPHA beta"), (1, "alpha ALPHA beta"), (2, None), (3, ""), (None, "gamma"), (4, "nowhere"), (5, "ab cd"), (6, "ünïcode")]
    items = spark.createDataFrame([(*x, 1, 1) for x in asked], "item_id long, text string, score int, doc_id int")
    got = sorted((tuple(r) for r in shared_search.search(odd, items, 3).collect()), key=repr)
    assert got == ranked([(r.doc_id, r.text) for r in odd.collect()], asked, 3)
    assert shared_search.search(odd.where("false"), items).count() == shared_search.search(odd, items.where("false")).count() == 0


def test_plan_shares_and_adds_up():
    draw = random.Random(5)
    common = [f"c{k}" for k in range(12)]
    items = [(k, " ".join(draw.sample(common, 8) + [f"own{k}"] + ["twice"] * (1 + k % 2))) for k in range(60)]
    graph = shared_search.plan(items)
    leaves = [np.array([1 << k], dtype=object) for k in range(len(graph.terms))]
    for place, total in shared_search.accumulate(graph, leaves):
        assert total[0] == sum(1 << graph.terms.index(w.encode()) for w in terms(items[place][1]))
    added = len(graph.nodes) + sum(len(r) - 1 for r in graph.roots)
    assert graph.nodes and added < 0.8 * sum(len(terms(t)) - 1 for _, t in items)


# --- pages


@pytest.fixture(scope="module")
def pages(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return page_extract.fit(pages)


def by_hand(page):
    """The article of the test tables' pages, cut at its tags."""
    inside = re.search("<article>(.*?)</article>", page, re.DOTALL)[1].replace("<br>", " ")
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(x for x in parts if x)


def test_pages_equal_articles(pages, field):
    rows = {r.page_id: r for r in pages.collect()}
    got = page_extract.extract(pages, field).collect()
    assert len(got) == len(rows)
    assert all(r.text == by_hand(rows[r.page_id].html) and r.n_chars == len(r.text) for r in got)


def test_pages_of_other_layouts(field, pages):
    lent = [b.text for r in pages.limit(50).collect() for b in blocks(r.html)]
    draw, labeller = random.Random(77), page_extract.Labeller(field)
    made = [blocks(page_layouts.page(lent, draw)) for _ in range(300)]
    right = [a == int(b.main) for page in made for a, b in zip(labeller.labels(page), page)]
    assert sum(right) / len(right) > 0.985


def test_page_written_by_hand(field):
    page = """<html><head><title>Not this</title><script>if (a < b) document.write("<p>no</p>")</script></head><body class=home>
    <header class="site-header"><h1>The Daily</h1><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></header>
    <div id="cookie-consent">We use cookies. <button>Fine</button></div>
    <aside class="sidebar"><h3>Popular</h3><ul><li><a href=/a>One thing</a></li></ul></aside>
    <main><article class="post"><h1>Cats &amp; dogs</h1><p>First  <b>bold</b>text&nbsp;here,
    with a line<br>end &lt;b&gt; &#x41;.<p>Second one.</p><div class="ad">Buy this now</div><ul><li>An item<li>Another item</ul><p>Last words.</p></article>
    <section id="comments" class="comments"><h3>2 comments</h3><div class="comment"><p>I do not think so, said the reader.</p></div>
    <form class="comment-form"><label>Name</label><textarea>Write</textarea></form></section></main>
    <footer>&copy; 2024 The Daily</footer></body></html>"""
    assert page_extract.Labeller(field).text(page).split("\n") == [
        "Cats & dogs",
        "First boldtext here, with a line end <b> A.",
        "Second one.",
        "An item",
        "Another item",
        "Last words.",
    ]


def test_blocks_of_broken_pages():
    texts = lambda page: [b.text for b in blocks(page)]
    assert texts("a < b & c &am <p>d</p") == ["a < b & c &am", "d</p"]
    assert texts('<div class="x>y">one</span></i></div></div>two<!-- three') == ["one", "two"]
    assert texts("<p>one<script>var a='</p>'; <p>two") == ["one"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert texts("<h2>a</h3>b<hr>c<br>d") == ["a", "b", "c d"]
    assert texts("") == texts("<div><p></p> &nbsp;\n</div>") == []
    assert [b.path[-1].tag for b in blocks("<div><p>a<b>b<div>c</div>d")] == ["p", "div", "div"]
    assert blocks("<a href=x>all linked</a> and not")[0].linked == pytest.approx(10 / 18)


def test_viterbi_is_the_best_chain():
    draw = np.random.default_rng(3)
    import itertools

    for n in (1, 2, 7):
        scores = [tuple(x) for x in draw.normal(size=(n, 2)).tolist()]
        f = page_extract.Field(np.zeros((1, 2)), draw.normal(size=(2, 2)), draw.normal(size=2), draw.normal(size=2))

        def worth(labels):
            inside = sum(s[c] for s, c in zip(scores, labels)) + sum(f.steps[a, b] for a, b in zip(labels, labels[1:]))
            return inside + f.first[labels[0]] + f.last[labels[-1]]

        assert tuple(page_extract.decode(f, scores)) == max(itertools.product((0, 1), repeat=n), key=worth)


def test_odd_pages(spark, field):
    long = "<article>" + "<p>word word word, word.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "u", "plain"), (3, None, long), (4, "u", "<" * 5000), (5, "u", "<nav>Menu</nav>")]
    pages = spark.createDataFrame([(*r, "old", 1, 2) for r in rows], "page_id long, url string, html string, text string, n_chars int, `a b` int")
    got = page_extract.extract(pages, field)
    assert got.columns == ["page_id", "url", "a b", "text", "n_chars"]
    by = collections.defaultdict(list)
    for r in got.collect():
        by[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert by[1] == ["", ""] and by[None] == [""] and by[5] == [""] and by[3] == ["\n".join(["word word word, word."] * 20_000)]
    assert len(by[4]) == len(by[2]) == 1
    empty = pages.where("false")
    assert page_extract.extract(empty, page_extract.fit(empty, layouts=20)).count() == 0
