"""Ranked search, conversation repair and main text against brute force, and on awkward rows."""

import collections
import functools
import hashlib
import html
import math
import random
import re
import zlib
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from trackstrata.llm import conversations, html_text, ranked_search
from trackstrata.llm.queries import QUERIES

from ..conftest import SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


# --- ranked search --------------------------------------------------------------------------------


def ranked_plainly(docs, items, k):
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n, total = sum(bool(w) for _, w in terms), sum(len(w) for _, w in terms)
    df = collections.Counter(w for _, words in terms for w in set(words))
    wanted = collections.defaultdict(set)
    for item, text in items:
        wanted[item] |= set(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, query in wanted.items():
        scored = []
        for doc, words in terms:
            m, tf = 50 + 50 * len(words) * n // max(total, 1), collections.Counter(words)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 20 * m)) for w in query if tf[w])
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank + 1, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("short, block, size", [(0.125, 200_000, 2 << 20), (0.0, 10, 50), (1.0, 200_000, 300), (0.4, 5, 120)])
def test_ranked_search_against_brute_force(spark, short, block, size):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "née", "日本"]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n)).replace("w1 ", "W1-")
    docs = [(i if i % 17 else None, text(rng.randint(0, 40))) for i in range(150)] + [(900, None), (901, ""), (902, " ,. "), (3, "w5 w6 w7"), (3, "w5 w6 w7")]
    items = [(i, text(rng.randint(1, 8))) for i in range(12)] + [(50, None), (51, "nowhere"), (None, "w40 née"), (0, "w50 w50")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"ids": F.lit("x"), "rank": F.lit(1), "id": F.lit(2)}).repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = ranked_search.ranked_search(frame, asked, k=7, short_share=short, block_terms=block, index_bytes=size)
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_plainly(docs, items, 7)


def test_ranked_search_long_text_and_empty_tables(spark):
    rows, asked = [(1, "common " * 50_000 + "rare"), (2, "common rare"), (3, "x" * 200_000)], [(1, "rare common")]
    docs, items = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(asked, "item_id bigint, text string")
    assert sorted((tuple(r) for r in ranked_search.ranked_search(docs, items).collect()), key=str) == ranked_plainly(rows, asked, 50)
    assert ranked_search.ranked_search(docs, items.where("false")).count() == 0
    assert ranked_search.ranked_search(docs.where("false"), items).count() == 0


# --- conversation repair --------------------------------------------------------------------------


def repaired_plainly(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of rows (turn, role, text) in order, by trying every edit."""
    space = " \t\n\x0b\x0c\r"
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(space)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = {t for t, _, _ in rows if t is not None}

    @functools.cache
    def best(i, state, inserted):
        """(cost, audit, lines) from row i in a state, which is what was emitted last."""
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        follow = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[follow]
        if inserted < 3:
            cost, audit, lines = best(i, follow, inserted + 1)
            options.append((cost + 5, "I" + audit, (f"{name}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 2, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                cost, audit, lines = best(i + 1, follow, 0)
                options.append((cost + 1 + more, "R" + audit, (f"{name}:{text}", *lines)))
                if role[:1] == follow or (role[:1] == "s" and state == ""):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
        return min(options, default=(10**9, "~", ()))

    cost, audit, lines = best(0, "", 0)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def conversation(rng, n):
    roles, texts = ["user", "assistant", "system", "tool", "", "userish"], ["Yes.", "No!", "Why", "", " \n", "Long answer?", "ok . ", "ünd"]
    return [(rng.choice([None, i, i, i, i + 2]), rng.choices(roles, [6, 6, 2, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randint(0, 99)}.") for i in range(n)]


@pytest.mark.parametrize("piece_rows, partitions", [(200_000, 1), (200_000, 7), (3, 5), (1, 2)])
def test_repair_against_every_edit(spark, piece_rows, partitions):
    rng = random.Random(piece_rows + partitions)
    talks = {c: conversation(rng, rng.choice([1, 2, 3, 5, 8, 13])) for c in range(60)}
    talks[None], talks[1000] = conversation(rng, 6), conversation(rng, 90)
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"c": F.lit(1), "audit": F.lit("x"), "n": F.lit("y")})
        got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(frame, piece_rows=piece_rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {c: repaired_plainly(ordered(talk)) for c, talk in talks.items()}


def test_inserts_and_ties_among_arcs():
    """With dear deletions inserts are used, and the least of equal audits is found."""
    before = conversations.DELETE
    conversations.DELETE = 50
    try:
        s = conversations.Sequence(bytes([1, 1, 2, 0 | 4]), conversations.finish(), True)
        conversations.solve([s])
    finally:
        conversations.DELETE = before
    # u u a: a reroled row or an inserted answer between; 3 rows need an even number of lines
    assert s.paths == [("KIKKD", 3)] and s.cost == 55


def damaged_plainly(rows):
    out = collections.defaultdict(list)
    for c, t, role, text in rows:
        dice = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[c] += []
        if dice == 0:
            continue
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        out[c] += [(t, "user" if dice == 4 else role, text)] * (2 if dice == 3 else 1)
    return out


def test_repair_query_against_every_edit(spark, connection):
    rows = connection.sql("select conv_id, turn, role, text from conversations").fetchall()
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, SMALL).collect()}
    assert got == {c: repaired_plainly(ordered(talk)) if talk else (0,) * 6 + ("", hashlib.sha256().hexdigest()) for c, talk in damaged_plainly(rows).items()}


def test_repair_awkward(spark):
    ddl = "conv_id string, turn bigint, role string, text string, times int"
    rows = [("a", 1, None, None, 1), ("a", None, "user", "x" * 300_000 + ".", 1), ("b", 1, "user", "Hi.", 0), ("d", 1, "user", "Hi.", 100_000), ("d", 2, "assistant", "Yes.", None), ("d", 2, "assistant", "Yes.", 1)]
    frame = spark.createDataFrame(rows, ddl)
    got = {r.conv_id: r for r in conversations.repair(frame, times="times", piece_rows=1000).collect()}
    assert got["b"].audit == "" and got["b"].repaired_sha256 == hashlib.sha256().hexdigest() and got["b"].cost == 0
    assert got["d"].audit == "K" + "D" * 99_999 + "K" and got["d"].duplicate == 99_999 and got["d"].illegal == 99_999
    assert got["a"].audit == "DD" and (got["a"].blank, got["a"].gaps) == (1, 0)
    assert conversations.repair(frame.where("false")).count() == 0


# --- main text ------------------------------------------------------------------------------------


class Plain(HTMLParser):
    """The text of the article element of a page of the test tables."""

    def __init__(self):
        super().__init__()
        self.out, self.inside = [], 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.out.append(" " if self.inside and tag in ("p", "h1", "br") else "")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.out.append(" " if self.inside and tag in ("p", "h1") else "")

    def handle_data(self, data):
        self.out.append(data if self.inside else "")


def test_main_text_of_every_page(spark, connection):
    pages = connection.sql("select page_id, url, html from pages").fetchall()
    got = {r.page_id: r for r in QUERIES["op13_main_text"](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        plain = Plain()
        plain.feed(page)
        plain.close()
        text = " ".join("".join(plain.out).split())
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, text, len(text))


def site(number, body, host="site.example"):
    return (number, f"https://{host}/p{number}", f"<html><head><title>t</title></head><body>{body}</body></html>")


def texts(spark, rows, **how):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_text.main_text(frame, **how).collect()}


def test_site_template_without_telling_markup(spark):
    """Menus and footers in plain divs are found by recurrence, per host, and unique text stays."""
    rng = random.Random(1)
    story = lambda n: " ".join(f"s{n}x{rng.randint(0, 999)}" for _ in range(40))
    menu, foot = "<div><span>Home</span> <a href='/x%d'>Shop</a></div>", "<div>All rights reserved</div>"
    body = {n: story(n) for n in range(6)}
    rows = [site(n, menu % n + f"<div><p>{body[n]}</p></div>" + foot) for n in range(6)]
    rows += [site(10, menu % 1 + f"<div><p>{body[0]} other</p></div>", "alone.example")]
    got = texts(spark, rows)
    assert all(got[n] == body[n] for n in range(6))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {(r.n_template, r.n_markup) for r in html_text.main_text(frame).where("page_id < 6").collect()} == {(2, 0)}
    assert got[10] == f"Home Shop {body[0]} other"  # one page of a host is no template


def test_shared_passages_and_copies_stay(spark):
    shared = "A passage that many articles of this site quote word for word, as they may."
    pages = [site(n, f"<article><h1>Title {n}</h1><p>{shared}</p><p>Own words {n} " + f"w{n} " * 30 + "</p><div>Like this post</div></article>") for n in range(4)]
    copies = [site(n, "<article><h1>Same</h1><p>The same article, again and again.</p><p>And its end.</p></article>", "copies.example") for n in range(20, 30)]
    got = texts(spark, pages + copies)
    assert all(shared in got[n] for n in range(4))
    assert all(got[n] == "Same The same article, again and again. And its end." for n in range(20, 30))
    # on most pages of the host it is part of the template
    many = [site(n, f"<article><h1>Title {n}</h1><p>Own words {n} " + f"w{n} " * 30 + "</p><div>Like this post</div></article>") for n in range(40, 46)]
    assert texts(spark, many)[40] == "Title 40 Own words 40 " + ("w40 " * 30).strip()


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>a{}</style><script>if (a < b) document.write("</p>x")</script></head>
<body class="has-sidebar"><header>Site name</header><div class="nav-bar menu">Menu</div><form><main><article class="post">
<header><h1>A&nbsp;title &amp; more</h1><span>By me</span></header><p>One<b>two</b> three<br>four<p>Five <i>six</i></p>
<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><div class="ad">Buy</div><!-- hidden --><aside>Side</aside><p hidden>Gone</p>
<div id="comments"><article>Nice!</article></div><footer>Filed</footer></article><div class="related">Other</div></main></form>
<div class="cookie-notice">Cookies</div><footer>&copy; us</footer><textarea>t</textarea>"""


def test_main_text_markup(spark):
    got = texts(spark, [(1, "https://a.example/", PAGE)])
    assert got[1] == "A title & more Onetwo three four Five six a b c d"


def test_main_text_awkward(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", "no markup &lt;here&gt; < 5 > 4"), (3, "x", "no markup &lt;here&gt; < 5 > 4"), (None, "https://h/", "<p>a<p>b"), (5, "https://h/", "<div>" * 3000 + "deep" + " &#x1F600;" * 50_000), (6, "https://h/", "<a " * 20_000), (7, "https://h/", "<script>never closed <p>x"), (8, "https://h/", "<p>cut <b>off</b> <a href='x"), (9, "https://h/", "1 < 2 <!-- no end <p>x</p>")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("clash") for c in ("text", "row", "runs", "kept", "site", "keys", "n_chars")})
    got = html_text.main_text(frame)
    assert got.columns == ["page_id", "url", "html", "row", "runs", "kept", "site", "keys", "text", "n_chars", "n_template", "n_markup"]
    found = {(r.page_id, r.html): r for r in got.collect()}
    assert len(got.collect()) == 10 and all(r.runs == "clash" for r in found.values())
    by_id = {k[0]: r.text for k, r in found.items()}
    assert by_id[1] == by_id[2] == by_id[7] == "" and by_id[3] == "no markup <here> < 5 > 4" and by_id[None] == "a b"
    assert by_id[6] == "" and by_id[8] == "cut off" and by_id[9] == "1 < 2"
    assert by_id[5] == "deep" + " \U0001f600" * 50_000 and html.unescape("&lt;") == "<"
    assert html_text.main_text(frame.where("false")).count() == 0
