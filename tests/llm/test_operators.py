"""The corpus operators against brute force on small fixtures, and on awkward rows."""

import collections
import hashlib
import random
import re
import zlib
from importlib.metadata import files

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crosscheck.compare import difference, duck
from trackstrata.llm import classifier, decontaminate, language_id, licenses, near_dup, packing, pii, quality_rules, url_filter, warc
from trackstrata.llm.common import stored
from trackstrata.llm.queries import ORACLE, QUERIES, tokenizer_path

from ..conftest import SMALL

LONG = "word " * 60_000 + "x" * 100_000 + " 1.2.3.4" * 500
AWKWARD = [
    (1, None, None, "s"),
    (2, "", "en", None),
    (3, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s"),
    (3, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s"),
    (None, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s"),
    (5, LONG, "en", "s"),
    (6, "!!! ###\n\n\t", "de", "s"),
    (7, "mail bob.smith@mail.example.com or +1 (269) 555-3296 now", "de", "s"),
]
DDL = "doc_id bigint, text string, lang string, source string"
CLASH = ["score", "predicted", "lang_pred", "n_words", "kept", "verdict", "class_id", "n_hit", "spans", "license", "hits", "items"]


@pytest.fixture(scope="module")
def awkward(spark):
    docs = spark.createDataFrame(AWKWARD, DDL)
    return docs.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.where("false")


def documents(connection):
    return connection.sql("select doc_id, text, lang from documents order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_twin(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLE[name]) is None


def test_quality_base_and_verdict(spark, connection):
    words, rows = re.compile(r"[^\x20\x09-\x0D]+"), {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, SMALL).collect()}
    assert len(rows) == connection.sql("select count(*) from documents").fetchall()[0][0]
    for doc_id, text, _ in documents(connection):
        w, seen, covered = words.findall(text or ""), collections.defaultdict(list), set()
        for i in range(len(w) - 7):
            seen[tuple(w[i : i + 8])].append(i)
        for places in seen.values():
            if len(places) > 1:
                covered.update(p for i in places for p in range(i, i + 8))
        lines = [x for x in (text or "").split("\n") if words.search(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered), failed)
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or "")) and not (r.base_failed and r.kept)


def test_quality_js_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.4, 0.5]
    mid = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * np.log2(a / m) for a, m in zip(x, mid) if a)
    got = spark.sql(f"select {quality_rules.js_distance('array(0.5D, 0.5D, 0D)', 'array(0.1D, 0.4D, 0.5D)')} as d").first().d
    assert got == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))


def _prose(rng, common, letters, words, share=0.29):
    weights = [1 / (i + 1) for i in range(len(common))]
    return " ".join(rng.choices(common, weights)[0] if rng.random() < share else "".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(words))


def test_quality_drops_texts_without_common_words(spark):
    rng = random.Random(7)
    common = {"a": [f"{x}{y}" for x in "bdfg" for y in "aeiouy"], "b": [f"{y}{x}" for x in "klmn" for y in "aeiouy"]}
    rows = [(i, _prose(rng, common[lang], "aeioubdfgklmn", 120), lang) for i, lang in enumerate(["a", "b"] * 60)]
    rows += [(1000, _prose(rng, common["a"], "aeioubdfgklmn", 100, share=0), "a"), (1001, _prose(rng, common["a"], "aeioubdfgklmn", 60, share=0), "a")]
    got = {r.doc_id: r for r in quality_rules.divergence(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not got[1000].kept and not got[1001].kept and not got[1000].base_failed and got[1000].word_distance < 0.5
    assert all(got[i].kept for i in range(120))


def test_quality_references_of_every_language(spark):
    rng = random.Random(3)
    common = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(24)] for _ in range(70)]
    rows = [(i, _prose(rng, common[i % 70], "abcdefghijklmnopqrstuvwxyz", 120, share=0.6), f"l{i % 70:02}") for i in range(280)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(quality_rules.language_references(docs)) == sorted({lang for _, _, lang in rows})
    assert all(r.kept for r in quality_rules.divergence(docs).collect())


def test_quality_awkward(awkward, empty):
    rows = quality_rules.divergence(awkward).where("kept or not kept").collect()
    assert len(rows) == len(AWKWARD) and {r.n_words for r in rows if r.doc_id in (1, 2)} == {0}
    assert quality_rules.divergence(empty).count() == 0


def test_glob_automaton_against_regex():
    random.seed(3)
    globs = ["".join(random.choice(["a", "b", "/", "*", "**", "?", "."]) for _ in range(random.randint(1, 30))) for _ in range(40)]
    rules = [url_filter.Rule(g, "block", g, i) for i, g in enumerate(globs)]
    texts = ["".join(random.choice("ab/.") for _ in range(random.randint(0, 25))) for _ in range(400)] + [""]

    def pattern(glob):
        parts = re.findall(r"\*\*|\*|\?|.", glob)
        return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "."}.get(p, re.escape(p)) for p in parts), re.S)

    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    won = url_filter.GlobAutomaton(rules).match(np.frombuffer(b"".join(data), np.uint8), offsets)
    for text, got in zip(texts, won):
        assert got == max([i for i, g in enumerate(globs) if pattern(g).fullmatch(text)], default=-1)


def test_urls_awkward(spark):
    rows = [(1, None), (2, ""), (3, "no-scheme.net/x"), (4, "HTTP://WWW.Example.NET/en/x?q#f"), (5, "http://a.net"), (6, "http://b.com/a.net/" + "x" * 50_000), (6, "http://b.com/a.net/")]
    urls = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({"rule": F.lit("clash"), "host": F.lit(1)})
    rules = [*url_filter.domain_rules("net", "/", "block"), *url_filter.domain_rules("example.net", "/en/", "allow"), *url_filter.domain_rules("b.com", "", "block")]
    got = [(r.page_id, r.host, r.rule, r.verdict) for r in url_filter.filter_urls(urls, rules).orderBy("page_id").collect()]
    assert got[:5] == [(1, "", None, "allow"), (2, "", None, "allow"), (3, "", None, "allow"), (4, "www.example.net", "example.net/en/", "allow"), (5, "a.net", None, "allow")]
    assert [g[2:] for g in got[5:]] == [("b.com", "block")] * 2
    assert url_filter.filter_urls(urls.where("false"), rules).count() == 0


def test_language_held_out_accuracy(spark, connection):
    truth = dict((d, lang) for d, _, lang in documents(connection))
    rows = [r for r in QUERIES["op3_language_id"](spark, SMALL).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) > 0.9 * len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)


def test_language_learns_every_language_and_short_texts(spark):
    rng = random.Random(11)
    pairs = ["".join(p) for p in rng.sample([(a, b) for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"], 280)]
    words = {f"l{i:02}": pairs[4 * i : 4 * i + 4] for i in range(70)}
    rows = [(i, " ".join(rng.choices(words[lang], k=20)), lang) for i, lang in enumerate([*words] * 12)]
    assert all(len(text) < language_id.STEPS for _, text, _ in rows)
    docs = spark.createDataFrame([*rows, (None, "", "l00"), (-1, "ab", None)], "doc_id bigint, text string, lang string")
    model = language_id.train_languages(docs, usable=F.lit(True), epochs=40)
    assert set(model.languages) == set(words)
    right = [r.lang_pred == r.lang for r in language_id.predict_languages(docs, model).where("lang is not null and text != ''").collect()]
    assert sum(right) > 0.9 * len(right) == 0.9 * 840


def test_language_gradient_of_shorter_sequences():
    """A padded batch has the gradients of its sequences on their own."""
    rng = np.random.default_rng(2)
    H, k = language_id.HIDDEN, 3
    shapes = {"ef": (256, 3 * H), "eb": (256, 3 * H), "rf": (H, 3 * H), "rb": (H, 3 * H), "o": (2 * H, k), "b": (k,)}
    p = {n: rng.normal(0, 0.5, s) for n, s in shapes.items()}
    x, y, w, size = rng.integers(0, 4, (7, 4)), np.array([0, 1, 2, 1]), np.full(4, 0.25), np.array([7, 3, 1, 5])
    together = language_id._through_time(p, x, y, w, size)
    alone = [language_id._through_time(p, x[:n, i : i + 1], y[i : i + 1], w[i : i + 1]) for i, n in enumerate(size)]
    for name, g in together.items():
        assert g == pytest.approx(sum(a[name] for a in alone), abs=1e-5)


def test_language_gradient():
    rng = np.random.default_rng(1)
    H, k = language_id.HIDDEN, 3
    shapes = {"ef": (256, 3 * H), "eb": (256, 3 * H), "rf": (H, 3 * H), "rb": (H, 3 * H), "o": (2 * H, k), "b": (k,)}
    p = {n: rng.normal(0, 0.5, s) for n, s in shapes.items()}
    x, y, w = rng.integers(0, 4, (7, 5)), np.array([0, 1, 2, 1, 0]), np.full(5, 0.2)

    def loss(q):
        model = language_id.BiGru(("a", "b", "c"), (q["ef"], q["eb"]), (q["rf"], q["rb"]), q["o"], q["b"])
        total = 0
        for i in range(5):
            states = []
            for way in (0, 1):
                h, out = np.zeros((H, 1)), [None] * 7
                for t in range(7) if way == 0 else range(6, -1, -1):
                    h = language_id._cell(model.embed[way][x[t, i]][:, None].copy(), h, model.recur[way].T)
                    out[t] = h[:, 0]
                states.append(out)
            for t in range(7):
                z = np.concatenate([states[0][t], states[1][t]]) @ q["o"] + q["b"]
                total -= w[i] / 7 * (z[y[i]] - np.log(np.exp(z).sum()))
        return total

    grads = language_id._through_time(p, x, y, w)
    for name, at in (("ef", (2, 3)), ("eb", (1, 12)), ("rf", (2, 20)), ("rb", (3, 9)), ("o", (5, 1)), ("b", (2,)), ("ef", (0, 17))):
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert grads[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=2e-5)


def test_language_awkward(awkward, empty):
    model = language_id.fit([b"the of and that " * 20, b"der die das und " * 20], ["en", "de"], epochs=3)
    got = language_id.predict_languages(awkward, model).collect()
    assert len(got) == len(AWKWARD) and all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 6))
    assert language_id.predict_languages(empty, model).count() == 0
    nothing = language_id.train_languages(empty, usable=F.lit(True))
    assert {r.lang_pred for r in language_id.predict_languages(awkward, nothing).collect()} == {"und"}


def _luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def _base(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text, re.A):
            digits = re.sub("[^0-9]", "", m.group())
            valid = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}
            if valid[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_spans(spark):
    random.seed(5)
    alphabet = ["@", ".", "a", "b_", "1", "4111 1111 1111 1111", "255", "0", "256", "-", " ", "+1", "(269)", "555-3296", "é", "%", "x@y.z", "10.0.0.1"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(300)]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for r in rows:
        base = _base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % s for s in base).encode()).hexdigest(), texts[r.doc_id]
        assert [(s.kind, s.start, s.end) for s in r.all_spans][: len(base)] == base


def test_pii_bootstraps_unseen_identifiers(spark):
    known = [(i, f"please call user{i}@mail.example.com today and read chapter {i} of it") for i in range(30)]
    unseen = [(100 + i, f"please call KEY{i}SECRET99 today") for i in range(3)]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(known + unseen, "doc_id bigint, text string")).collect()}
    assert all(found[i].n_found == 1 and found[i].spans == f"id:12:{12 + len(f'KEY{i - 100}SECRET99')}" for i in (100, 101, 102))
    assert all(found[i].n_found == 0 for i in range(30))


def test_pii_finds_handles_and_leaves_prose(spark):
    rows = [(i, f"please call user{i}@mail.example.com today") for i in range(30)]
    rows += [(40, "please call bobsmithhandle today"), (41, "so (please call: bobsmithhandle, today)")]
    rows += [(50 + i, f"see chapter {i} of the licence, version 3. of {w} and call your mother") for i, w in enumerate(["it", "them", "us", "all", "these"])]
    rows += [(60 + i, f"{w} token = zz{i}f{i}9{i}99 {w} said so") for i, w in enumerate(["one", "two", "three", "four"])]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[40].spans == "id:12:26" and found[41].n_found == 1
    assert all(found[i].n_found == 0 for i in range(30)) and all(found[50 + i].n_found == 0 for i in range(5))
    # an everyday word in the slot takes the pattern's confidence
    rows += [(100 + i, f"please call {w} today") for i, w in enumerate(["me", "her", "them", "us", "home", "again"] * 6)]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(found[i].n_found == 0 for i in (40, 41, *range(100, 136)))


def pii_scores_plainly(found):
    """Known names after each round, by plain loops over the occurrences (name, seed, affix, left, right)."""
    contexts = {(p + v, n, s, o) for n, s, a, l, r in found for p, v, o in (("L:", l, r), ("R:", r, l), ("P:", a, f"{l} {r}")) if v}
    known = set()
    for _ in range(pii.ROUNDS):
        total, sure, names = collections.Counter(), collections.Counter(), collections.defaultdict(set)
        own, own_sure, seeds = collections.Counter(), collections.Counter(), {n for _, n, s, _ in contexts if s}
        for p, n, s, _ in contexts:
            total[p] += 1
            own[p, n] += 1
            names[p].add(n)
            sure[p] += n in seeds | known
            own_sure[p, n] += n in seeds | known
        heard = collections.defaultdict(list)
        for (p, n), k in own.items():
            if n in seeds or total[p] < pii.MIN_SUPPORT:
                continue
            trust = (sure[p] - own_sure[p, n]) / (total[p] - k + 1)
            if trust >= pii.NO_DOUBT or len(names[p]) < pii.OPEN_CLASS * total[p]:
                heard[n].append((trust, k))
        known = {n for n, h in heard.items() if sum(t * k for t, k in h) / sum(k for _, k in h) >= pii.MIN_SCORE and max(h)[0] >= pii.MIN_CONFIDENCE}
    return known


def test_pii_graph_scores_against_plain_loops(spark):
    rng = random.Random(11)
    words = list("abcdefgh")
    names = {f"{rng.choice(['x', 'yy', '', 'zzzz'])}{i}": i % 4 > 0 for i in range(60)}
    found = [(n, s, re.match(r"^[^0-9]{0,4}", n)[0], rng.choice(words), rng.choice(words + [""])) for n, s in names.items() for _ in range(rng.randint(1, 6))]
    got, _ = pii.bootstrap(spark.createDataFrame(found, "name string, seed boolean, affix string, left string, right string"))
    expected = pii_scores_plainly(found)
    assert expected and {r.name for r in got.collect()} == expected


def test_pii_awkward_and_masked(spark, awkward, empty):
    found = pii.find_pii(awkward)
    masked = {r.doc_id: r.t for r in found.select("doc_id", pii.masked(found).alias("t")).collect()}
    assert masked[1] is None and masked[2] == "" and masked[7] == "mail <email> or <phone> now" and "1.2.3.4" not in masked[5]
    assert found.count() == len(AWKWARD) and pii.find_pii(empty).count() == 0
    deep = spark.createDataFrame([(1, "a." * 200_000 + "@" + "b." * 200_000), (2, "1" * 300_000), (3, "1 " * 200_000)], "doc_id bigint, text string")
    assert pii.find_pii(deep).count() == 3


def test_decontaminate_blocks_agree(spark):
    random.seed(2)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(random.choices(words, k=random.randint(0, 80))), "x") for i in range(60)]
    items = [(i, " ".join(random.choice(docs)[1].split()[:14]) + " " + random.choice(words)) for i in range(25)] + [(25, "w1 w2"), (26, None), (None, "w3"), (27, "")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string, n_hit string"), spark.createDataFrame(items, "item_id bigint, text string")
    one = decontaminate.decontaminate(d, b).orderBy("doc_id").collect()
    several = decontaminate.decontaminate(d, b, block_words=20).orderBy("doc_id").collect()
    assert [(r.n_hit, r.hits, r.items) for r in one] == [(r.n_hit, r.hits, r.items) for r in several]
    for r in one:
        w, hit, found = docs[r.doc_id][1].split(), set(), set()
        for item, text in items:
            t = (text or "").split()
            n = min(10, len(t))
            for k in range(len(t) - n + 1) if n else ():
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == t[k : k + n]:
                        hit.update(range(i, i + n))
                        found.add("null" if item is None else str(item))
        assert (r.hits, r.items) == (sorted(hit), sorted(found)) and r.n_near_items >= r.n_items


def test_decontaminate_awkward(spark, awkward, empty):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the river")], "item_id bigint, text string")
    rows = decontaminate.decontaminate(awkward, items).collect()
    assert sorted(str(r.doc_id) for r in rows if r.contaminated) == ["3", "3", "None"] and len(rows) == len(AWKWARD)
    assert decontaminate.decontaminate(empty, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.decontaminate(awkward, items.where("false")).collect())


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 100
    rows = [(5, "http://a", big), (2, "http://b\r\nX: y", big), (2, "http://b2", big), (None, None, big), (7, "u", None), (8, "u", ""), (9, "u", "small"), (10, "u", "small"), (11, "u", LONG)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    warc.write_archive(pages, str(tmp_path / "a"))
    back = warc.read_archive(spark, str(tmp_path / "a")).collect()
    assert len(back) == len(rows) and spark.read.parquet(str(tmp_path / "a/payloads")).count() == 4
    assert sorted((str(r.id), r.payload.decode()) for r in back) == sorted((str(i), h or "") for i, _, h in rows)
    kinds = collections.Counter((r.id, r.record_type, r.refers_to) for r in back)
    assert kinds[("2", "response", None)] == 2 and kinds[("5", "revisit", "2")] == 1 and kinds[(None, "revisit", "2")] == 1 and kinds[("10", "response", None)] == 1
    warc.export_warc(spark, str(tmp_path / "a"), str(tmp_path / "files"))
    text = "".join(f.read_text(newline="") for f in sorted((tmp_path / "files").glob("part-*")))
    assert text.count("WARC/1.1\r\n") == len(rows) and big in text
    warc.write_archive(pages.where("false"), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_licenses(spark):
    files = [
        ("a/LICENSE", licenses.TEMPLATES["Apache-2.0"]), ("a/b/c/x.py", "print(1)"), ("a/b/COPYING", licenses.TEMPLATES["GPL-3.0"]), ("a/y.py", "code\n" + licenses.TEMPLATES["MIT"] + "\nmore"),
        ("a/z.py", ""), ("q/z.py", None), (None, "x"), ("a/z.py", ""),
    ]
    table = spark.createDataFrame(files, "path string, text string").withColumn("license", F.lit("clash"))
    got = collections.Counter((r.path, r.own_license, r.license, r.inherited_from, r.distance) for r in licenses.scan_licenses(table).collect())
    assert got[("a/b/c/x.py", None, "GPL-3.0", "a/b/COPYING", 1)] == 1 and got[("a/y.py", "MIT", "MIT", None, None)] == 1
    assert got[("a/z.py", None, "Apache-2.0", "a/LICENSE", 0)] == 2 and got[("q/z.py", None, None, None, None)] == 1 and got[(None, None, None, None, None)] == 1
    assert licenses.scan_licenses(table.where("false")).count() == 0


def test_licenses_from_the_top_and_from_far_above(spark):
    mit, gpl, bsd = (licenses.TEMPLATES[k] for k in ("MIT", "GPL-3.0", "BSD-3-Clause"))
    deep = "/".join(f"d{i}" for i in range(50))
    files = [("LICENSE", mit), ("x.py", "1"), ("src/y.py", "1"), ("./src/y.py", "1"), (f"{deep}/z.py", "1"), (f"/far/{deep}/z.py", "1"), ("/far/LICENSE", gpl), ("/other/z.py", "1"), ("../z.py", "1"), ("/top.py", None), ("//a/LICENSE", bsd), ("//a/b/c", "")]
    got = {r.path: (r.license, r.inherited_from, r.distance) for r in licenses.scan_licenses(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["x.py"] == ("MIT", "LICENSE", 0) and got["src/y.py"] == got["./src/y.py"] == ("MIT", "LICENSE", 1) and got[f"{deep}/z.py"] == ("MIT", "LICENSE", 50)
    assert got[f"/far/{deep}/z.py"] == ("GPL-3.0", "/far/LICENSE", 50) and got["//a/b/c"] == ("BSD-3-Clause", "//a/LICENSE", 1)
    assert got["/other/z.py"] == got["../z.py"] == got["/top.py"] == (None, None, None)


def test_licenses_of_whole_texts_and_headers(spark):
    """Texts of installed packages, with their own names and line breaks, and notices as they stand in source files."""
    names = "psutil:BSD-3-Clause idna:BSD-3-Clause attrs:MIT pytest:MIT pluggy:MIT tiktoken:MIT charset_normalizer:MIT requests:Apache-2.0 sortedcontainers:Apache-2.0 pygments:BSD-2-Clause"
    rows, expected = [], {}
    for package, name in (n.split(":") for n in names.split()):
        for f in files(package) or ():
            if f.name.startswith("LICENSE") and f.locate().is_file():
                rows.append((f"{package}/{f.name}", f.locate().read_text(encoding="utf-8")))
                expected[f"{package}/{f.name}"] = name
    header = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version {0} of the License, or\n# any later version.\nx = 1\n"
    for path, text, name in (
        ("a/mit.py", "# SPDX-License-Identifier: MIT\nx = 1", "MIT"), ("b/mpl.rs", "// SPDX-License-Identifier: MPL-2.0", None), ("c/g.c", "/* SPDX-License-Identifier: GPL-3.0-or-later */", "GPL-3.0"),
        ("d/sa.txt", "SPDX-License-Identifier: CC-BY-SA-4.0", None), ("e/g.py", header.format(3), "GPL-3.0"), ("f/g.py", header.format(2), "GPL-2.0"), ("g/p.py", "# the software prints all rights reserved words", None),
    ):
        rows.append((path, text))
        expected[path] = name
    assert len(rows) >= 12
    got = {r.path: r.own_license for r in licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == expected


def test_license_scores_are_a_plain_loop_and_shuffle_little(spark):
    """Every shuffle is as many tasks as the session has partitions, whatever the size of the notices: none by template, two by notice."""
    templates = {"MIT": ["released under the mit license", "mit license text"], "mit": "nothing of the kind", "GPL": "the general public license, the license"}
    texts = ["released under the MIT license", "the license", "MIT and GPL: the general public license", "none of it", "--", "SPDX-License-Identifier: Mit the license", "SPDX-License-Identifier: other mit license"]
    notices = [(str(i), text, i + 1) for i, text in enumerate(texts)]
    scores = licenses._scores(stored(spark.createDataFrame(notices, "_notice string, body string, files long")), templates, 0.3)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_notice") == 2 and "hashpartitioning(license" not in plan and "ExistingRDD" not in plan
    terms = [collections.Counter(re.findall("[a-z0-9]+", text.lower())) for text in texts]
    idf = collections.defaultdict(lambda: np.log(1 + sum(n for _, _, n in notices)) + 1)
    for term in {t for words in terms for t in words}:
        idf[term] = np.log((1 + sum(n for _, _, n in notices)) / (1 + sum(n for words, (_, _, n) in zip(terms, notices, strict=True) if term in words))) + 1
    expected = {"5": ("MIT", 1.0)}
    for words, (digest, text, _) in zip(terms, notices, strict=True):
        best = []
        for name, body in (("MIT", templates["MIT"][0]), ("MIT", templates["MIT"][1]), ("mit", templates["mit"]), ("GPL", templates["GPL"])):
            wanted = collections.Counter(re.findall("[a-z0-9]+", body.lower()))
            dot = sum(words[t] * wanted[t] * idf[t] ** 2 for t in wanted)
            norms = [np.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items())) for c in (words, wanted)]
            best += [(-round(float(dot / norms[0] / norms[1]), 6), name)] if dot and dot / norms[0] / norms[1] >= 0.3 else []
        if best and "SPDX" not in text:
            expected[digest] = (min(best)[1], -min(best)[0])
    assert len(expected) >= 4
    got = {r._notice: (r.own_license, r.own_score) for r in scores.collect()}
    assert got.keys() == expected.keys() and all(got[k][0] == expected[k][0] and abs(got[k][1] - expected[k][1]) < 2e-6 for k in expected)
    assert licenses._scores(stored(spark.createDataFrame(notices, "_notice string, body string, files long")), {}, 0.3).count() == 0


def test_licenses_query_is_whole(spark, connection):
    rows = QUERIES["op7_licenses"](spark, SMALL).collect()
    assert len(rows) == connection.sql("select count(*) from documents").fetchall()[0][0]
    apache = {d for d, text, _ in documents(connection) if "Licensed under the Apache License, Version 2.0." in (text or "")}
    assert {r.doc_id for r in rows if r.own_license == "Apache-2.0"} == apache


def test_classifier_held_out_accuracy(spark):
    # the smallest tables have 61 labelled documents to learn from, 16 of 19 held-out ones right; the next size has 329
    larger = SMALL.replace("sf0.001", "sf0.01")
    truth = dict(duck(larger).sql("select doc_id, quality from labels").fetchall())
    rows = QUERIES["op8_quality_classifier"](spark, larger).collect()
    known = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in known) >= 0.85 * len(known)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_classifier_reads_every_byte():
    net = classifier.fit([b"a" * 300, b"#" * 300], [1, 0], epochs=2)
    text = bytes(random.Random(1).randbytes(5000))
    whole = net.scores(np.frombuffer(text, np.uint8), np.array([0, 5000]))[0]
    changed = [net.scores(np.frombuffer(text[:i] + b"#" * 40 + text[i + 40 :], np.uint8), np.array([0, 5000]))[0] for i in (0, 2500, 4960)]
    assert all(c != whole for c in changed)


def test_classifier_scores_do_not_depend_on_neighbours():
    net = classifier.fit([b"a" * 300, b"#" * 300], [1, 0], epochs=2)
    texts = [random.Random(n).randbytes(n) for n in (0, 1, classifier.SEGMENT, classifier.CHUNK, classifier.CHUNK - 2, 5 * classifier.CHUNK)]
    alone = [net.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    many = [t for t in texts for _ in range(2)]
    for order in (many, many[::-1], [x for t in texts for x in (t, b"#" * 64)]):
        got = net.scores(np.frombuffer(b"".join(order), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in order])]))
        assert all(s == pytest.approx(alone[texts.index(t)], abs=1e-7) for t, s in zip(order, got) if t in texts)


def test_classifier_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (6, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    model = classifier.train_quality(awkward, labels, usable=F.lit(True))
    assert classifier.score_quality(awkward, model).count() == len(AWKWARD) and classifier.score_quality(empty, model).count() == 0
    none = classifier.train_quality(awkward, labels.where("false"), usable=F.lit(True))
    assert {r.score for r in classifier.score_quality(awkward, none).collect()} == {0.5}


def _near_groups(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=120)) for _ in range(60)]
    center = rng.choices(vocabulary, k=150)
    for _ in range(120):  # one group of copies with very different numbers of changed words
        copy = list(center)
        for i in rng.sample(range(150), rng.choice([0, 1, 2, 3, 6, 10])):
            copy[i] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    return texts + texts[:5]


def test_near_duplicates_against_brute_force(spark):
    texts = _near_groups(4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs).collect()}
    weights, shingler = near_dup.feature_weights(docs), near_dup.Shingler()
    raw = [t.encode().translate(near_dup.FOLD) for t in texts]
    document, shingle, count = shingler.shingles(b"".join(raw), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    weight = weights[(shingle & np.uint64(len(weights) - 1)).astype(int)] * count
    sets = [dict(zip(shingle[document == i].tolist(), weight[document == i].tolist())) for i in range(len(texts))]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = sum(min(v, sets[j].get(k, 0)) for k, v in sets[i].items())
            if shared >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - shared):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert sum(got[i] != root(i) for i in range(len(texts))) <= 1


def test_near_duplicates_awkward(awkward, empty):
    rows = near_dup.near_duplicates(awkward).collect()
    fox = [r for r in rows if (r.text or "").startswith("The quick")]
    assert len(rows) == len(AWKWARD) and {r.class_id for r in fox} == {3} and sum(r.stays for r in fox) == 1 and {r.class_rows for r in fox} == {3}
    assert all(r.stays for r in rows if r not in fox) and near_dup.near_duplicates(empty).count() == 0


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(9)
    for _ in range(30):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 80))]
        place, offset = packing.best_fit_decreasing(lengths, 64)
        room, fills = [], collections.Counter()
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fitting = [r for r in room if r >= lengths[i]]
            if fitting:
                room[room.index(min(fitting))] -= lengths[i]
            else:
                room.append(64 - lengths[i])
            fills[place[i]] += lengths[i]
        assert sorted(64 - r for r in room) == sorted(fills.values()) and max(fills.values(), default=0) <= 64


def test_packing_round_trip(spark, awkward, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.token_pieces(awkward, tokenizer_path(), keep_ids=True)
    packed = packing.pack(pieces).collect()
    for doc_id, text in ((1, ""), (2, ""), (5, LONG), (6, AWKWARD[6][1]), (7, AWKWARD[7][1])):
        mine = sorted((r for r in packed if r.doc_id == doc_id), key=lambda r: r.start)
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert [i for r in mine for i in r.ids] == ids and all(r.doc_tokens == len(ids) for r in mine)
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in mine)
    for rows in (list(g) for g in _by(packed, "sequence_id").values()):
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))] and rows[0].sequence_tokens == sum(r.length for r in rows) <= packing.WINDOW
    whole = packing.sequences(packing.pack(pieces)).collect()
    assert all(len(r.ids) == packing.WINDOW or len(r.ids) & (len(r.ids) - 1) == 0 for r in whole)
    assert packing.pack(packing.token_pieces(empty, tokenizer_path())).count() == 0


def test_word_tokenizer_is_exact():
    tokenizer, rng = packing.word_tokenizer(tokenizer_path()), random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice("aeZĳŉİßſΣσééñ.,!?';:-_ \n\t0129中文のﬁ<|>²ªŁłƀ’") for _ in range(rng.randint(0, 60)))
        assert tokenizer.ids([text])[0].tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_tokenizer_refuses_cased_vocabularies(tmp_path):
    from tokenizers import Tokenizer, normalizers

    cased = Tokenizer.from_file(tokenizer_path())
    cased.normalizer = normalizers.NFC()
    cased.save(str(tmp_path / "cased.json"))
    with pytest.raises(ValueError, match="lower-case"):
        packing.word_tokenizer(str(tmp_path / "cased.json"))


def _by(rows, name):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[name]].append(r)
    return out


def test_pipeline_stages(spark, connection):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, SMALL))
        assert kept.columns == docs.columns, name
        if name == "near_duplicates":
            assert kept.select("text").distinct().count() == kept.count() < before
    assert 0.5 * before < kept.count() < before
    assert not any(_base(r.text or "") for r in kept.collect())
    pieces = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in kept.collect()}


def test_pipeline_stages_awkward(spark, awkward, empty):
    docs = awkward.withColumn("n_chars", F.lit(1).cast("bigint"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() > 0, name
        assert stage(spark, docs.where("false"), SMALL).count() == 0, name


INTERNAL = (
    "_words _refs _bytes _letters _t _inst _id _email _hits _items terms positions _body _dir _notice _path n _key _bands chosen _d _text _row _base kept "
    "columns_of_the_caller own t k1 k2 ids base more _url host cls best row uid sig c words d n_chars_of_t _near _h score spans hits text2"
).split()


def test_columns_named_like_internal_ones_pass_through(spark):
    words = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f"{words} the {i} mail user{i}@mail.example.com now", "en", f"https://h{i}.example.org/en/{i}", f"src/a{i}.txt") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, url string, path string").withColumns({c: F.lit(f"mine {c}") for c in INTERNAL})
    net = classifier.fit([b"good text", b"bad"], [1, 0], epochs=1, least_steps=1)
    gru = language_id.fit([b"some text here", b"ein text da"], ["en", "de"], epochs=1, least_steps=1)
    items = spark.createDataFrame([(1, words)], "item_id bigint, text string")
    results = {
        "op1": quality_rules.divergence(docs),
        "op2": url_filter.filter_urls(docs, url_filter.domain_rules("org", "/", "block")),
        "op3": language_id.predict_languages(docs, gru),
        "op4": pii.find_pii(docs),
        "op5": decontaminate.decontaminate(docs, items),
        "op5 blocks": decontaminate.decontaminate(docs, items.unionByName(items.withColumn("item_id", F.lit(2).cast("bigint"))), block_words=20),
        "op7": licenses.scan_licenses(docs),
        "op8": classifier.score_quality(docs, net),
        "op9": near_dup.near_duplicates(docs),
    }
    for name, result in results.items():
        assert len(set(result.columns)) == len(result.columns), name
        found = result.collect()
        assert sorted(r.doc_id for r in found) == list(range(6)), name
        made = set(result.columns) - set(docs.columns)
        kept = [c for c in INTERNAL if c in result.columns and c not in {"host", "score", "spans", "hits", "kept"}]
        assert len(kept) >= len(INTERNAL) - 5 and made, name
        assert all(r[c] == f"mine {c}" for r in found for c in kept), name
        assert all(r.text == rows[r.doc_id][1] for r in found), name


def test_decontaminate_blocks_end_inside_an_id(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choices([f"w{i}" for i in range(300)], k=n))
    items = [(None, text(14)) for _ in range(6)] + [(7, text(12)) for _ in range(6)]
    docs = [(i, f"{text(8)} {items[i % 12][1] if i % 2 else ''} {text(8)}") for i in range(24)]
    frame, asked = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    whole, cut = (sorted(tuple(r) for r in decontaminate.decontaminate(frame, asked, block_words=size).select(*columns).collect()) for size in (10**6, 20))
    assert whole == cut and {r[0] for r in whole if r[5]} == {i for i in range(24) if i % 2}


def test_language_probabilities_against_a_plain_loop(spark):
    """The network that scores many documents at once, against one GRU step after the other."""
    gru = language_id.fit([b"the quick brown fox", "der schnelle Fuchs läuft".encode(), b"el zorro salta"], ["en", "de", "es"], epochs=2, least_steps=4)
    texts = [b"a", b"the fox jumps over it", ("läuft und " * 40).encode(), bytes(range(256))]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = gru.document_probabilities(np.frombuffer(b"".join(texts), np.uint8), offsets)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for text, probability in zip(texts, got):
        sums, states = np.zeros(3), []
        for at in range(0, len(text), language_id.STEPS):
            piece = text[at : at + language_id.STEPS]
            H = gru.recur[0].shape[0] if gru.recur[0].shape[0] * 3 == gru.recur[0].shape[1] else gru.recur[0].shape[1]
            ways = []
            for way in (0, 1):
                embed, recur = gru.embed[way].astype(float), gru.recur[way].astype(float)
                recur = recur if recur.shape[0] == H else recur.T
                h, out = np.zeros(H), {}
                for t in range(len(piece)) if way == 0 else range(len(piece) - 1, -1, -1):
                    g, back = embed[piece[t]], h @ recur
                    z, r = (sigmoid(2 * (g[i * H : (i + 1) * H] + back[i * H : (i + 1) * H])) for i in (0, 1))
                    new = np.tanh(g[2 * H :] + r * back[2 * H :])
                    h = new + z * (h - new)
                    out[t] = h
                ways.append(out)
            for t in range(len(piece)):
                e = np.concatenate([ways[0][t], ways[1][t]]) @ gru.out.reshape(2 * H, 3) + gru.out_bias
                e = np.exp(e - e.max())
                sums += e / e.sum()
        assert probability == pytest.approx(sums / len(text), abs=2e-3)


def test_classifier_scores_against_a_plain_convolution():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"abc xyz", k=rng.randint(1, 900))) for _ in range(12)] + [b""]
    net = classifier.fit(texts, [i % 2 for i in range(13)], epochs=2, least_steps=3)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = net.scores(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for text, score in zip(texts, got):
        data = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(classifier.CHUNK + classifier.WIDTH, np.uint8)])
        step, chunks = classifier.STEP_SEGMENTS * classifier.SEGMENT, []
        for s in range(0, max(1, len(text) - classifier.CHUNK + step), step):
            total = np.array([sum(net.tables[j][data[s + i + j]] if s + i + j < len(data) else net.tables[j][0] for j in range(classifier.WIDTH)) for i in range(classifier.CHUNK)])
            chunks.append(np.maximum(total.max(axis=0) + net.bias, 0))
        features = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
        plain = 1 / (1 + np.exp(-(features @ net.out + net.out_bias)))
        assert score == pytest.approx(plain, abs=1e-3)


def test_near_duplicates_bound_refuses_pairs_below_the_threshold_only(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    center = rng.choices(vocabulary, k=350)
    texts = []
    for _ in range(60):  # most pairs have a similarity just below 0.8, so their samples alone do not tell them apart
        copy = list(center)
        for i in rng.sample(range(350), 4):
            copy[i] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    weights = near_dup.feature_weights(docs)
    found = near_dup.weighted_sets(docs.withColumnRenamed("doc_id", "_uid"), weights).collect()
    similar = 0
    for a in found:
        for b in found:
            if a._uid < b._uid:
                unlike = [bin((x ^ y) & 0xFFFFFFFFFFFFFFFF).count("1") for x, y in zip(a.cells, b.cells)]
                apart = sum(unlike[: near_dup.CELL_WORDS]) + near_dup.STEP * sum(unlike[near_dup.CELL_WORDS :])
                most, exact = (a.total + b.total - apart) / (a.total + b.total + apart), near_dup.weighted_jaccard(bytes(a._set), bytes(b._set))
                assert exact <= most + 1e-6 and most < exact + 0.03
                similar += exact >= 0.8
    proposed, store = [], near_dup.stored

    def spy(df):
        out = store(df)
        proposed.append(out.count() if "apart" in out.columns else 0)
        return out

    monkeypatch.setattr(near_dup, "stored", spy)
    near_dup.near_duplicates(docs).count()
    assert sum(proposed) < 2 * similar < 1000  # of 1,770 pairs


def test_quality_classes_of_characters(spark):
    texts = ["", "aé Zz 09\t\n\x0b\x0c\r.,;:?'\"()-!#*$%&|<>@=~^_+/{}[]\\`\x00\x1f\x7f𝒳ß", "plain words only", " \n ", "ÀÉ中文 x"]
    kinds = ["[a-z]", "[A-Z]", "[0-9]", r"""[.,;:?'"()-]""", r"[!#*$%&|<>@=~^_+/{}\[\]\\]", r"[^\x00-\x7F]", r"[\x20\x09-\x0D]"]
    docs = spark.createDataFrame([(t, len(re.findall(kinds[-1], t))) for t in texts], "t string, b int")
    for blanks in (None, "b"):
        counts = quality_rules.class_counts("t", blanks)
        assert counts.count("regexp_replace(t,") == 1  # the other searches are in the few characters left by it
        for r in docs.select("t", F.expr(counts).alias("c")).collect():
            wanted = [len(re.findall(k, r.t)) for k in kinds]
            assert r.c == [*wanted, len(r.t) - sum(wanted)]


def test_word_tokenizer_knows_a_word_by_one_spelling():
    tokenizer, rng = packing.WordTokenizer(tokenizer_path()), random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice(["ab", "É", "ŉ", "Σ", "'s", "'", ".", "$$$", "!", " ", "  ", "\n", "7", "_", "İ", "`", "ÿ", "²"][: rng.choice([2, 8, 18])]) for _ in range(rng.randint(0, 30)))
        assert tokenizer.ids([text])[0].tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids
    tokenizer._clear()
    tokenizer.ids(["Word word. WORD, word!! Word.$$$ word;", "Größe größe? GRÖSSE größe.%%% größe:"])
    assert {w for w in tokenizer.known if w.strip(".,;:?!$%")} == {"word", "größe", "grösse"}


def test_pipeline_stages_bound_their_batches(spark):
    corpus_pipeline.stage(lambda spark, docs, sf_dir: docs)(spark, spark.range(1), SMALL)
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    assert all(0 < int(spark.conf.get(name)) <= 512 for name in names)
