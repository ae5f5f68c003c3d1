"""Operators against brute force on a small corpus of hard cases."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ripen.llm import (decontaminate, html_extract, mixing, quality_classifier, quality_rules, sharding, simhash,
                       substring_dedup, token_counts, url_filter)
from ripen.llm.components import connected_components

from .conftest import rows_of, sentence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return (text or "").encode().split()


def texts(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------ 1 substring dedup

def brute_repeats(rows, n=20):
    first = {}
    place = lambda d, i: (-1 << 63 if d is None else d, i)
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            first[k] = min(first.get(k, place(d, i)), place(d, i))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < place(d, i):
                gone.update(range(i, i + n))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def test_substring_dedup_equals_brute_force(corpus):
    got = rows_of(substring_dedup.remove_repeats(corpus), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == brute_repeats(texts(corpus))


def test_substring_dedup_with_every_seed_frequent(corpus, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 2)
    got = rows_of(substring_dedup.remove_repeats(corpus), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == brute_repeats(texts(corpus))


def test_substring_dedup_with_a_full_filter(corpus, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", 64)
    got = rows_of(substring_dedup.remove_repeats(corpus), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == brute_repeats(texts(corpus))


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0


# ------------------------------------------------------------ 2 simhash

def brute_fingerprint(text):
    from xxhash import xxh64_intdigest
    w = words((text or "").translate(LOW))
    parts = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("levels, leaf", [(4, 1 << 16), (8, 1 << 16), (None, 7), (16, 40)])
def test_simhash_equals_brute_force(spark, corpus, monkeypatch, levels, leaf):
    """At every number of levels, and with leaves cut into blocks."""
    monkeypatch.setattr(simhash, "LEAF_ROWS", leaf)
    rows = texts(corpus) + [(500 + i, " ".join(sentence(1, 400).split()[i:])) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [brute_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                up[max(root(i), root(j))] = min(root(i), root(j))
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[root(i)] += [d] if d is not None else []
    want = sorted(((d, fps[i], min(low[root(i)], default=None)) for i, (d, _) in enumerate(rows)), key=str)
    got = sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in simhash.near_duplicates(df, levels=levels).collect()), key=str)
    assert got == want
    assert len({x[2] for x in want}) < len(rows) - 10


def test_leaf_of_fifty_thousand_near_fingerprints_ends_in_seconds():
    rng = np.random.default_rng(5)
    found = {0}
    while len(found) < 50_000:
        found.add(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    fp = rng.permutation(np.array(sorted(found), dtype=np.uint64))
    start = time.time()
    la, a, lb, b = simhash._leaf(np.concatenate([fp, fp]), np.tile(np.arange(len(fp)), 2), np.repeat([True, False], len(fp)), 4)
    assert len(a) == len(fp) - 1 and (np.bitwise_count(a ^ b) <= 4).all() and (fp[la] == a).all() and (fp[lb] == b).all()
    assert time.time() - start < 60


def test_simhash_of_nothing(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}


# ------------------------------------------------------------ 3 token counts

def test_token_counts_equal_the_unigram_tokenizer(corpus):
    from tokenizers import Tokenizer, models
    pieces = token_counts.load_vocabulary()
    tok = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))

    def count(text):
        if not text:
            return 0
        line = "▁" + text.replace(" ", "▁")
        e = tok.encode(line)
        return sum(len(line[a:b].encode()) if i == 0 else 1 for i, (a, b) in zip(e.ids, e.offsets))
    want = sorted(((d, count(t)) for d, t in texts(corpus)), key=str)
    assert rows_of(token_counts.count_tokens(corpus, pieces), "doc_id", "n_tokens") == want


def test_token_counts_tie_rules():
    # "ab" as one piece and as a + b score the same: the candidate with the earlier start was first and stays
    tie = token_counts.PieceCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0)])
    assert tie.chunk("ab") == 1
    better = token_counts.PieceCounter([("a", -1.0), ("b", -0.5), ("ab", -2.0)])
    assert better.chunk("ab") == 2
    assert tie.chunk("aé") == 3                 # an unknown character counts its bytes


def test_token_counts_of_nothing(empty):
    assert token_counts.count_tokens(empty, token_counts.load_vocabulary()).count() == 0


# ------------------------------------------------------------ 4 sharding

def test_shards_are_contiguous_and_balanced(corpus):
    got = sharding.assign_shards(corpus, 7, sharding.text_size("text"), order=("text",)).collect()
    assert len(got) == corpus.count()
    total = sum(r["size"] for r in got)
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 16 for _, t in texts(corpus))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    start = 0
    for r in order:
        assert r["shard"] == min(6, (2 * start + r["size"]) * 7 // (2 * total))
        start += r["size"]
    for s, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))


@pytest.mark.parametrize("case", ["corpus", "one id", "null ids", "equal rows", "text ids"])
def test_shards_of_hot_ids(spark, corpus, monkeypatch, case):
    """Ids with more rows than a range: the same law, whatever the parts."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", 5)
    rows = [(r[0], r[1] or "", r[2]) for r in corpus.select("doc_id", "text", "lang").collect()]
    rows = {"corpus": rows, "one id": [(4, t, x) for _, t, x in rows], "null ids": [(None if i % 3 else i, t, x) for i, (_, t, x) in enumerate(rows)],
            "equal rows": [(9, "same words", "en")] * 40 + [(9, "other", "en")] * 7 + [(d, t, x) for d, t, x in rows if d and d < 20],
            "text ids": [(f"id-{(d or 0) // 10}", t, x) for d, t, x in rows]}[case]
    df = spark.createDataFrame(rows, f"doc_id {'string' if case == 'text ids' else 'long'}, text string, lang string")
    got = sharding.assign_shards(df, 7, sharding.text_size("text"), order=("text",)).collect()
    assert Counter((r["doc_id"], r["text"], r["lang"]) for r in got) == Counter(rows)
    total, start = sum(r["size"] for r in got), 0
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in order] == sorted((r["doc_id"] for r in got), key=lambda d: (d is not None, d))
    for r in order:
        assert r["size"] == len(r["text"].encode()) + 16
        assert r["shard"] == min(6, (2 * start + r["size"]) * 7 // (2 * total))
        start += r["size"]
    for s, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))


def test_sharding_of_nothing_and_of_equal_ids(spark, empty):
    assert sharding.assign_shards(empty, 7, sharding.text_size("text")).count() == 0
    df = spark.createDataFrame([(1, "a" * i) for i in range(50)], "doc_id long, text string")
    got = sharding.assign_shards(df, 5, sharding.text_size("text"), order=("text",)).collect()
    assert len({(r["shard"], r["slot"]) for r in got}) == 50 and {r["shard"] for r in got} == set(range(5))


# ------------------------------------------------------------ 5 mixing

def fill(budget, children):
    """Water-filling by bisection on the level."""
    if budget >= sum(c for _, c in children):
        return [float(c) for _, c in children]
    lo, hi = 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(c, w * mid) for w, c in children) < budget else (lo, mid)
    return [min(c, w * lo) for w, c in children]


def test_leaf_budgets_refill_siblings_before_ancestors(spark):
    leaves = [("a", "x", "1", 10), ("a", "x", "2", 500), ("a", "y", "3", 20), ("b", "x", "4", 5), ("b", "y", "5", 1000), ("c", "z", "6", 40)]
    weights = {"domain": {"a": 3.0, "*": 1.0}, "source": {"2": 2.0}}
    for total in (30, 200, 700, 1500, 5000):
        got = {tuple(r)[:3]: r["budget"] for r in mixing.leaf_budgets(
            spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), F.lit(float(total)), weights, 1).collect()}

        def deal(rows, budget, depth):
            if depth == 3:
                return {rows[0][:3]: budget}
            groups = defaultdict(list)
            for r in rows:
                groups[r[depth]].append(r)
            w = weights.get(mixing.LEVELS[depth], {})
            parts = fill(budget, [(w.get(k, w.get("*", 1.0)), sum(x[3] for x in g)) for k, g in groups.items()])
            return {k: v for g, b in zip(groups.values(), parts) for k, v in deal(g, b, depth + 1).items()}
        want = deal(leaves, total, 0)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_mixing_takes_the_longest_prefix_of_seeded_epochs(corpus):
    docs = corpus.where("doc_id is null or doc_id not in (3, 150)")
    got = mixing.mix(docs, 0.6, {"lang": {"en": 5.0, "*": 1.0}}, F.lit("all"), seed=3, max_epochs=2).collect()
    budgets = {}
    count = lambda t: len(words(t))
    leaves = defaultdict(list)
    for r in docs.collect():
        leaves[(r["lang"] or "unknown", r["source"] or "unknown")].append((r["doc_id"], count(r["text"])))
    table = [("all", *k, sum(t for _, t in v)) for k, v in leaves.items()]
    for r in mixing.leaf_budgets(docs.sparkSession.createDataFrame(table, "domain string, lang string, source string, tokens long"),
                                 F.lit(0.6 * sum(x[3] for x in table)), {"lang": {"en": 5.0, "*": 1.0}}, 2).collect():
        budgets[(r["lang"], r["source"])] = int(r["budget"] + 1e-6)
    want = {}
    for k, rows in leaves.items():
        total = sum(t for _, t in rows)
        whole = budgets[k] // total if total else 0
        rest, run = budgets[k] - whole * total, 0
        key = lambda r: hashlib.md5((":".join([*([str(r[0])] if r[0] is not None else []), "3", str(whole)])).encode()).hexdigest()  # noqa: E731, B023
        for d, t in sorted(rows, key=key):
            run += t
            copies = whole + (whole < 2 and rest > 0 and run <= rest)
            if copies:
                want[d] = copies
    assert {r["doc_id"]: r["copies"] for r in got} == want and max(want.values()) == 2


def test_mixing_of_nothing(empty):
    assert mixing.mix(empty, 0.5, {}, F.lit("all")).count() == 0


# ------------------------------------------------------------ 6 URL filter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "spam.net/")]


def test_urls_take_the_decision_of_their_class(spark):
    link = '<link href="{}" rel="canonical">'
    pages = [(1, "http://spam.net/a", None), (2, "http://good.com/x", link.format("http://spam.net/b")), (3, "http://good.com/y", "<p>canonical</p>"),
             (4, "http://other.com/z", '<meta http-equiv="refresh" content="0; url=http://good.com/x">'), (5, None, link.format("http://spam.net/b")),
             (6, "no scheme", ""), (7, "http://A.Example.ORG/es/1?q", ""), (8, "http://a.org", ""), (9, "http://q.com/1#f", ""),
             (10, "http://good.com/x?utm_source=k", ""), (11, "http://both.com/", link.format("http://w.org/ok")), (11, "http://both.com/", link.format("http://spam.net/c")),
             (12, "http://r.com/1", "")]
    df = spark.createDataFrame([(*p, "h", "v") for p in pages], "page_id long, url string, html string, host string, verdict string")
    redirects = spark.createDataFrame([("http://r.com/1", "http://r.com/2"), ("http://r.com/2", "http://spam.net/r"), (None, "x")], "a string, b string")
    got = sorted(map(tuple, url_filter.judge_urls(df, RULES, redirects).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    want = [(1, "spam.net", "/a", "spam.net/", "block"), (2, "good.com", "/x", None, "block"), (3, "good.com", "/y", None, "allow"),
            (4, "other.com", "/z", None, "block"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
            (7, "a.example.org", "/es/1", "example.org/es/", "block"), (8, "a.org", "", None, "allow"), (9, "q.com", "/1", None, "allow"),
            (10, "good.com", "/x", None, "block"), (11, "both.com", "/", None, "allow"), (11, "both.com", "/", None, "allow"), (12, "r.com", "/1", None, "block")]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("target, want", [
    ("/de/x", "http://good.com/de/x"), ("y?k=1", "http://good.com/a/y?k=1"), ("../z", "http://good.com/z"), ("//spam.net/p", "http://spam.net/p"),
    ("http://q.com/?a=1&amp;b=2", "http://q.com/?a=1&b=2"), ("?a=1&#38;b=2", "http://good.com/a/b?a=1&b=2"), ("HTTP://Spam.net/?", "HTTP://Spam.net/?"),
    ("mailto:a@b.c", None), ("", None), ("http://[bad", "http://[bad"), ("//[bad", None)])
def test_link_targets_are_resolved(target, want):
    want = [want] if want else []
    url = "http://good.com/a/b"
    assert url_filter.targets_of(url, [f'<link data-href="/no" rel="alternate canonical" href="{target}" />']) == want
    assert url_filter.targets_of(url, [f"<META content='0; URL={target}' http-equiv=Refresh>"]) == want
    assert url_filter.targets_of("http://other.com/", [f"<base href='{url}'>", "<base href='/no'>", f'<link rel=canonical href="{target}">']) == want


def test_urls_take_the_decision_of_relative_targets(spark):
    pages = [(1, "http://spam.net/a", "<link rel=canonical href='/de/x'>"), (2, "http://good.com/x", "<link rel='canonical' title='a > b' href='//spam.net/b'>"),
             (3, "http://good.com/y", "<meta http-equiv=refresh content='0;url=x'>"), (4, "http://good.com/q", "<link rel=canonical href='/q?a=1&amp;b=2'>"),
             (5, "http://good.com/q?a=1&b=2", "<base href='http://spam.net/d/'><link rel=canonical href=e>"), (6, "http://good.com/z", "<link rel=canonical href='z'>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df, RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow"}


def test_url_filter_of_nothing(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(df, RULES).count() == 0


# ------------------------------------------------------------ 7 HTML extraction

PAGE = """<html><head><title>T</title></head><body><header><a href=/>Home</a></header><nav><ul><li><a>one</a></li><li><a>two</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="content"><article><header><h1>The  title</h1></header><p>First &amp; <b>bold</b>
text<br>goes on. <p>Second paragraph, not closed<ul><li>item one<li>item two</ul><div class="ad">Buy</div><script>if (a < b) "</p>"</script>
<p>Short.</p><!-- hidden <p>x</p> --></article></div><aside>related</aside><section id="comments"><p>A reader comment that is quite long, longer
than the paragraphs</p></section><form><label>Mail</label><input></form><footer>&copy; x</footer></body></html>"""


def test_html_main_text():
    assert html_extract.extract(PAGE) == "The title\n\nFirst & bold text goes on.\n\nSecond paragraph, not closed\n\nitem one\n\nitem two\n\nShort."


def test_html_without_article_takes_the_dense_subtree():
    page = ("<body><div class=menu><a>a</a></div><div><div><a href=1>link one</a> <a href=2>link two</a></div><div><p>" + "long text " * 40 + "</p><p>"
            + "more text " * 30 + "</p></div></div></body>")
    assert html_extract.extract(page) == ("long text " * 40).strip() + "\n\n" + ("more text " * 30).strip()


def test_html_hard_cases(spark):
    pages = [(1, None, None), (2, "u", ""), (3, "u", "<p>"), (4, "u", "plain &lt;text"), (5, "u", "<article><p>cut off &am"), (6, "u", "<body>" + "<div>" * 3000 + "deep" + "</div>" * 3000),
             (7, "u", "<script>only"), (8, "u", "<p>a  b</p>" * 2)]
    df = spark.createDataFrame([(*p, "t", 0) for p in pages], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract_text(df).collect()}
    want = {1: "", 2: "", 3: "", 4: "plain <text", 5: "cut off &am", 6: "deep", 7: "", 8: "a b\n\na b"}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    assert html_extract.extract_text(df.limit(0)).count() == 0


LONG, MORE = ("long text " * 40).strip(), ("more text " * 30).strip()


@pytest.mark.parametrize("attribute", ['href="/hidden-lake"', 'title="hidden gems"', 'href="/p?id=ad"', 'data-id="menu"', "data-hidden", "title='class=ad'", "alt=\"style='display:none'\""])
def test_html_keeps_elements_by_whole_attribute_names(attribute):
    assert html_extract.extract(f"<article><p {attribute}>{LONG}</p><p>{MORE} <a {attribute}>the link</a></p></article>") == f"{LONG}\n\n{MORE} the link"


def test_html_cuts_by_attributes_as_written():
    for a in ("hidden", "HIDDEN=''", "Class = ad", "id='menu'", "x=1 class=\"big ad\"", "title='a' style='display: none'", "role=navigation", "class='&#97;d'"):
        assert html_extract.extract(f"<article><p>{LONG}</p><div {a}>Buy</div><p>{MORE}</p></article>") == f"{LONG}\n\n{MORE}"


@pytest.mark.parametrize("name", ["content no-sidebar", "has-sidebar", "related-work", "text-widget", "page with-header", "site-header-on menu"])
def test_html_keeps_wrappers_of_most_of_the_text(name):
    for a in ("class", "id"):
        assert html_extract.extract(f"<body><div class=menu><a>one</a></div><div {a}='{name}'><div class=sidebar>Side</div><p>{LONG}</p><p>{MORE}</p></div></body>") == f"{LONG}\n\n{MORE}"


def test_html_cuts_menus_and_comments_that_are_long():
    assert html_extract.extract(f"<div class=menu>{'<a>a long link</a> ' * 90}</div><div><p>{LONG}</p></div>") == LONG
    assert html_extract.extract(f"<div><p>{LONG}</p></div><div id=comments><p>{'a reader says ' * 60}</p></div>") == LONG
    assert html_extract.extract("<div class=ad>An advert longer than it</div><article><p>Article</p></article>") == "Article"
    assert html_extract.extract("<div class='ad top'>An advert longer</div><article><p>Article</p></article>") == "Article"


@pytest.mark.parametrize("page", [
    "<article><p>{0}</p><p class=ad>Buy<p>{1}</p></article>", "<article><p>{0}</p><ul><li class=ad>Buy<li>{1}</ul></article>",
    "<article><p>{0}</p><dl><dt hidden>Buy<dd>{1}</dl></article>", "<article><p>{0}</p><table><tr><td class=ad>Buy<td>{1}</table></article>",
    "<article><p>{0}</p><table><tr class=ad><td>Buy<tr><td>{1}</table></article>", "<article><p>{0}</p><div><aside>Buy</div><p>{1}</p></article>",
    "<article><p>{0}</p><section><div class=ad><div>Buy</div></section><p>{1}</p></article>", "<head><title>T</title><body><article><p>{0}</p><p>{1}</p></article>",
    "<nav><a>one</a><main><p>{0}</p><p>{1}</p></main>", "<nav><a>one</a><article><p>{0}</p><p>{1}</p></article>",
    "<article><p>{0}</p><div><svg/></div><p>{1}</p></article>", "<article><p>{0}<svg><path d='M0'/><g><text>Buy</text></g></svg></p><p>{1}</p></article>"])
def test_html_missing_end_tags_of_cut_elements(page):
    assert html_extract.extract(page.format(LONG, MORE)) == f"{LONG}\n\n{MORE}"


# ------------------------------------------------------------ 8 decontamination

def brute_hits(docs, items, n=13):
    wins = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOW))
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            wins[tuple(w[k:k + size])].add("null" if i is None else str(i))
    sizes, out = {len(k) for k in wins}, []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for s in sizes:
            for k in range(len(w) - s + 1):
                if tuple(w[k:k + s]) in wins:
                    hit.update(range(k, k + s))
                    found |= wins[tuple(w[k:k + s])]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark, corpus):
    rows = texts(corpus)
    items = [(1, rows[3][1]), (2, sentence(900, 60)), (3, sentence(1, 12).upper()), (4, "x"), (5, None), (6, ""), (None, sentence(9, 14)), (8, "of of"),
             (9, sentence(2, 20) + " nowhere"), (9, "é漢😀-É"), (10, sentence(900, 60))]
    df = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_words int")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find_contamination(corpus, df).collect()), key=str)
    assert got == brute_hits(rows, items)


def test_contamination_by_repeated_items_equals_brute_force(spark, corpus):
    rows = texts(corpus)
    items = [(1, rows[3][1]), (1, rows[3][1]), (None, sentence(5, 44)), (None, sentence(5, 44)), (2, sentence(900, 60)), (2, sentence(900, 30) + " nowhere"),
             (3, "one"), (3, "one"), (3, "one")]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find_contamination(corpus, df).collect()), key=str)
    assert got == brute_hits(rows, items)
    assert {x for r in got for x in r[3]} == {"1", "2", "3", "null"}


def test_contamination_in_blocks_and_of_nothing(spark, corpus, empty, monkeypatch):
    items = [(1, texts(corpus)[3][1]), (2, sentence(900, 60))]
    df = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_contamination(empty, df).count() == 0
    assert decontaminate.find_contamination(corpus, df.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    monkeypatch.setattr(decontaminate, "MAX_KEYS", 20)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find_contamination(corpus, df)
                  .groupBy("doc_id", "n_words").agg(F.max("n_hit").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
                  .collect()), key=str)
    assert {x[0] for x in got if x[2]} == {x[0] for x in brute_hits(texts(corpus), items) if x[2]}


# ------------------------------------------------------------ 9 quality rules

def test_base_statistics_equal_brute_force(corpus):
    def base(text):
        text = text or ""
        w = [x.decode() for x in words(text)]
        lines = [x for x in text.split("\n") if x.encode().split()]
        at = defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i:i + 8])].append(i)
        cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover),
                len(w) < 20 or 100 * len(cover) > 30 * len(w))
    ratios = quality_rules.log_ratios(corpus, corpus.where("doc_id < 30"))
    got = rows_of(quality_rules.score(corpus, ratios), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((d, *base(t)) for d, t in texts(corpus)), key=str)


def test_log_ratios_separate_other_text(spark):
    import math
    good = [(i, sentence(i, 80)) for i in range(40)]
    odd = [(100 + i, " ".join(x + "!!" for x in sentence(i, 80).split())) for i in range(10)]
    df = spark.createDataFrame(good + odd, "doc_id long, text string")
    ratios = quality_rules.log_ratios(df, spark.createDataFrame([(i,) for i in range(0, 40, 2)] + [(None,)], "doc_id long"))
    assert len(ratios) == quality_rules.BUCKETS
    got = {r["doc_id"]: r for r in quality_rules.score(df, ratios).collect()}
    assert not any(got[d]["kept"] for d, _ in odd)
    assert min(got[d]["llr"] for d, _ in good) > max(got[d]["llr"] for d, _ in odd)
    assert all(got[d]["kept"] == (not got[d]["base_failed"] and got[d]["llr"] >= quality_rules.THRESHOLD) for d, _ in good)


def gram_buckets(text):
    """Buckets of the single words and pairs of a text: XXH64, a pair chained through the first word's hash."""
    from xxhash import xxh64_intdigest
    h = [xxh64_intdigest(x, 42) for x in words(text)]
    pairs = [xxh64_intdigest(y, a) for a, y in zip(h, words(text)[1:])]
    return [x % quality_rules.BUCKETS for x in h + pairs]


def test_llr_and_verdict_equal_brute_force(spark, corpus):
    """For every document, repeated and null ids, labels without a document and repeated labels included."""
    trusted = {i for i in range(0, 150, 2)} | {10**9}
    rows = texts(corpus)
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(gram_buckets(t))
        if d in trusted:
            target.update(gram_buckets(t))
    n_raw, n_target = (sum(c.values()) + quality_rules.BUCKETS for c in (raw, target))
    llr = lambda g: sum(math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in g) / len(g) if g else 0.0
    ids = spark.createDataFrame([(i,) for i in [*trusted, *trusted, None]], "doc_id long")
    got = sorted(((r["doc_id"], r["n_words"], r["base_failed"], r["llr"], r["kept"])
                  for r in quality_rules.score(corpus, quality_rules.log_ratios(corpus, ids)).collect()), key=lambda r: (str(r[0]), r[1], r[3]))
    want = sorted(((d, len(words(t)), llr(gram_buckets(t))) for d, t in rows), key=lambda r: (str(r[0]), r[1], r[2]))
    assert [(r[0], r[1]) for r in got] == [(r[0], r[1]) for r in want]
    assert all(abs(g[3] - w[2]) < 1e-9 for g, w in zip(got, want))
    assert all(g[4] == (not g[2] and w[2] >= quality_rules.THRESHOLD) for g, w in zip(got, want))
    assert len({g[4] for g in got}) == 2


def test_llr_depends_on_word_order_and_not_on_the_bitmap(spark, monkeypatch):
    good = [(i, sentence(i, 30 + i % 50)) for i in range(30)]
    df = spark.createDataFrame(good + [(100 + i, " ".join(reversed(t.split()))) for i, t in good], "doc_id long, text string")
    ids = df.where("doc_id < 30").select("doc_id")
    ratios = quality_rules.log_ratios(df, ids)
    llr = {r["doc_id"]: r["llr"] for r in quality_rules.score(df, ratios).collect()}
    assert all(llr[i] > llr[100 + i] for i in range(30))
    monkeypatch.setattr(quality_rules, "FILTER_WORDS", 1)
    assert quality_rules.log_ratios(df, ids) == ratios


def test_quality_rules_of_nothing(empty):
    ratios = quality_rules.log_ratios(empty, empty.select("doc_id"))
    assert quality_rules.score(empty, ratios).count() == 0


# ------------------------------------------------------------ 10 classifier

def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in got) / len(got)
    assert right > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_classifier_never_reads_held_out_labels(spark, corpus):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    held = labels.where(~quality_classifier.held_out(F.col("doc_id")))
    a, b = (sorted(map(tuple, quality_classifier.score_documents(corpus, x).collect()), key=str) for x in (labels, held))
    assert a == b and len(a) == corpus.count() and all(0 <= r[2] <= 1 for r in a)


def test_prior_of_a_known_mixture():
    import numpy as np
    rng = np.random.default_rng(1)
    p = rng.normal(0, 1, (4000, 3))
    u = np.concatenate([rng.normal(0, 1, (2800, 3)), rng.normal(4, 1, (1200, 3))])
    assert abs(quality_classifier.estimate_prior(p, u[rng.permutation(4000)]) - 0.7) < 0.06


def test_classifier_without_labels_and_of_nothing(spark, corpus, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_classifier.score_documents(corpus, none).agg(F.max("score")).first()[0] == 0
    assert quality_classifier.score_documents(empty, none).count() == 0


def test_classifier_with_few_positives_or_all_labelled(spark):
    docs = spark.createDataFrame([(i, sentence(i, 60)) for i in range(40)] + [(100 + i, "#|%& " * (20 + i)) for i in range(40)], "doc_id long, text string")
    label = lambda ids: spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    for ids in ([0, 1, 3, 4, 5, 6, 7], [0]):
        got = {r["doc_id"]: r for r in quality_classifier.score_documents(docs, label(ids)).collect()}
        assert len(got) == 80 and all(0 < r["score"] < 1 for r in got.values())
        assert min(got[i]["score"] for i in ids if not got[i]["held_out"]) > max(got[i]["score"] for i in got if i >= 100)
    good = docs.where("doc_id < 40").where(~quality_classifier.held_out(F.col("doc_id")))
    got = quality_classifier.score_documents(good, label(range(40))).collect()
    assert len(got) > 20 and all(r["predicted"] == 1 for r in got)
