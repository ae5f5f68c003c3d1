"""Suffix-array dedup, filter audit and phrase mining against brute force."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ripen.llm import bitmap, filter_audit, phrases, suffix_array, suffix_dedup

from .conftest import rows_of, sentence

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ suffix arrays

def brute_shared(s, i, j, stop):
    n = 0
    while i + n < len(s) and j + n < len(s) and s[i + n] == s[j + n] and s[i + n] > stop:
        n += 1
    return n


@pytest.mark.parametrize("induce", ["_induce_buckets", "_induce_steps"])
def test_suffix_array_equals_sorting(induce, monkeypatch):
    f = getattr(suffix_array, induce)
    monkeypatch.setattr(suffix_array, "_induce_buckets", f)
    monkeypatch.setattr(suffix_array, "_induce_steps", f)
    rng = np.random.default_rng(3)
    for _ in range(400):
        k = int(rng.integers(2, 6))
        s = np.append(rng.integers(1, k, int(rng.integers(0, 60))), 0)
        line = s.tolist()
        want = sorted(range(len(line)), key=lambda i: line[i:])
        assert suffix_array.suffix_array(s, k).tolist() == want
        for stop in (0, 1):
            shared = suffix_array.common_prefixes(s, np.array(want), stop)
            assert [shared[i] for i in want[1:]] == [brute_shared(line, i, j, stop) for i, j in zip(want[1:], want)]


def test_suffix_array_of_one_long_run():
    s = np.append(np.full(500, 7), 0)
    assert suffix_array.suffix_array(s, 8).tolist() == list(range(500, -1, -1))


# ------------------------------------------------------------ 11 suffix-array dedup

def brute_spans(rows, window=50):
    first = {}
    data = [(-1 << 63 if d is None else d, d, (t or "").encode()) for d, t in rows]
    for low, _, b in data:
        for i in range(len(b) - window + 1):
            k = b[i:i + window]
            first[k] = min(first.get(k, low), low)
    out = []
    for low, d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if first[b[i:i + window]] < low:
                gone[i:i + window] = b"x" * window
        spans = bytes(gone).replace(b"\0", b" ").split()
        out.append((d, len(b), sum(map(len, spans)), len(spans), bytearray(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def hard_bytes(spark, corpus):
    """The corpus with byte runs, NUL bytes, windows that end inside a character, and matches of exactly 49 and 50 bytes."""
    s = sentence(901, 20)
    rows = [(r[0], r[1]) for r in corpus.select("doc_id", "text").collect()]
    rows += [(600, "-" * 700), (601, "=" + "-" * 400 + "="), (602, "a\0b" * 40), (603, "x" + "a\0b" * 30), (604, "é" * 60), (605, "ê" + "é" * 30),
             (606, "<" + s[:50] + ">"), (607, "[" + s[:50] + "]"), (608, "{" + s[1:50] + "}"), (609, s[:50]), (610, s[:49]),
             (611, s + s), (612, sentence(902, 12) + " " + s + " " + sentence(903, 12)), (613, " " * 55)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("frequent, bits, shard", [(1000, 1 << 27, 1 << 20), (2, 1 << 27, 3000), (1000, 64, 1 << 20), (3, 1 << 12, 500)])
def test_suffix_dedup_equals_brute_force(spark, corpus, monkeypatch, frequent, bits, shard):
    """With the production parameters, every seed frequent, a full filter, and many small shards."""
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", bits)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    df, rows = hard_bytes(spark, corpus)
    got = rows_of(suffix_dedup.remove_earlier(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert got == brute_spans(rows)
    assert sum(r[2] for r in got) > 5000


def test_suffix_dedup_of_clashing_columns_and_nothing(corpus, empty):
    got = suffix_dedup.remove_earlier(corpus)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"] and got.count() == corpus.count()
    assert suffix_dedup.remove_earlier(empty).count() == 0


def test_filter_lets_little_through_at_eight_bits_a_hash(spark):
    rng = np.random.default_rng(11)
    kept, other = (rng.integers(0, 1 << 63, 100_000, dtype=np.uint64) << np.uint64(1) for _ in range(2))
    few = kept[:3]

    def count(batches):
        counts = bitmap.HashCounts(16, 1000)
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield from counts.add(np.concatenate([kept, few, few] if k else [kept, other[:50_000]]))
        yield from counts.deal()
    dealt = spark.range(0, 2, 1, 2).mapInArrow(count, "chunk long, data binary")
    assert bitmap.filter_bits(200_000, 16, 1 << 29) == 1 << 22 and bitmap.filter_bits(10**9, 16, 1 << 29) == 1 << 29
    words, often, places = bitmap.counted_filter(dealt, 16, 1 << 20, 2, 4)          # 10 bits a hash
    assert places == 200_006 and len(words) == 1 << 14
    assert bitmap.has_high(words, kept).all()
    assert bitmap.has_high(words, other).mean() < 0.05                              # with one bit a hash: 0.09
    assert sorted(few >> np.uint64(24)) == often.tolist()
    assert bitmap.among(often, few).all() and not bitmap.among(often, other).any() and not bitmap.among(often[:0], few).any()


def test_seeds_use_the_whole_filter():
    """Smallest hashes are small; as they are, nearly all of them would share an eighth of the words."""
    rng = np.random.default_rng(12)
    text = rng.integers(32, 127, 200_000).astype(np.uint8)
    seeds = suffix_dedup._Bytes(text, np.array([0, len(text)]), 50).seeds()
    share = np.bincount((seeds >> np.uint64(61)).astype(np.int64), minlength=8) / len(seeds)
    assert share.min() > 0.1 and share.max() < 0.15


def test_runs_of_near_copies_stand_together_and_are_merged_across_batches(spark):
    words = [" ".join(f"w{(i * 31 + k) % 97}x{i}" for k in range(60)) for i in range(40)]
    rows = [(d * 100 + i, ("" if d % 2 else "odd start ") + w) for d in range(4) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = rows_of(suffix_dedup.remove_earlier(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert got == brute_spans(rows)
    one = pa.RecordBatch.from_pydict({"r1": pa.array([1, 1, 2]), "r2": pa.array([1, 1, 1], pa.int32()), "low": pa.array([5, 3, 9]), "high": pa.array([5, 8, 9]),
                                      "text": pa.array([b"a", b"a", b"b"], pa.binary())})
    two = pa.RecordBatch.from_pydict({"r1": pa.array([2, 2]), "r2": pa.array([1, 2], pa.int32()), "low": pa.array([4, 1]), "high": pa.array([4, 1]),
                                      "text": pa.array([b"b", b"c"], pa.binary())})
    merged = pa.Table.from_batches(suffix_dedup._merged(iter([one, one.slice(0, 0), two])))
    assert merged.to_pydict() == {"r1": [1, 2, 2], "r2": [1, 1, 2], "low": [3, 4, 1], "high": [8, 9, 1], "text": [b"a", b"b", b"c"]}


# ------------------------------------------------------------ 12 filter audit

def brute_audit(docs, labels):
    low = {}
    for d, t, _ in docs:
        if d is not None:
            low[t or ""] = min(low.get(t or "", d), d)
    rows = []
    for d, t, part in docs:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        bad = ("A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
               + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (d is not None and low[t] < d))
        rows.append((part or "", bad, any(x == d and q == 1 for x, q, _ in labels if d is not None), any(x == d and y == 1 for x, _, y in labels if d is not None)))
    out = defaultdict(lambda: [0] * 6)
    for part in {r[0] for r in rows}:
        for o in permutations("ABCDE"):
            alive = [r for r in rows if r[0] == part]
            every = list(alive)
            for step, f in enumerate(o, 1):
                gone = [r for r in alive if f in r[1]]
                alive = [r for r in alive if f not in r[1]]
                failing = sum(f in r[1] for r in every)
                out[part, "".join(o), step] = [len(alive), len(gone), failing - len(gone), sum(r[1] == f for r in every),
                                               sum(r[2] for r in gone), sum(r[3] for r in gone)]
    total = Counter()
    for (part, o, step), x in out.items():
        total[part, o[step - 1]] += x[1]
    return sorted(((p, o, s, *x, total[p, o[s - 1]]) for (p, o, s), x in out.items()), key=str)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit_equals_brute_force(spark, corpus):
    extra = [(700, "Word " * 250, None), (701, "Word " * 250, ""), (702, "Word " * 250, "src1"), (None, "Word " * 250, "src1"), (703, "a b # " * 100, "src1")]
    docs = corpus.unionByName(spark.createDataFrame([(i, t, None, s, 1, "", 1, None) for i, t, s in extra], corpus.schema))
    labels = [(3, 1, 0), (3, 0, 1), (100, 1, 1), (101, None, 1), (None, 1, 1), (702, 1, None), (5, 0, 0), (130, 1, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = rows_of(filter_audit.interaction_audit(filter_audit.failure_masks(docs, marks)), *AUDIT)
    assert got == brute_audit([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], labels)


def test_filter_audit_of_nothing_and_without_labels(corpus, empty, spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interaction_audit(filter_audit.failure_masks(empty, marks)).count() == 0
    got = filter_audit.interaction_audit(filter_audit.failure_masks(corpus, marks))
    assert got.columns == AUDIT and got.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


# ------------------------------------------------------------ 13 phrase collocations

def brute_phrases(rows, least, top=2000):
    count, n = defaultdict(Counter), Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (t or "").translate(LOW)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in count.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            score, cut, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            inside = any(b >= least and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 80 * a
                         for q, b in c.items() if b >= least)
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def phrase_rows(corpus, spark):
    texts = [(r[0], r[1], r[2]) for r in corpus.select("doc_id", "text", "lang").collect()]
    texts += [(800 + i, "New York\tCity, new york  city; The\nNEW york is x. y new york" + " zu" * (i % 5), ("en", None, "und")[i % 3]) for i in range(20)]
    texts += [(900, "rare pair " * 9 + "!rare pair of words" * 7, "xx"), (901, "é漢 é漢 é漢 " * 8, "xx"), (902, "a b c d e " * 12 + "\x0bb c d", "xx")]
    return texts, spark.createDataFrame([(*t, 5, "n") for t in texts], "doc_id long, text string, lang string, phrase int, f string")


FOUND = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("share, count, bits", [(8, 2, 1 << 20), (1, 1, 1 << 20), (1 << 40, 1, 1 << 20), (8, 2, 64)])
def test_phrases_equal_brute_force(spark, corpus, monkeypatch, share, count, bits):
    """With a sample, with all documents as the sample, with an empty sample (only the border grows), with a full bitmap."""
    monkeypatch.setattr(phrases, "SAMPLE_SHARE", share)
    monkeypatch.setattr(phrases, "SAMPLE_COUNT", count)
    texts, df = phrase_rows(corpus, spark)
    got = phrases.collocations(*phrases.frequent_phrases(df, least=5, bits=bits))
    assert rows_of(got, *FOUND) == brute_phrases([(t, lang) for _, t, lang in texts], 5)


def test_top_phrases_and_flushes(spark, corpus, monkeypatch):
    monkeypatch.setattr(phrases, "FLUSH", 50)
    texts, df = phrase_rows(corpus, spark)
    got = phrases.collocations(*phrases.frequent_phrases(df, least=3, bits=1 << 20), top=3)
    assert rows_of(got, *FOUND) == brute_phrases([(t, lang) for _, t, lang in texts], 3, top=3)


def test_scores_pass_64_bits(spark):
    big = 3 * 10**14
    frequent = spark.createDataFrame([("en", "a", big + 5), ("en", "b", big), ("en", "a b", big - 7)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 4 * big)], "lang string, n long")
    got = phrases.collocations(frequent, totals).select(*FOUND).collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", big - 7, big + 5, big, 4 * big, 2000000 * (big - 7) // (2 * big + 5))]


def test_phrases_of_nothing(empty):
    assert phrases.collocations(*phrases.frequent_phrases(empty, bits=64)).count() == 0
