"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (single words and pairs, ``ORDERS``, in
the same ``BUCKETS`` buckets; add-one smoothing) are counted over whole texts: the
trusted target (documents labelled good) and the raw corpus (all documents).  A
document's score is the mean over its n-grams of log(p_target / p_raw), so word
order counts; every document with a score of ``THRESHOLD`` or more, and without a
failed base rule, is kept.  Equal texts get equal scores whatever the partitioning.

The raw corpus is counted without a join.  Only texts whose id may be trusted meet
the labels: a bitmap of ``FILTER_WORDS`` * 64 bits over the trusted ids goes first, a
shuffle join decides; a full bitmap lets more texts into that join and changes no
count.  The driver holds the ``BUCKETS`` ratios and the bitmap, whatever the corpus.
DataFrame operations only.

Base rules: at least 20 words, and at most 30 % of the words in 8-word windows
that occur twice or more in the text.

Nulls: a null text has no words and fails the base rules; a null id is kept as
it is and never trusted.  A document without words scores 0.  Without any trusted document the
target is uniform over the buckets.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from .util import barrier

BUCKETS = 1 << 16
ORDERS = (1, 2)                 # words in an n-gram
FILTER_WORDS = 1 << 16          # 512 KB of bits over the trusted ids
THRESHOLD = -0.1
MIN_WORDS = 20
MAX_REPEAT = 30                 # percent
WINDOW = 8
_SPACE = " \t\n\x0b\x0c\r"


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``words``, split once per row."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return barrier(df.withColumn("words", words), "words")


def grams(words: str = "words", orders: tuple[int, ...] = ORDERS) -> str:
    """SQL of the buckets of all n-grams of an array of words."""
    parts = []
    for n in orders:
        more = "".join(f", {words}[i + {k}]" for k in range(1, n))
        parts.append(f"transform(slice({words}, 1, greatest(size({words}) - {n - 1}, 0)), (w, i) -> cast(xxhash64(w{more}) & {BUCKETS - 1}L as int))")
    return f"concat({', '.join(parts)})"


def _counts(docs: DataFrame, text: str, orders: tuple[int, ...]) -> dict[int, int]:
    rows = (with_words(docs.select(text), text).select(F.explode(F.expr(grams("words", orders))).alias("bucket"))
            .groupBy("bucket").agg(F.count("*").alias("n")))
    return {r["bucket"]: r["n"] for r in rows.collect()}


def _trusted(docs: DataFrame, trusted: DataFrame, id_col: str, text: str) -> DataFrame:
    """The documents with a trusted id, without shuffling the others' texts."""
    ids = trusted.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    at = f"xxhash64({id_col}) & {FILTER_WORDS * 64 - 1}L"
    bit = "shiftleft(1L, cast(at & 63L as int))"
    words = (ids.select(F.expr(at).alias("at")).groupBy(F.expr("shiftright(at, 6)").alias("word")).agg(F.expr(f"bit_or({bit})").alias("bits")))
    bitmap = [0] * FILTER_WORDS
    for r in words.collect():
        bitmap[r["word"]] = r["bits"]
    table = "from_json('" + str(bitmap).replace(" ", "") + "', 'array<bigint>')"
    near = docs.select(id_col, text).where(F.expr(f"getbit({table}[cast(shiftright({at}, 6) as int)], cast(({at}) & 63L as int)) = 1"))
    # labels grow with the documents, so the join is by shuffle at every size
    return near.join(ids.hint("merge"), id_col, "left_semi")


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text", orders: tuple[int, ...] = ORDERS) -> list[float]:
    """log(p_target / p_raw) of each bucket; ``trusted`` has the ids of the trusted documents."""
    raw = _counts(docs, text, orders)
    target = _counts(_trusted(docs, trusted, id_col, text), text, orders)
    level = math.log(sum(raw.values()) + BUCKETS) - math.log(sum(target.values()) + BUCKETS)
    return [math.log(target.get(b, 0) + 1) - math.log(raw.get(b, 0) + 1) + level for b in range(BUCKETS)]


def score(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text: str = "text", orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """Base statistics, ``llr`` and the verdict of each document."""
    table = "from_json('[" + ",".join(repr(x) for x in ratios) + "]', 'array<double>')"
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    rows = with_words(docs.select(id_col, text), text)
    rows = barrier(rows.select(
        id_col, F.size("words").alias("n"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.element_at(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), 1).cast("long").alias("n_dup_lines"),
        F.expr(f"aggregate({grams('words', orders)}, 0D, (a, b) -> a + {table}[b])").alias("total"),
        F.expr("if(size(words) >= 8, transform(slice(words, 1, size(words) - 3), (w, i) -> "
               "xxhash64(w, words[i + 1], words[i + 2], words[i + 3])), cast(array() as array<bigint>))").alias("h4")),
        "n", "word_chars", "n_symbols", "n_dup_lines", "total", "h4")
    # A window found twice repeats five of its 4-word hashes: most texts do not.  Else the places of repeated
    # window hashes, by sorting, and the words that they cover.
    twice = ("transform(array(sort_array(transform(slice(h4, 1, size(h4) - 4), (x, i) -> struct(xxhash64(x, h4[i + 4]) as x, i as i)))), "
             "s -> filter(s, (y, k) -> get(s, k - 1).x <=> y.x or get(s, k + 1).x <=> y.x))[0]")
    repeats = (f"if(size(h4) - size(array_distinct(h4)) < 5, 0, aggregate(sort_array(transform({twice}, y -> y.i)), "
               f"named_struct('n', 0, 'at', -{WINDOW}), (a, i) -> named_struct('n', a.n + least({WINDOW}, i - a.at), 'at', i), a -> a.n))")
    rows = barrier(rows.select(id_col, F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                               F.expr(f"cast({repeats} as long)").alias("n_repeat_words"),
                               F.expr(f"if(n = 0, 0D, total / ({' + '.join(f'greatest(n - {k - 1}, 0)' for k in orders)}))").alias("llr")), "n_words", "n_repeat_words", "llr")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return rows.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       (~failed & (F.col("llr") >= THRESHOLD)).alias("kept"), "llr")
