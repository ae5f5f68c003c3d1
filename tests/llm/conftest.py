import pytest

WORDS = ("the of and to in is that it was for on are with as his they at be this from have or by one had not but what all were "
         "when we there can an your which their said if do will each about how up out them then she many some so these would").split()


def sentence(seed: int, n: int) -> str:
    """n words that differ from seed to seed (a linear congruential draw)."""
    out, x = [], seed * 2654435761 % 2**32
    for _ in range(n):
        x = (1103515245 * x + 12345) % 2**31
        out.append(WORDS[x >> 8 & 63 if (x >> 8 & 63) < len(WORDS) else 0] + str(x >> 16 & 31))
    return " ".join(out)


@pytest.fixture(scope="session")
def corpus(spark):
    """(doc_id, text, lang, source, n_chars) with nulls, empty and long texts, copies, near copies, shared
    passages, repeated rows and columns whose names clash with the operators' own."""
    shared = sentence(900, 60)
    rows = [(i, sentence(i, 30 + i % 50)) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(5)]                                     # copies
    rows += [(110 + i, rows[4][1].replace(" ", "\n", i + 1)) for i in range(4)]           # other white space, same words
    rows += [(120 + i, sentence(300 + i, 25) + " " + shared + "\t" + sentence(400 + i, 25)) for i in range(6)]
    rows += [(130, ""), (131, None), (132, " \n\t "), (133, "one"), (134, "Of OF of of"), (135, "der " * 90), (None, sentence(5, 44))]
    rows += [(140, sentence(77, 6000) + " " + shared), (141, "é漢😀 " * 30 + "#x# <b>|"), (142, "a b c d e f g h i j " * 6)]
    rows += [(3, rows[3][1]), (150, sentence(55, 40)), (150, sentence(55, 40)), (150, sentence(56, 40))]   # repeated ids
    data = [(i, t, ("en", "de", None)[(i or 0) % 3], f"src{(i or 0) % 4}" if i != 7 else None, 7, "x", 1, True) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, id string, key int, size boolean")


@pytest.fixture(scope="session")
def empty(corpus):
    return corpus.limit(0)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
