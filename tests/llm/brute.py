"""Plain versions of the contracts, and rows that every operator must stand."""

import re

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, size string, part int, n_words string, row string, taken int, lang_pred string, key string"


def spaced(text):
    return SPACED.findall((text or "").encode())


def alnum(text):
    return ALNUM.findall((text or "").encode().lower())


def odd_rows():
    """NULLs, empty and very long texts, ties, repeated rows and ids; columns named like inner ones."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    texts = [
        (1, "the cat sat on the mat and the dog ran to the house by the old river bank today", "en", "a"),
        (1, "the cat sat on the mat and the dog ran to the house by the old river bank today", "en", "a"),
        (2, "the cat sat on the mat and the dog ran to the house by the old river bank today", "en", "b"),
        (2, "another text under the same id", "en", "b"),
        (None, "the cat sat on the mat and the dog ran to the house by the old river bank today", "en", None),
        (None, None, None, None),
        (3, None, "de", "a"),
        (4, "", None, "c"),
        (5, " \t\n ", "fr", "c"),
        (6, "12 34 %% --", "de", "c"),
        (7, long, "en", "a"),
        (8, long + " end", "en", ""),
        (9, "Größe und Maß der Straße sind überall gleich gewesen heute", "de", "d"),
        (10, "x", "de", "d"),
    ]
    return [(i, t, lang, source, len(t or ""), 0.5, "s", 1, "n", "r", 2, "p", "k") for i, t, lang, source in texts]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, k=5):
    words = [w.lower() for w in spaced(text)]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def groups(sets, num=3, den=4):
    """Smallest index reachable by links, for a list of sets."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and common * den >= num * (len(a) + len(sets[j]) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]
