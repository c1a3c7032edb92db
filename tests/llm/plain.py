"""Plain versions of the operators, row by row, to hold them against."""

import re

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls in every column, empty and wordless texts, ties, repeated rows and repeated ids.
ODD = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \n\t ", "en", "b", 4),
    (4, "12 -- !!", "de", "a", 8),
    (None, "a text without an id, and some words", "en", "a", 30),
    (5, "the same row twice over and over", "en", "a", 32),
    (5, "the same row twice over and over", "en", "a", 32),
    (6, "one id", "en", None, 6),
    (6, "one id with another text", None, "c", 24),
    (None, None, None, None, None),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def fingerprint(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(count, linked):
    """The least member of each item's group."""
    least = list(range(count))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i in range(count):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def documents(spark, rows=ODD):
    """With columns whose names the operators use themselves."""
    extra = "k1 string, words string, size string, start string, score string, row string"
    full = [(*r, "x", "x", "x", "x", "x", "x") for r in rows]
    return spark.createDataFrame(full, f"{DOCUMENTS}, {extra}")


def empty(spark):
    return documents(spark, [])


def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def as_text(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*(columns or df.columns)).collect())
