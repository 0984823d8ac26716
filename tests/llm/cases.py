"""Small tables with the awkward cases that every operator must take, and brute-force helpers."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, node long, salt int"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(start, count, step=1):
    return " ".join(WORDS[(start + i * step + i * i // 7) % len(WORDS)] + str((start + i) % 13) for i in range(count))


def awkward_rows():
    """Null and empty texts, repeated rows, null ids and sources, ties, near copies, a long text, odd characters."""
    base = prose(3, 60)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base + " tail", "en", "b"),
        (4, None, None, None),
        (5, "", "de", "b"),
        (6, "   \n\t ", "de", "b"),
        (None, "no id here", "en", "a"),
        (None, None, "en", None),
        (7, "one two", "fr", "é"),
        (8, "One  TWO", "fr", "é"),
        (9, prose(11, 40, 5), "fr", "a"),
        (10, prose(0, 9000, 3), "en", "c"),
        (11, "\x00\x01 ünï   çödé \U0001f600", "es", "c"),
        (12, prose(50, 80, 7) + "\n" + base, "es", "c"),
        (13, "Released under the MIT license. Apache License, Version 2.0", "en", "b"),
        (14, "a\x0bb\x0cc", "en", "b"),
        (15, "a b c", "en", "b"),
    ]
    return [(i, t, l, s, len(t or ""), "clash", 7, 1) for i, t, l, s in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
