"""License scan: exact phrases by words, and short notices with a bounded number of edits."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose places are counted, with their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Public short notices in normalised words, with their labels.
NOTICES = BASE + (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("spdx license identifier mit", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("spdx license identifier apache 2 0", "apache-2"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("under the gnu general public license version 2", "gpl-2"),
    ("under the gnu general public license version 3", "gpl-3"),
    ("under the gnu lesser general public license", "lgpl"),
    ("under the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("under the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
)

SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
AS_SPACE = bytes(32 if b in SEPARATORS else b for b in range(256))


def edits_allowed(phrase: str) -> int:
    """One edit for each 12 characters, 4 at most; notices under 12 characters must be exact."""
    return min(4, len(phrase) // 12)


def pieces(phrase: str, parts: int) -> list[tuple[int, str]]:
    """``parts`` consecutive pieces of nearly equal length with their offsets: one survives ``parts - 1`` edits."""
    cuts = [round(i * len(phrase) / parts) for i in range(parts + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class NoticeScanner:
    """Finds base phrases and notices in the words of one text."""

    def __init__(self, base=BASE, notices=NOTICES):
        self.base = [(f" {phrase} ".encode(), phrase.count(" ") + 1, label) for phrase, label in base]
        self.notices, self.seeds = [], {}
        for number, (phrase, label) in enumerate(notices):
            allowed = edits_allowed(phrase)
            pattern = regex.compile(f"(?b) (?:{phrase}){{e<={allowed}}} ".encode())
            self.notices.append((phrase, label, allowed, pattern))
            for offset, piece in pieces(phrase, allowed + 1):
                self.seeds.setdefault(piece.encode(), []).append((number, offset))

    def exact(self, joined: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place of every base phrase."""
        found = []
        for phrase, _, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                found.append((joined.count(b" ", 0, at), label))
                at = joined.find(phrase, at + 1)
        return found

    def fuzzy(self, joined: bytes) -> list[tuple[str, int, int, int, float]]:
        """(label, first word, last word, edits, score) of verified notices; of overlapping ones the best stay."""
        windows: dict[int, list[list[int]]] = {}
        hits = []
        for seed, uses in self.seeds.items():
            at = joined.find(seed)
            while at >= 0:
                hits += [(at - offset, number) for number, offset in uses]
                at = joined.find(seed, at + 1)
        for origin, number in sorted(hits):
            phrase, _, allowed, _ = self.notices[number]
            start, end = max(0, origin - allowed - 1), min(len(joined), origin + len(phrase) + allowed + 1)
            spans = windows.setdefault(number, [])
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end])
        found = []
        for number, spans in windows.items():
            phrase, label, allowed, pattern = self.notices[number]
            for start, end in spans:
                parts = [(start, end)]
                while parts:  # the best match of a part need not be its first: what stands on both sides is searched too
                    left, right = parts.pop()
                    if match := pattern.search(joined, left, right):
                        a, b = match.start() + 1, match.end() - 1  # between the spaces: whole words
                        parts += [(left, a), (b, right)]
                        edits = sum(match.fuzzy_counts)
                        found.append((edits, a - b, a, b, label, 1 - edits / len(phrase)))
        kept: list[tuple] = []
        for hit in sorted(found):
            if not any(hit[2] < k[3] and k[2] < hit[3] and (hit[4] == k[4] or hit[0] > k[0]) for k in kept):
                kept.append(hit)
        return [
            (label, joined.count(b" ", 0, a) - 1, joined.count(b" ", 0, b) - 1, edits, score)
            for edits, _, a, b, label, score in sorted(kept, key=lambda h: h[2:4])
        ]

    def __call__(self, text: bytes) -> dict:
        words = text.lower().translate(AS_SPACE).split(b" ")
        joined = b" " + b" ".join(w for w in words if w) + b" "
        base = self.exact(joined)
        spans = self.fuzzy(joined)
        starts = [s for s, _ in base]
        return {
            "n_words": joined.count(b" ") - 1 if len(joined) > 2 else 0,
            "n_base": len(base),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": sorted({label for _, label in base}),
            "spans": spans,
            "score": 1.0 if base else max((s[4] for s in spans), default=0.0),
        }


RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())),
        (
            "spans",
            pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int64()), ("score", pa.float64())])),
        ),
        ("score", pa.float64()),
    ]
)
SPARK_RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "spans array<struct<label:string,first:long,last:long,edits:long,score:double>>, score double"
)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", base=BASE, notices=NOTICES) -> DataFrame:
    """Scan every whole text for base phrases and, with edits, for license notices.

    Text is lower-cased (A-Z) and cut into words; a base phrase counts wherever its
    words stand consecutively. A notice may differ by ``edits_allowed`` insertions,
    deletions or substitutions of bytes: cut into one piece more than that, one piece
    must occur exactly, which locates candidates; a bounded-error pattern over the
    candidate's surroundings then verifies the edits and gives the span, which begins
    and ends at words. Where notices overlap, the one with fewer edits stays.

    Returns one row per input row: ``id_column`` and the fields of ``SPARK_RESULT``;
    spans hold word positions from 0, the score is 1 with a base phrase, else the best
    span's 1 - edits/length, else 0. Null text counts as empty. Each row is scanned
    alone, so ids may repeat or be null. Other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = NoticeScanner(base, notices)
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                found = []
                for text in batch.column(1).to_pylist():
                    row = scanner(text)
                    row["spans"] = [dict(zip(("label", "first", "last", "edits", "score"), s)) for s in row["spans"]]
                    found.append(row)
                values = pa.array(found, RESULT)
                yield pa.RecordBatch.from_arrays([batch.column(0), *values.flatten()], ["id", *[f.name for f in RESULT]])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(scan, f"id {kind}, {SPARK_RESULT}").withColumnRenamed("id", id_column)
