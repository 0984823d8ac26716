"""Removal of long repeated substrings: anchors find the candidates, suffix arrays the exact repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .hashing import BASE, BYTE_VALUES, MASK, mix, powers
from .suffixes import suffix_array

GRAM = 64
BITS = 18
PIECE = (1 << BITS) - 4096
GROUP_ROWS = 2048
BLOCK_BYTES = 1 << 15

_POWERS = powers(1 << BITS)
_INVERSES = powers(1 << BITS, pow(BASE, -1, MASK + 1))


def anchors(text: bytes, size: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window, anchor position) of a text's anchors, in order.

    The anchor of a ``size``-byte window is its leftmost ``gram``-byte string of
    smallest hash, so equal windows have equal anchors at equal offsets. Windows with
    one anchor are consecutive and make one entry. Long texts are taken in pieces of
    bounded size that overlap by a window; an anchor at a seam makes two entries.
    """
    out, start = [], 0
    data = np.frombuffer(text, np.uint8)
    while start + size <= len(data):
        out.append([a + start if k else a for k, a in enumerate(_piece_anchors(data[start : start + PIECE], size, gram))])
        start += PIECE - size + 1
    if not out:
        return np.empty(0, np.int64), *[np.empty(0, np.int64)] * 3
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _piece_anchors(data: np.ndarray, size: int, gram: int) -> tuple:
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _POWERS[:n], out=sums[1:])
    hashes = mix((sums[gram:] - sums[:-gram]) * _INVERSES[: n - gram + 1])
    low = np.uint64((1 << BITS) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = size - gram + 1
    padded = np.full(-(-len(ranked) // width) * width, MASK, np.uint64)
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - size + 1
    at = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], windows) - 1
    return hashes[at[first]].view(np.int64), first, last, at[first]


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def _neighbours(parts: list[bytes]) -> list[int]:
    """The longest common prefix of each part with any other."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    best = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        common = _shared(parts[i], parts[j])
        best[i], best[j] = max(best[i], common), max(best[j], common)
    return best


def trimmed(contents: list[bytes], offset: list[int], size: int) -> list[tuple[int, int]]:
    """What of each context may repeat: as far from the anchor as any other context of the group agrees."""
    right = _neighbours([c[o:] for c, o in zip(contents, offset)])
    left = _neighbours([c[:o][::-1] for c, o in zip(contents, offset)])
    return [(o - a, o + b) if a + b >= size else (0, 0) for o, a, b in zip(offset, left, right)]


def repeated_windows(contents: list[bytes], size: int) -> list[np.ndarray]:
    """For each string, which of its ``size``-byte windows start anywhere else in the strings.

    The strings are joined and their suffixes sorted; windows of equal bytes are then
    next to each other, so each is compared with its neighbours alone.
    """
    joined = b"\0".join(contents)
    starts, at = [], 0
    for c in contents:
        starts.append(at)
        at += len(c) + 1
    window = np.zeros(len(joined) + 1, bool)
    for s, c in zip(starts, contents):
        window[s : s + max(0, len(c) - size + 1)] = True
    order = [i for i in suffix_array(joined) if window[i]]
    hit = np.zeros(len(joined) + 1, bool)
    last, last_window = -1, b""
    for i in order:
        here = joined[i : i + size]
        if here == last_window:
            hit[i] = hit[last] = True
        last, last_window = i, here
    return [hit[s : s + max(0, len(c) - size + 1)] for s, c in zip(starts, contents)]


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


class _Resolver:
    """Collects trimmed contexts of many anchors and sorts their suffixes block by block."""

    def __init__(self, size: int):
        self.size = size
        self.found: list[tuple[int, int, int]] = []
        self.strings: list[bytes] = []
        self.owners: list[tuple[int, int] | None] = []
        self.pending = 0

    def group(self, rows: list[tuple[bytes, int, bool, int, int]]) -> None:
        """Rows of one anchor: (content, anchor offset, decided, text, first window).

        Contents are distinct. Trimmed strings that come out equal at one offset are kept
        once if already known to repeat; a lone string is no repeat of another.
        """
        cuts = trimmed([r[0] for r in rows], [r[1] for r in rows], self.size)
        by_string: dict[tuple[bytes, int], list[int]] = {}
        for k, (a, b) in enumerate(cuts):
            if b > a:
                by_string.setdefault((rows[k][0][a:b], rows[k][1] - a), []).append(k)
        open_strings = []
        for (string, _), owners in by_string.items():
            sure = len(owners) > 1 or rows[owners[0]][2]
            if sure:
                for k in owners:
                    if not rows[k][2]:
                        start = rows[k][4] + cuts[k][0]
                        self.found.append((rows[k][3], start, start + len(string) - self.size))
            open_strings.append((string, None if sure else owners[0]))
        if any(k is not None for _, k in open_strings):
            for string, k in open_strings:
                self.strings.append(string)
                self.owners.append(None if k is None else (rows[k][3], rows[k][4] + cuts[k][0]))
                self.pending += len(string) + 1
            if self.pending > BLOCK_BYTES:
                self.resolve()

    def resolve(self) -> None:
        if self.strings:
            for owner, hits in zip(self.owners, repeated_windows(self.strings, self.size)):
                if owner is not None:
                    self.found += [(owner[0], owner[1] + a, owner[1] + b) for a, b in _runs(hits)]
        self.strings, self.owners, self.pending = [], [], 0

    def take(self) -> pa.RecordBatch:
        columns = [pa.array([f[k] for f in self.found], pa.int64()) for k in range(3)]
        self.found = []
        return pa.RecordBatch.from_arrays(columns, ["node", "first", "last"])


def _resolved(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: (hash, offset, content, decided, node, first)."""
    resolver, anchor, rows = _Resolver(size), None, []
    for batch in batches:
        for h, o, content, decided, node, first in zip(*(c.to_pylist() for c in batch.columns)):
            if h != anchor:
                if rows:
                    resolver.group(rows)
                anchor, rows = h, []
            rows.append((content, o, decided, node, first))
        if resolver.found:
            yield resolver.take()
    if rows:
        resolver.group(rows)
    resolver.resolve()
    yield resolver.take()


def _coverage(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Window ranges as disjoint maximal byte ranges."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + size)
        else:
            out.append([first, last + size])
    return [(a, b) for a, b in out]


def repeated_spans(
    docs: DataFrame, size: int = 200, id_column: str = "doc_id", text_column: str = "text", group_rows: int = GROUP_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows, the texts that occur more than once, and the repeated byte spans of all others.

    Returns (rows, texts, spans): rows hold ``id``, the text's key ``k1, k2`` (two
    independent checksums), ``n`` bytes and ``sha``; texts hold ``k1, k2, copies,
    node``; spans hold ``k1, k2, text, spans`` for texts that occur once and have any.
    """
    content = F.coalesce(text_column, F.lit("")).cast("binary")
    keyed = docs.select(F.col(id_column).alias("id"), content.alias("text"))
    keyed = keyed.select("id", F.xxhash64("text").alias("k1"), F.crc32("text").alias("k2"), F.length("text").alias("n"), "text")
    rows = saved(keyed.select("id", "k1", "k2", F.col("n").cast("long").alias("n"), F.sha2("text", 256).alias("sha")), "texts")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = [np.unique(anchors(t, size)[0], return_counts=True) for t in batch.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[0][f[1] > 1] for f in found], pa.list_(pa.int64()))],
                    ["id", "k1", "k2", "hashes", "twice"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    marked = keyed.where(f"n >= {size}").select("id", "k1", "k2", "text")
    marked = marked.mapInArrow(hashes, f"id {kind}, k1 long, k2 long, hashes array<long>, twice array<long>")
    texts = marked.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep"), F.first("hashes").alias("hashes"), F.first("twice").alias("twice")
    )
    texts = saved(texts.withColumn("node", F.monotonically_increasing_id()), "anchors")
    entries = texts.select("node", F.explode("hashes").alias("hash"))
    common = entries.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    shared = entries.join(common, "hash").unionByName(texts.select("node", F.explode("twice").alias("hash")))
    wanted = shared.groupBy("node").agg(F.collect_set("hash").alias("hashes"))
    wanted = saved(wanted.join(texts.drop("hashes", "twice"), "node"), "wanted")
    found = keyed.select("id", "k1", "k2", "text").join(wanted.hint("shuffle_hash"), ["k1", "k2"]).where(F.col("id").eqNullSafe(F.col("rep")))
    found = saved(found.select("node", "k1", "k2", "copies", "text", "hashes"), "candidates")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "copies", "hash", "offset", "first", "content"]
        for whole in batches:
            for k in range(whole.num_rows):
                node, copies, text, wanted = (whole.column(c)[k].as_py() for c in range(4))
                h, first, last, at = anchors(text, size)
                kept = np.flatnonzero(np.isin(h, np.array(wanted, np.int64)))
                parts = [text[a : b + size] for a, b in zip(first[kept].tolist(), last[kept].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(kept), node)), pa.array(np.full(len(kept), copies)), pa.array(h[kept]),
                        pa.array(at[kept] - first[kept]), pa.array(first[kept]), pa.array(parts, pa.binary()),
                    ],
                    names,
                )

    places = found.select("node", "copies", "text", "hashes").mapInArrow(
        contexts, "node long, copies long, hash long, offset long, first long, content binary"
    )
    places = saved(places, "contexts")
    contents = places.groupBy("hash", "offset", "content").agg(
        F.min("node").alias("node"), F.max("node").alias("other"), F.min("first").alias("first"), F.max("first").alias("later"), F.max("copies").alias("copies")
    )
    decided = (F.col("copies") > 1) | (F.col("node") != F.col("other")) | (F.col("first") != F.col("later"))
    contents = saved(contents.select("hash", "offset", "content", decided.alias("decided"), "node", "first"), "contents")
    groups = contents.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max(~F.col("decided")).alias("open"))
    groups = groups.where("n > 1 AND open").select("hash", (F.col("n") > group_rows).alias("large"))
    unclear = saved(contents.join(groups, "hash"), "unclear")
    small = unclear.where("NOT large").select("hash", "offset", "content", "decided", "node", "first")
    small = small.repartition("hash").sortWithinPartitions("hash")
    resolved = small.mapInArrow(lambda batches: _resolved(batches, size), "node long, first long, last long")
    whole = places.where("copies = 1").select("node", "first", (F.col("first") + F.length("content") - size).alias("last"))
    whole = whole.join(contents.where("NOT decided").select("node", "first"), ["node", "first"], "left_anti")
    spans = whole.unionByName(resolved).unionByName(_counted_windows(unclear.where("large"), size))
    spans = spans.groupBy("node").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return rows, texts.select("k1", "k2", "copies", "node"), found.where("copies = 1").join(spans, "node").select("k1", "k2", "text", "spans")


def _counted_windows(contents: DataFrame, size: int) -> DataFrame:
    """The same for anchors with very many contexts: every window's two hashes are counted, in partial sums."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(whole.num_rows):
                h, content, decided, node, first = (whole.column(c)[k].as_py() for c in range(5))
                count = len(content) - size + 1
                digests = [hashlib.blake2b(content[i : i + size], digest_size=16).digest() for i in range(count)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h] * count, pa.int64()), pa.array(digests, pa.binary()), pa.array([2 if decided else 1] * count, pa.int64()),
                        pa.array([node] * count, pa.int64()), pa.array(range(first, first + count), pa.int64()),
                    ],
                    ["hash", "digest", "times", "node", "first"],
                )

    each = contents.select("hash", "content", "decided", "node", "first").mapInArrow(
        windows, "hash long, digest binary, times long, node long, first long"
    )
    sums = each.groupBy("hash", "digest").agg(F.sum("times").alias("sum")).where("sum > 1")
    hits = each.where("times = 1").join(sums, ["hash", "digest"])
    return hits.select("node", "first", F.col("first").alias("last"))


def without_repeats(
    docs: DataFrame, size: int = 200, id_column: str = "doc_id", text_column: str = "text", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Remove every byte covered by a ``size``-byte string that also starts anywhere else in the texts.

    A text's windows are named by anchors; anchors that occur once cannot lie in a
    repeat. Around the others, contexts that are equal byte for byte in several places
    repeat throughout. Contexts of one anchor that differ are cut back to what another
    one agrees with, joined, and suffix arrays of the joined strings put equal windows
    side by side. An anchor with more than ``group_rows`` different contexts, too many
    for one task, has its windows' digests counted instead, with the same result.

    Returns one row per input row: ``id_column``, ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``kept_sha256`` of the remaining bytes. Null text counts as empty;
    texts that occur twice repeat as a whole, if long enough. Rows are matched by their
    texts, so ids may repeat or be null. Other columns are ignored.
    """
    rows, texts, spans = repeated_spans(docs, size, id_column, text_column, group_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, counts, digests = [], [], []
            for text, ranges in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gone = _coverage([(r["first"], r["last"]) for r in ranges], size)
                rest, at = hashlib.sha256(), 0
                for a, b in gone:
                    rest.update(text[at:a])
                    at = b
                rest.update(text[at:])
                removed.append(sum(b - a for a, b in gone))
                counts.append(len(gone))
                digests.append(rest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                ["k1", "k2", "removed", "spans", "digest"],
            )

    partly = spans.mapInArrow(cut, "k1 long, k2 long, removed long, spans long, digest string")
    copies = texts.where("copies > 1").select("k1", "k2")
    nothing = F.sha2(F.lit(b""), 256)
    wholly = copies.select("k1", "k2", F.lit(-1).cast("long").alias("removed"), F.lit(1).cast("long").alias("spans"), nothing.alias("digest"))
    found = saved(partly.unionByName(wholly), "removed")
    out = rows.join(found, ["k1", "k2"], "left")
    removed = F.when(F.col("removed") == -1, F.col("n")).otherwise(F.coalesce("removed", F.lit(0)))
    return out.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_bytes"),
        removed.cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("digest", "sha").alias("kept_sha256"),
    )
