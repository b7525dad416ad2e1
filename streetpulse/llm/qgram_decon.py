"""Benchmark decontamination by the q-gram lemma.

Texts are normalised (lower case, everything but letters, digits and non-ASCII
to one space) and compared as UTF-8 bytes. An item of m bytes may occur with
e = min(m * percent / 100, what the lemma allows) edits. By the q-gram lemma
such an occurrence shares at least T = m + 1 - q(e + 1) q-grams with the item,
all on diagonals (document position - item position) within e of each other.
Hits are counted per item in diagonal bands of width D + e that start every
D > e diagonals, so one band holds all of them; bands with T hits or more are
verified by an alignment restricted to the band.

The documents are never shuffled: each task scans whole texts against an index
of the benchmark, which is broadcast in blocks of about ``block_bytes`` of item
text; a larger benchmark takes more passes, each with an index of that size.

Defined cases: null or empty texts and items match nothing; items shorter than
one q-gram cannot be searched for; items with equal texts are all reported;
repeated rows of a document are each reported; a null doc_id is reported as
null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Q = 8  # bytes of a q-gram: one 64-bit number
PERCENT = 10
SHARED_PERCENT = 20  # T is at least this share of m: fewer edits where the lemma would ask for less
BLOCK_BYTES = 2 << 20
FILTER_BITS = 20
MATCHES = "doc_id long, item_id long, start long, end long, edits long"

# Letters and digits stay; any other ASCII byte is a space.
_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normalised(text: str | None) -> bytes:
    if not text:
        return b""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_KEEP).split())


def positions(text: str) -> np.ndarray:
    """Code point of ``text`` that each byte of ``normalised(text)`` comes from."""
    at, space = [], None
    for i, c in enumerate(text):
        for byte in c.lower().encode("utf-8", "surrogatepass").translate(_KEEP):
            if byte == 32:
                space = i
                continue
            if space is not None and at:
                at.append(space)
            space = None
            at.append(i)
    return np.array(at, np.int64)


def grams(data: bytes) -> np.ndarray:
    """All 8-byte q-grams of ``data`` as numbers, by position."""
    if len(data) < Q:
        return np.empty(0, np.uint64)
    x = np.frombuffer(data, np.uint8).astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return x


def _slot(x: np.ndarray) -> np.ndarray:
    return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)


@dataclass
class Index:
    """q-grams of a block of items, with their postings in one flat array."""
    ids: np.ndarray       # item_id
    texts: list           # normalised item
    edits: np.ndarray     # e
    least: np.ndarray     # T
    width: np.ndarray     # D
    keys: np.ndarray      # distinct grams, sorted
    first: np.ndarray     # postings of keys[i]: first[i] to first[i + 1]
    item: np.ndarray      # posting: item number
    at: np.ndarray        # posting: position in the item
    filter: np.ndarray    # slots that some gram has


def build_index(items: list[tuple[int, str]], percent: int = PERCENT) -> Index:
    rows = [(i, t) for i, t in ((i, normalised(t)) for i, t in items) if len(t) >= Q]
    m = np.array([len(t) for _, t in rows], np.int64)
    e = np.maximum(0, np.minimum(m * percent // 100, (m + 1 - m * SHARED_PERCENT // 100) // Q - 1))
    all_grams = [grams(t) for _, t in rows]
    flat = np.concatenate(all_grams) if rows else np.empty(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    keys, first = np.unique(flat[order], return_index=True)
    item = np.repeat(np.arange(len(rows)), [len(g) for g in all_grams])[order] if rows else np.empty(0, np.int64)
    at = np.concatenate([np.arange(len(g)) for g in all_grams])[order] if rows else np.empty(0, np.int64)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[_slot(keys)] = True
    return Index(np.array([i for i, _ in rows], np.int64), [t for _, t in rows], e, m + 1 - Q * (e + 1),
                 np.maximum(e + 1, 16), keys, np.append(first, len(flat)).astype(np.int64), item, at, seen)


def candidate_bands(data: bytes, ix: Index) -> list[tuple[int, int, int]]:
    """(item number, first and last diagonal) of the bands with enough hits."""
    x = grams(data)
    if not len(x) or not len(ix.keys):
        return []
    where = np.flatnonzero(ix.filter[_slot(x)])
    key = np.searchsorted(ix.keys, x[where])
    key[key == len(ix.keys)] = 0
    real = ix.keys[key] == x[where]
    where, key = where[real], key[real]
    if len(where) < ix.least.min():
        return []
    n = ix.first[key + 1] - ix.first[key]
    flat = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ix.first[key], n)
    item = ix.item[flat]
    longest = max(map(len, ix.texts))
    diagonal = np.repeat(where, n) - ix.at[flat] + longest      # not negative
    band, rest = np.divmod(diagonal, ix.width[item])
    second = (rest < ix.edits[item]) & (band > 0)               # the band before reaches e further
    bands = (len(data) + longest) // 16 + 2
    keys, hits = np.unique(np.concatenate([item * bands + band, item[second] * bands + band[second] - 1]),
                           return_counts=True)
    out = []
    for k in keys[hits >= ix.least[keys // bands]]:
        i, b = divmod(int(k), bands)
        low = b * int(ix.width[i]) - longest
        out.append((i, low, low + int(ix.width[i] + ix.edits[i])))
    return out


def banded(item: bytes, data: bytes, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of the whole item with a part
    of ``data`` on diagonals low - most to high + most; None above ``most``
    edits. A cell holds its edits and, in the lower bits, where it started."""
    found = data.find(item, max(0, low), max(0, high) + len(item))
    if found >= 0:
        return 0, found, found + len(item)
    low, high = low - most, high + most
    k = np.arange(low, high + 1)
    one, far = 1 << 32, 1 << 50
    text = np.frombuffer(data, np.uint8).astype(np.int64)
    text = np.concatenate([np.full(max(0, -low), -1), text, np.full(len(item) + max(0, high) + 1, -1)])
    shift = max(0, -low)
    cell = np.where((k >= 0) & (k <= len(data)), np.maximum(k, 0), far)
    slope = np.arange(len(k)) * one
    for i, byte in enumerate(item):
        seen = text[i + low + shift:i + high + 1 + shift]
        up = np.append(cell[1:], far) + one
        cell = np.minimum(cell + np.where(seen == byte, 0, np.where(seen < 0, far, one)), up)
        cell = np.minimum.accumulate(cell - slope) + slope
        cell = np.where((k + i + 1 >= 0) & (k + i + 1 <= len(data)), cell, far)
        if cell.min() >= (most + 1) * one:
            return None
    best = int(np.argmin(cell))
    edits, start = divmod(int(cell[best]), one)
    return (edits, start, int(k[best]) + len(item)) if edits <= most else None


def occurrences(text: str | None, ix: Index) -> list[tuple[int, int, int, int]]:
    """(item_id, start, end, edits) of each matching item's best occurrence,
    in code points of the text."""
    data = normalised(text)
    best: dict[int, tuple] = {}
    for i, low, high in candidate_bands(data, ix):
        got = banded(ix.texts[i], data, low, high, int(ix.edits[i]))
        if got and (i not in best or got < best[i]):
            best[i] = got
    if not best:
        return []
    at = positions(text)
    return [(int(ix.ids[i]), int(at[s]), int(at[e - 1]) + 1, d) for i, (d, s, e) in sorted(best.items())]


def index_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_bytes`` (by hash of the item)."""
    rows = benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def _indexes(spark: SparkSession, benchmark: DataFrame):
    for block in index_blocks(benchmark):
        items = [(r["item_id"], r["text"]) for r in block.collect()]  # about BLOCK_BYTES
        yield spark.sparkContext.broadcast(build_index(sorted(items)))


def find_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits: one row for each item that occurs in
    a document."""
    out = None
    for ix in _indexes(spark, benchmark):
        def scan(batches, ix=ix):
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"))
                        for m in occurrences(t.as_py(), ix.value)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                    names=["doc_id", "item_id", "start", "end", "edits"])
        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, MATCHES)
        out = part if out is None else out.unionByName(part)
    return out


def without_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) in which no item occurs."""
    for ix in _indexes(spark, benchmark):
        def clean(batches, ix=ix):
            for batch in batches:
                keep = [not occurrences(t.as_py(), ix.value) for t in batch.column("text")]
                yield batch.filter(pa.array(keep, pa.bool_()))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs
