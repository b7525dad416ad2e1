"""Substring deduplication over a logarithmic family of suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller doc_id is removed; documents are UTF-8 bytes.

Documents are packed into chunks. Of a text's suffixes only those at anchors are
indexed: an anchor is a place whose 16-byte gram has the least hash of a window
of 50 bytes, so every 50-byte string holds an anchor, and equal strings hold it
at the same place. A chunk's suffix array lists its anchors' suffixes in
lexicographic order (to the depth of the gram), cut into key ranges ("parts").

Chunks come in batches. A batch's arrays are merge-scanned, part by part, with
the arrays of every existing level: suffixes that meet an equal one of another
document are hits of the chunks that hold them. In the same scan the batch and
all levels as large as what has been carried so far merge into one array of the
next size, as in a binary counter, so a suffix is rewritten a logarithmic number
of times. A level keeps one entry a suffix: a chunk that holds it, how often it
was seen and whether it has been reported.

Hits say that 16 bytes agree; the long matches are settled on content. Each
chunk sends the distinct 84-byte contexts of its hits (all 50-byte strings
around an anchor) to the part of their suffix, with the smallest doc_id that has
them. There equal contexts give the smallest document, and among the different
contexts of one gram all 50-byte windows are compared. The chunk gets back what
is covered and cuts its texts. A gram with more than ``HOT`` occurrences never
meets in one part: its windows, distinct within a chunk, go to parts of their
own by hash.

Defined cases: null and empty texts have no bytes (the digest of nothing); a
text under 50 bytes is kept; rows with one doc_id remove nothing from each
other; a null doc_id counts as larger than all, and such rows remove nothing
from each other; equal texts of one chunk are held once; very long texts and
long runs are taken in blocks; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetpulse.llm.tables import stored
from streetpulse.session import scratch_path

LENGTH = 50
GRAM = 16
ROOM = LENGTH - GRAM          # bytes of a window that may lie on either side of its anchor
CONTEXT = LENGTH + ROOM       # bytes of all windows around an anchor
CHUNK_BYTES = 4 << 20
BATCHES = 4
PART_ENTRIES = 1 << 20        # suffixes of a part of all levels together, on average
DENSITY = 0.055               # anchors a byte, about 2 / (ROOM + 2)
HOT = 1 << 16                 # occurrences beyond which a gram's windows are settled as rows
HOT_SHARE = 20                # at most 2**HOT_SHARE grams can be hot
LEVEL = 1                     # of compression
SEPARATOR = 255               # no byte of UTF-8
NO_ID = np.iinfo(np.int64).max
BLOCK = 1 << 16
ROWS = 1 << 17                # contexts hashed at once

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_U = np.uint64


def _packed(*values) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(pickle.dumps(values, 5))


def _unpacked(body: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(bytes(body)))


def _slim(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _slide(x: np.ndarray, size: int, f) -> np.ndarray:
    """f over all windows of ``size``."""
    done = 1
    while done * 2 <= size:
        x, done = f(x[:-done], x[done:]), done * 2
    return f(x[:len(x) - (size - done)], x[size - done:]) if done < size else x


def _gram_hashes(a: np.ndarray) -> np.ndarray:
    h, size = a.astype(_U) + _U(1), 1
    while size < GRAM:
        h, size = h[:-size] * _U(pow(_MULTIPLIERS[0], size, 1 << 64)) + h[size:], size * 2
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (h ^ (h >> _U(32))) | _U(1)


def anchors(a: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Places of the least gram (all of equal ones) of every window that holds
    no separator; ``cuts`` are the separators' places."""
    out = []
    for low in range(0, len(a), BLOCK):
        first, last = max(0, low - ROOM), min(len(a), low + BLOCK + LENGTH - 1)
        if last - first < LENGTH:
            break
        h = _gram_hashes(a[first:last])
        least = _slide(h, ROOM + 1, np.minimum)          # by window start
        for cut in cuts[np.searchsorted(cuts, first):np.searchsorted(cuts, last)] - first:
            least[max(0, cut - LENGTH + 1):cut + 1] = 0  # no hash is 0
        edge = np.zeros(ROOM, _U)
        chosen = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), ROOM + 1, np.maximum) == h) + first
        out.append(chosen[(chosen >= low) & (chosen < low + BLOCK)])
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Chunk:
    """Distinct texts with their doc_ids, as one buffer with separators."""

    def __init__(self, body: bytes):
        self.texts, self.ids = _unpacked(body)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        order = [[NO_ID if i is None else i for i in own] for own in self.ids]
        self.low = np.array([min(own) for own in order], np.int64)
        self.high = np.array([max(own) for own in order], np.int64)
        self.buffer = np.frombuffer(bytes([SEPARATOR]).join(self.texts), np.uint8)
        self.at = anchors(self.buffer, self.starts[1:] - 1)
        self.text = np.searchsorted(self.starts, self.at, "right") - 1

    def words(self, at: np.ndarray) -> np.ndarray:
        """The grams at ``at`` as two numbers in lexicographic order."""
        if not len(at):
            return np.empty((0, 2), _U)
        return sliding_window_view(self.buffer, GRAM)[at].view(">u8").astype(_U)

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """The bytes around the anchors; what is beyond the text is SEPARATOR."""
        if not len(at):
            return np.empty((0, CONTEXT), np.uint8)
        edge = np.full(ROOM, SEPARATOR, np.uint8)
        if not hasattr(self, "wide"):
            self.wide = np.concatenate([edge, self.buffer, edge])
        c = sliding_window_view(self.wide, CONTEXT)[at]
        cut = np.flatnonzero((c == SEPARATOR).any(axis=1))
        if len(cut):
            part = c[cut]
            gone = part == SEPARATOR
            gone[:, :ROOM] = np.maximum.accumulate(gone[:, :ROOM][:, ::-1], axis=1)[:, ::-1]
            gone[:, ROOM:] = np.maximum.accumulate(gone[:, ROOM:], axis=1)
            part[gone] = SEPARATOR
            c[cut] = part
        return c


def _pack(batches):
    def packed(held):
        return pa.record_batch([pa.array([_packed(list(held), list(held.values()))], pa.binary()),
                                pa.array([sum(map(len, held))], pa.int64())], names=["body", "bytes"])
    held, size = {}, 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
            text = text.as_py() or b""
            if text in held:
                held[text].append(doc_id)
                continue
            if held and size + len(text) > CHUNK_BYTES:
                yield packed(held)
                held, size = {}, 0
            held[text] = [doc_id]
            size += len(text)
    if held:
        yield packed(held)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in sorted arrays."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def suffix_array(chunk: Chunk):
    """(grams as words in order, occurrences, whether two documents hold it)."""
    w = chunk.words(chunk.at)
    order = np.lexsort((w[:, 1], w[:, 0]))
    w, text = w[order], chunk.text[order]
    runs = _runs(w[:, 0], w[:, 1])
    if not len(runs):
        return w, np.empty(0, np.int64), np.empty(0, bool)
    shared = np.maximum.reduceat(chunk.high[text], runs) > np.minimum.reduceat(chunk.low[text], runs)
    return w[runs], np.diff(np.append(runs, len(w))), shared


def _text_keys(w: np.ndarray) -> np.ndarray:
    """Words as fixed byte strings: numpy orders them like the bytes."""
    return np.ascontiguousarray(w.astype(">u8")).view(f"S{GRAM}").ravel()


def _planes(w: np.ndarray) -> np.ndarray:
    """The grams' bytes column by column: neighbours share their first ones."""
    return np.ascontiguousarray(w.astype(">u8").view(np.uint8).reshape(len(w), GRAM).T)


def _words_of(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(">u8").astype(_U).reshape(-1, 2)


def _cuts(w: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the parts begin and end in sorted words."""
    return np.concatenate([[0], np.searchsorted(_text_keys(w), bounds), [len(w)]]).astype(np.int64)


def _sampled_keys(batches):
    for batch in batches:
        for body in batch.column("body"):
            w, _, _ = suffix_array(Chunk(body.as_py()))
            some = w[::max(1, len(w) // 4096)]
            yield pa.record_batch([pa.array([bytes(k).ljust(GRAM, b"\0") for k in _text_keys(some)], pa.binary())], names=["key"])


ARRAYS = "part int, level int, chunk bigint, body binary"


def _suffix_arrays(bounds):
    def run(batches):
        for batch in batches:
            for number, body in zip(batch.column("chunk").to_pylist(), batch.column("body")):
                w, seen, shared = suffix_array(Chunk(body.as_py()))
                cuts = _cuts(w, bounds.value)
                parts = np.flatnonzero(np.diff(cuts))
                bodies = [_packed(_planes(w[cuts[p]:cuts[p + 1]]), _slim(seen[cuts[p]:cuts[p + 1]]), shared[cuts[p]:cuts[p + 1]])
                          for p in parts]
                yield pa.record_batch([pa.array(parts, pa.int32()), pa.array([-1] * len(parts), pa.int32()),
                                       pa.array([number] * len(parts), pa.int64()), pa.array(bodies, pa.binary())],
                                      names=["part", "level", "chunk", "body"])
    return run


SCANNED = "kind string, part int, level int, chunk bigint, body binary"


def _merge_scan(carried: frozenset, new_level: int, hot: int):
    """Merges the arrays of one part: hits of the chunks, hot grams, and the new
    level made of the batch and the carried ones (none if ``new_level`` < 0)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words, chunks, seen, known, joins = [], [], [], [], []
        for level, chunk, body in zip(pdf["level"], pdf["chunk"], pdf["body"]):
            held = _unpacked(body)
            w = _words_of(held[0])
            words.append(w)
            seen.append(held[1].astype(np.int64))
            known.append(held[2])
            chunks.append(held[4][held[3]] if level >= 0 else np.full(len(w), chunk, np.int64))
            joins.append(np.full(len(w), 0 if level < 0 else 1 if level in carried else 2, np.int8))
        w, chunks, seen, known, joins = map(np.concatenate, (words, chunks, seen, known, joins))
        order = np.lexsort((chunks, w[:, 1], w[:, 0]))
        w, chunks, seen, known, joins = w[order], chunks[order], seen[order], known[order], joins[order]
        runs = _runs(w[:, 0], w[:, 1])
        sizes = np.diff(np.append(runs, len(w)))
        shared = (sizes > 1) | np.logical_or.reduceat(known, runs)
        total = np.add.reduceat(seen, runs)
        part, out = int(pdf["part"].iloc[0]), []
        told = np.repeat(shared, sizes) & ((joins == 0) | ~known)
        by_chunk = np.flatnonzero(told)[np.argsort(chunks[told], kind="stable")]
        starts = _runs(chunks[by_chunk]) if len(by_chunk) else []
        for own in np.split(by_chunk, starts[1:]) if len(by_chunk) else []:
            out.append(("hit", part, -1, int(chunks[own[0]]), _packed(_planes(w[own]))))
        many = runs[total > hot]
        if len(many):
            out.append(("hot", part, -1, -1, _packed(_planes(w[many]))))
        if new_level >= 0:
            kept = np.flatnonzero(joins < 2)
            first = kept[_runs(w[kept, 0], w[kept, 1])]
            of_run = np.repeat(np.arange(len(runs)), sizes)
            counts = np.bincount(of_run[kept], seen[kept], minlength=len(runs)).astype(np.int64)[of_run[first]]
            numbers, index = np.unique(chunks[first], return_inverse=True)
            out.append(("level", part, new_level, -1, _packed(_planes(w[first]), _slim(counts), shared[of_run[first]],
                                                              _slim(index), numbers)))
        return pd.DataFrame(out, columns=["kind", "part", "level", "chunk", "body"])
    return run


def _mixed_words(w: np.ndarray) -> np.ndarray:
    h = w[:, 0] * _U(_MULTIPLIERS[0]) + (w[:, 1] ^ (w[:, 1] >> _U(29))) * _U(_MULTIPLIERS[1])
    return h ^ (h >> _U(32))


def _column_hashes(c: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of every row."""
    out = [np.zeros(len(c), _U) for _ in _MULTIPLIERS]
    for column in np.ascontiguousarray(c.T):
        value = column.astype(_U) + _U(1)
        for i, base in enumerate(_MULTIPLIERS):
            out[i] = out[i] * _U(base) + value
    return out


class Hits:
    """A chunk's hit anchors, in classes of equal contexts in suffix order."""

    def __init__(self, chunk: Chunk, bodies: list, hot: np.ndarray):
        self.chunk = chunk
        told = [_words_of(_unpacked(b)[0]) for b in bodies]
        w = chunk.words(chunk.at)
        near = np.isin(_mixed_words(w), _mixed_words(np.concatenate(told))) if told else np.zeros(len(w), bool)
        at, text, w = chunk.at[near], chunk.text[near], w[near]
        parts = [_column_hashes(chunk.contexts(at[i:i + ROWS])) for i in range(0, len(at), ROWS)]
        h1, h2 = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, _U) for i in range(2))
        order = np.lexsort((h2, h1, w[:, 1], w[:, 0]))
        self.at, self.text, w = at[order], text[order], w[order]
        runs = _runs(w[:, 0], w[:, 1], h1[order], h2[order])
        self.group = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(w))))
        self.first, self.words = self.at[runs], w[runs]
        self.low = np.minimum.reduceat(chunk.low[self.text], runs) if len(runs) else np.empty(0, np.int64)
        self.hot = np.isin(_text_keys(self.words), hot) if len(runs) else np.empty(0, bool)

    def hot_windows(self):
        """(hashes, smallest document of the chunk) of the distinct windows
        around hot anchors in the order of their hashes; per hot class and place
        the window's number, -1 beyond the text."""
        many = np.flatnonzero(self.hot)
        number = np.full((len(many), ROOM + 1), -1, np.int64)
        if not len(many):
            return np.empty((0, 2), _U), self.low[many], number
        h1, h2, valid = windows(self.chunk.contexts(self.first[many]))
        row, place = np.nonzero(valid)
        h1, h2 = h1[valid], h2[valid]
        order = np.lexsort((h2, h1))
        runs = _runs(h1[order], h2[order])
        number[row[order], place[order]] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
        low, first = self.low[many][row[order]], order[runs]
        return np.column_stack([h1[first], h2[first]]), np.minimum.reduceat(low, runs) if len(runs) else low, number


def windows(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts: (hash, hash, whether it lies within the text) of all their
    windows, a column each."""
    hashes = []
    for base in _MULTIPLIERS:
        sums = np.zeros((CONTEXT + 1, len(c)), _U)
        for i, column in enumerate(np.ascontiguousarray(c.T)):
            sums[i + 1] = sums[i] * _U(base) + column.astype(_U) + _U(1)
        h = sums[LENGTH:] - sums[:-LENGTH] * _U(pow(base, LENGTH, 1 << 64))
        hashes.append(((h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)).T)
    gone = np.concatenate([np.zeros((len(c), 1), np.int16), np.cumsum(c == SEPARATOR, axis=1, dtype=np.int16)], axis=1)
    return hashes[0], hashes[1], gone[:, LENGTH:] == gone[:, :-LENGTH]


CONTEXTS = "part int, chunk bigint, body binary"


def _contexts(bounds, hot):
    """Per chunk and part the contexts of cold grams and, in parts beyond, the
    windows of hot ones."""
    def run(batches):
        for batch in batches:
            for number, body, bodies in zip(*[batch.column(c).to_pylist() for c in ("chunk", "body", "hits")]):
                hits = Hits(Chunk(body), bodies or [], hot.value)
                cold, n_parts = np.flatnonzero(~hits.hot), len(bounds.value) + 1
                cuts = _cuts(hits.words[cold], bounds.value)
                parts = np.flatnonzero(np.diff(cuts)).tolist()
                own = [cold[cuts[p]:cuts[p + 1]] for p in parts]
                bodies = [_packed(hits.chunk.contexts(hits.first[o]), hits.low[o]) for o in own]
                w, low, _ = hits.hot_windows()
                cuts = np.searchsorted(w[:, 0], np.arange(n_parts, dtype=_U) * _U(((1 << 64) - 1) // n_parts))
                cuts = np.append(cuts, len(w))
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    some = slice(cuts[p], cuts[p + 1])
                    parts.append(n_parts + p)
                    bodies.append(_packed(w[some], low[some]))
                yield pa.record_batch([pa.array(parts, pa.int32()), pa.array([number] * len(parts), pa.int64()),
                                       pa.array(bodies, pa.binary())], names=["part", "chunk", "body"])
    return run


def covered_windows(c: np.ndarray, low: np.ndarray, gram_starts: np.ndarray, rows: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct contexts, those of one gram together: the bytes covered by
    windows that a context with a smaller document holds too (0, 0: none)."""
    begin, end = np.zeros(len(c), np.uint8), np.zeros(len(c), np.uint8)
    edges = np.append(gram_starts, len(c))
    several = np.flatnonzero(np.diff(edges) > 1)
    at = 0
    while at < len(several):
        stop = at + 1
        size = edges[several[at] + 1] - edges[several[at]]
        while stop < len(several) and size + edges[several[stop] + 1] - edges[several[stop]] <= rows:
            size += edges[several[stop] + 1] - edges[several[stop]]
            stop += 1
        own = np.concatenate([np.arange(edges[g], edges[g + 1]) for g in several[at:stop]])
        at = stop
        h1, h2, valid = windows(c[own])
        row, place = np.nonzero(valid)
        h1, h2 = h1[valid], h2[valid]
        order = np.lexsort((h2, h1))
        h1, h2, row, place = h1[order], h2[order], row[order], place[order]
        runs = _runs(h1, h2)
        if not len(runs):
            continue
        least = np.repeat(np.minimum.reduceat(low[own][row], runs), np.diff(np.append(runs, len(row))))
        hit = least < low[own][row]
        first, last = np.full(len(own), 255), np.full(len(own), -1)
        np.minimum.at(first, row[hit], place[hit])
        np.maximum.at(last, row[hit], place[hit])
        some = last >= 0
        begin[own[some]], end[own[some]] = first[some], last[some] + LENGTH
    return begin, end


def _settled_contexts(bodies: list) -> list[bytes]:
    """For each chunk's contexts the smallest document that has them, and the
    bytes that windows of other contexts cover."""
    sizes = [len(h[1]) for h in bodies]
    c, low = np.concatenate([h[0] for h in bodies]), np.concatenate([h[1] for h in bodies])
    w = np.ascontiguousarray(c[:, ROOM:ROOM + GRAM]).view(">u8").astype(_U)
    parts = [_column_hashes(c[i:i + ROWS]) for i in range(0, len(c), ROWS)]
    h1, h2 = (np.concatenate([p[i] for p in parts]) for i in range(2))
    order = np.lexsort((h2, h1, w[:, 1], w[:, 0]))
    runs = _runs(w[order, 0], w[order, 1], h1[order], h2[order])
    least = np.minimum.reduceat(low[order], runs)
    reps = order[runs]
    begin, end = covered_windows(c[reps], least, _runs(w[reps, 0], w[reps, 1]))
    of = np.empty(len(c), np.int64)
    of[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(c))))
    edges = np.cumsum([0, *sizes])
    return [_packed(least[of[a:b]], begin[of[a:b]], end[of[a:b]]) for a, b in zip(edges[:-1], edges[1:])]


def _settled_windows(bodies: list) -> list[bytes]:
    """For each chunk's windows the smallest document that has them."""
    sizes = [len(h[1]) for h in bodies]
    w, low = np.concatenate([h[0] for h in bodies]), np.concatenate([h[1] for h in bodies])
    order = np.lexsort((w[:, 1], w[:, 0]))
    runs = _runs(w[order, 0], w[order, 1])
    least = np.empty(len(w), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(low[order], runs), np.diff(np.append(runs, len(w))))
    edges = np.cumsum([0, *sizes])
    return [_packed(least[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def _settle(n_parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        settled = _settled_contexts if pdf["part"].iloc[0] < n_parts else _settled_windows
        return pd.DataFrame({"part": pdf["part"], "chunk": pdf["chunk"], "body": settled([_unpacked(b) for b in pdf["body"]])})
    return run


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _cut(text: bytes, begins: np.ndarray, ends: np.ndarray):
    """(removed, spans, digest of the rest) of a text without the intervals."""
    if not len(begins):
        return 0, 0, hashlib.sha256(text).hexdigest()
    steps = np.bincount(begins, minlength=len(text) + 1) - np.bincount(ends, minlength=len(text) + 1)
    gone = np.cumsum(steps[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest()


def _hot_cuts(hits: Hits, least: np.ndarray) -> np.ndarray:
    """(text, begin, end) of what a smaller document's windows cover around hot
    anchors; places are those of the buffer. ``least`` has the smallest document
    of each of the chunk's hot windows."""
    number = hits.hot_windows()[2]
    by_class = np.where(number >= 0, np.append(least, NO_ID)[number], NO_ID)
    row = np.cumsum(hits.hot) - 1
    hot = np.flatnonzero(hits.hot[hits.group]) if len(hits.group) else np.empty(0, np.int64)
    out = [np.empty((0, 3), np.int64)]
    for i in range(0, len(hot), ROWS):
        some = hot[i:i + ROWS]
        covered = by_class[row[hits.group[some]]] < hits.chunk.low[hits.text[some]][:, None]
        some, covered = some[covered.any(axis=1)], covered[covered.any(axis=1)]
        begin = hits.at[some] - ROOM
        out.append(np.column_stack([hits.text[some], begin + covered.argmax(axis=1),
                                    begin + ROOM - covered[:, ::-1].argmax(axis=1) + LENGTH]))
    return np.concatenate(out)


def _apply(hot):
    def run(batches):
        for batch in batches:
            for body, bodies, settled in zip(*[batch.column(c).to_pylist() for c in ("body", "hits", "settled")]):
                chunk = Chunk(body)
                hits = Hits(chunk, bodies or [], hot.value)
                least = np.full(len(hits.first), NO_ID)
                begin, end = np.zeros(len(hits.first), np.int64), np.zeros(len(hits.first), np.int64)
                answers = [_unpacked(s["body"]) for s in sorted(settled or [], key=lambda s: s["part"])]
                of_contexts, of_windows = [a for a in answers if len(a) == 3], [a[0] for a in answers if len(a) == 1]
                if of_contexts:
                    cold = np.flatnonzero(~hits.hot)
                    for whole, i in ((least, 0), (begin, 1), (end, 2)):
                        whole[cold] = np.concatenate([a[i] for a in of_contexts])
                # what a smaller document with the same context covers: all windows within the text
                size = np.array([len(t) for t in chunk.texts], np.int64)[hits.text]
                inside = hits.at - chunk.starts[hits.text]
                left, right = np.minimum(inside, ROOM), np.minimum(size - inside - GRAM, ROOM)
                whole = least[hits.group] < chunk.low[hits.text]
                a = np.where(whole, hits.at - left, hits.at - ROOM + begin[hits.group])
                b = np.where(whole, hits.at + GRAM + right, hits.at - ROOM + end[hits.group])
                some = np.where(whole, left + right >= ROOM, end[hits.group] > 0)
                cuts = np.column_stack([hits.text[some], a[some], b[some]])
                if of_windows:
                    cuts = np.concatenate([cuts, _hot_cuts(hits, np.concatenate(of_windows))])
                cuts = cuts[np.argsort(cuts[:, 0], kind="stable")]
                edges = np.searchsorted(cuts[:, 0], np.arange(len(chunk.texts) + 1))
                out = []
                for i, (text, ids) in enumerate(zip(chunk.texts, chunk.ids)):
                    own = cuts[edges[i]:edges[i + 1]] - chunk.starts[i]
                    first = _cut(text, own[:, 1], own[:, 2])
                    copy = (len(text), 1, hashlib.sha256(b"").hexdigest()) if len(text) >= LENGTH else first
                    for doc_id in ids:
                        smallest = (NO_ID if doc_id is None else doc_id) == chunk.low[i]
                        out.append((doc_id, len(text), *(first if smallest else copy)))
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out), (*[pa.int64()] * 4, pa.string()))],
                                      names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def _bounds(chunks: DataFrame, parts: int) -> np.ndarray:
    """Suffixes that cut the keys into about equal parts, from a bounded sample
    of chunks; they decide the balance only."""
    some = [r[0] for r in chunks.select("chunk").orderBy(F.xxhash64("chunk")).limit(16).collect()]
    rows = chunks.where(F.col("chunk").isin(some)).select("body").mapInArrow(_sampled_keys, "key binary").collect()
    keys = np.sort(np.array([bytes(r[0]) for r in rows], f"S{GRAM}"))
    if not len(keys):
        return keys
    return np.unique(keys[np.linspace(0, len(keys), parts, endpoint=False).astype(int)[1:]])


def _scan_table(df: DataFrame) -> tuple[DataFrame, str]:
    """A scan's rows written by kind to a fresh folder of the shared checkpoint
    folder, and that folder."""
    spark = df.sparkSession
    path = scratch_path(spark, "suffix-scan")
    df.write.partitionBy("kind").parquet(path)
    return spark.read.schema(SCANNED).parquet(path), path


def _bucketed(chunks: DataFrame) -> tuple[DataFrame, str]:
    """The chunks as a table bucketed by chunk in the shared checkpoint folder:
    what is known of a chunk joins it without moving its texts."""
    spark, name = chunks.sparkSession, f"suffix_chunks_{uuid.uuid4().hex}"
    chunks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").option(
        "path", scratch_path(spark, "suffix-chunks")).saveAsTable(name)
    return spark.table(name), name


def _superseded(spark: SparkSession, path: str) -> None:
    """Deletes a level that a written one has replaced; nothing reads it again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kind=level")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def deduplicated(spark: SparkSession, docs: DataFrame, n_batches: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of
    (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks, name = _bucketed(docs.mapInArrow(_pack, "body binary, bytes bigint").withColumn(
        "chunk", F.monotonically_increasing_id()))
    total = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    entries = int(total * DENSITY)
    hot_least = max(HOT, entries >> HOT_SHARE)
    bounds = spark.sparkContext.broadcast(_bounds(chunks, max(16, -(-entries // PART_ENTRIES))))
    n_batches = n_batches or BATCHES
    levels: dict[int, tuple[DataFrame, str]] = {}
    scans = []
    for i in range(n_batches):
        batch = chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(n_batches)) == i).mapInArrow(_suffix_arrays(bounds), ARRAYS)
        new, carried = 0, set()
        while new in levels:
            carried.add(new)
            new += 1
        rows = batch
        for level, _ in levels.values():
            rows = rows.unionByName(level)
        last = i == n_batches - 1
        scanned, path = _scan_table(rows.groupBy("part").applyInPandas(
            _merge_scan(frozenset(carried), -1 if last else new, hot_least), SCANNED))
        for level in list(levels) if last else carried:
            _superseded(spark, levels.pop(level)[1])
        levels[new] = scanned.where("kind = 'level'").drop("kind"), path
        scans.append(scanned)
    told = scans[0]
    for s in scans[1:]:
        told = told.unionByName(s)
    keys = [_words_of(_unpacked(r[0])[0]) for r in told.where("kind = 'hot'").select("body").collect()]   # at most 2**HOT_SHARE
    hot = spark.sparkContext.broadcast(np.unique(_text_keys(np.concatenate(keys))) if keys else np.empty(0, f"S{GRAM}"))
    hits = told.where("kind = 'hit'").groupBy("chunk").agg(F.collect_list("body").alias("hits"))
    found = stored(chunks.join(hits.hint("merge"), "chunk", "left").select("chunk", "body", "hits").mapInArrow(
        _contexts(bounds, hot), CONTEXTS), "suffix-contexts")
    settled = stored(found.groupBy("part").applyInPandas(_settle(len(bounds.value) + 1), CONTEXTS), "suffix-settled")
    answers = settled.groupBy("chunk").agg(F.collect_list(F.struct("part", "body")).alias("settled"))
    both = chunks.join(hits.hint("merge"), "chunk", "left").join(answers.hint("merge"), "chunk", "left")
    result = stored(both.select("body", "hits", "settled").mapInArrow(_apply(hot), RESULT), "suffix-result")
    spark.sql(f"DROP TABLE {name}")
    return result


# Bytes as pairs of hex digits; every window as a row.
SPANS_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {NO_ID}) AS o, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, o, i, substr(h, 2 * i + 1, {2 * LENGTH}) AS s
      FROM (SELECT r, o, h, unnest(range(len(h) // 2 - {LENGTH - 1})) AS i FROM d)),
f AS (SELECT s, min(o) AS o FROM w GROUP BY s),
hit AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w JOIN f USING (s) WHERE f.o < w.o),
marked AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g
           FROM hit),
span AS (SELECT r, g, min(i) AS a, max(i) + {LENGTH} AS b FROM marked GROUP BY r, g),
piece AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS kept_from FROM span),
cut AS (SELECT d.r, sum(b - a)::BIGINT AS removed, count(*) AS spans, max(b) AS rest,
               string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept
        FROM piece JOIN d USING (r) GROUP BY d.r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(rest, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)"""
