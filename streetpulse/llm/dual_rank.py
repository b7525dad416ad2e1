"""Ranked lexical search by a dual tree: every document ranked for every item.

A document is the vector of its terms' impacts (1000000000*tf) div
(1000*tf + 8*m), an item that of its terms' weights times their repeats; the
score is their inner product, all in whole numbers. Documents are read once:
each becomes a short list of (term, tf) over the items' vocabulary, from which
the corpus counts come as aggregates. Tasks then take the vectors in batches.
A batch gets a hierarchy whose nodes hold the coordinate maxima of their
documents' impacts, the items one with the maxima of their weights. The product
of two nodes' maxima bounds every score between them, so a pair of nodes below
the weakest k-th score of its items is dropped with all it holds. Bounds and
scores are exact, equal scores are never dropped, and so the k best are exact.

The k-th scores start from those of a hash sample of the documents (any k
documents bound the true k-th score from below; the sample changes the time,
never the result) and rise as a task goes on. Each task gives at most k
documents an item. The vocabulary is bounded: the items are taken in blocks of
at most ``BLOCK_BYTES`` of text, each a pass of its own.

Defined cases: a null or termless text has no terms and no score; each row of
either table is a document or an item of its own, so repeated rows are ranked
one by one and a repeated item gets its rows again; equal scores are in order
of doc_id, a null doc_id last; an item without a scoring document has no rows;
an empty table gives none; very long texts are taken whole; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streetpulse.llm.tables import stored

BEST = 10
BLOCK_BYTES = 2 << 20        # text of the items of one pass
CELLS = 1 << 23              # impacts of one batch of documents, as a dense array
LEAF, FAN = 16, 4            # documents of a leaf, children of an inner node
SAMPLE = 64                  # one document of so many sets the first bounds
EXACT = 2.0 ** 53            # doubles hold all whole numbers below

_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters and digits and all
    characters beyond ASCII, A-Z in lower case."""
    return (text or b"").translate(_TERM_BYTES).split()


def _utf8(text: str | None) -> bytes | None:
    return None if text is None else text.encode("utf-8", "surrogatepass")


def _vectors(vocabulary):
    def run(batches):
        at = vocabulary.value
        for batch in batches:
            ns, sizes, ids, tfs = [], [0], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                own = terms(text)
                ns.append(len(own))
                counts = Counter(map(at.get, own))
                counts.pop(None, None)
                ids.extend(counts.keys())
                tfs.extend(counts.values())
                sizes.append(len(ids))
            offsets = pa.array(sizes, pa.int32())
            yield pa.record_batch([batch.column("doc_id"), pa.array(ns, pa.int64()),
                                   pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                                   pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                                  names=["doc_id", "n", "ids", "tfs"])
    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Node:
    """Items ``low`` to ``high`` with the maxima of their weights by term."""

    __slots__ = ("low", "high", "terms", "values", "children", "exact")

    def __init__(self, low, high, terms, values, children=()):
        self.low, self.high, self.terms, self.values, self.children = low, high, terms, values, children
        self.exact = float(values.sum()) * 1e6 < EXACT


def item_tree(items: list[tuple[np.ndarray, np.ndarray]]) -> Node:
    """Hierarchy over items (terms, values), in the order given."""
    level = [Node(i, i + 1, t, v) for i, (t, v) in enumerate(items)]
    while len(level) > 1:
        above = []
        for i in range(0, len(level), FAN):
            own = level[i:i + FAN]
            found, place = np.unique(np.concatenate([c.terms for c in own]), return_inverse=True)
            values = np.zeros(len(found))
            np.maximum.at(values, place, np.concatenate([c.values for c in own]))
            above.append(Node(own[0].low, own[-1].high, found, values, own))
        level = above
    return level[0]


class Best:
    """The best documents of every item, and the score a document must reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.rows = [[] for _ in least]
        self.least, self.k = least.copy(), k

    def offer(self, item: int, scores: np.ndarray, docs: list) -> None:
        kept = self.rows[item]
        for i in np.flatnonzero(scores >= self.least[item]):
            kept.append((-int(scores[i]), docs[i] is None, docs[i]))
        kept.sort(key=lambda r: r if r[2] is not None else (r[0], True, 0))
        del kept[self.k:]
        if len(kept) == self.k:
            self.least[item] = max(self.least[item], -kept[-1][0])


def _in_leaf_order(rows: np.ndarray, ids: np.ndarray, gains: np.ndarray, n: int) -> np.ndarray:
    """Documents by their strongest and second strongest term, so that a
    leaf's documents share the terms that count."""
    order = np.lexsort((gains, rows))
    rows, ids = rows[order], ids[order]
    first, second = np.full(n, -1), np.full(n, -1)
    last = np.flatnonzero(np.append(rows[1:] != rows[:-1], True)) if len(rows) else np.empty(0, int)
    first[rows[last]] = ids[last]
    two = last[(last > 0) & (rows[last - 1] == rows[last])]
    second[rows[two]] = ids[two - 1]
    return np.lexsort((second, first))


def _maxima(x: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of the leaves and of the levels above, up to a few nodes."""
    levels, size = [], LEAF
    while True:
        x = np.maximum.reduceat(x, np.arange(0, len(x), size), axis=0)
        levels.append(x)
        if len(x) <= FAN:
            return levels
        size = FAN


def search(root: Node, x: np.ndarray, docs: list, best: Best) -> None:
    """All documents (impacts by row) against all items."""
    levels = _maxima(x)

    def bounds(node, at, nodes):
        b = levels[at][np.ix_(nodes, node.terms)].astype(np.float64) @ node.values
        return b if node.exact else b * (1 + 1e-6) + 1

    def reached(node, b):
        return b >= best.least[node.low:node.high].min()

    def score(node, leaves):
        rows = np.concatenate([np.arange(i * LEAF, min((i + 1) * LEAF, len(x))) for i in leaves])
        own = x[np.ix_(rows, node.terms)]
        if node.exact:
            scores = (own.astype(np.float64) @ node.values).astype(np.int64)
        else:
            scores = own.astype(np.int64) @ node.values.astype(np.int64)
        best.offer(node.low, scores, [docs[r] for r in rows])

    def visit(node, at, nodes):
        b = bounds(node, at, nodes)
        near = reached(node, b)
        nodes, b = nodes[near], b[near]
        if not len(nodes):
            return
        if at:
            below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            below = below[below < len(levels[at - 1])]
            for child in node.children or (node,):
                visit(child, at - 1, below)
        elif node.children:
            for child in node.children:
                visit(child, 0, nodes)
        else:
            order = np.argsort(-b, kind="stable")
            for i in range(0, len(order), FAN):
                some = order[i:i + FAN]
                some = some[reached(node, b[some])]
                if not len(some):
                    break
                score(node, nodes[some])
    visit(root, len(levels) - 1, np.arange(len(levels[-1])))


def _searcher(shared, doc_type, item_type):
    def run(batches):
        own = shared.value
        root, size = item_tree(own["items"]), own["size"]
        best = Best(own["least"], own["k"])
        step = max(LEAF, CELLS // max(size, 1))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids_list, tfs = part.column("ids"), part.column("tfs").flatten().to_numpy()
                ids = ids_list.flatten().to_numpy()
                if not len(ids):
                    continue
                sizes = np.diff(ids_list.offsets.to_numpy())
                rows = np.repeat(np.arange(len(sizes)), sizes)
                m = 25 + 75 * part.column("n").to_numpy() * own["n_docs"] // own["n_terms"]
                impacts = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[rows])
                order = _in_leaf_order(rows, ids, impacts * own["weights"][ids], len(sizes))
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                x = np.zeros((len(order), size), np.float32)   # impacts are below a million, exact in 32 bits
                x[place[rows], ids] = impacts
                docs = part.column("doc_id").to_pylist()
                search(root, x, [docs[i] for i in order], best)
        out = [(i, own["item_ids"][i], r[2], -r[0]) for i, kept in enumerate(best.rows) for r in kept]
        if out:
            at, item, doc, score = zip(*out)
            yield pa.record_batch([pa.array(at, pa.int32()), pa.array(item, item_type), pa.array(doc, doc_type),
                                   pa.array(score, pa.int64())], names=["at", "item_id", "doc_id", "score"])
    return run


def _blocks(items: DataFrame):
    """Rows (item_id, text) in blocks of bounded text; a longer item is alone."""
    block, size = [], 0
    for row in items.toLocalIterator():
        length = len(row["text"] or "")
        if block and size + length > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += length
    if block:
        yield block


def _ranked_block(spark: SparkSession, docs: DataFrame, items: DataFrame, block: list, k: int) -> DataFrame | None:
    counted = [(item_id, Counter(terms(_utf8(text)))) for item_id, text in block]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
    if not vocabulary:
        return None
    kinds = [items.schema["item_id"].dataType, docs.schema["doc_id"].dataType]
    named = [k.simpleString() for k in kinds]
    vectors = stored(docs.mapInArrow(_vectors(spark.sparkContext.broadcast(vocabulary)),
                                     f"doc_id {named[1]}, n bigint, ids array<int>, tfs array<bigint>"), "dual-vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_terms:
        return None
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect():   # at most the vocabulary
        weights[term] = weight(n_docs, df)
    sides = []
    for item_id, counts in counted:
        own = np.array(sorted(vocabulary[t] for t in counts), np.int64)
        repeats = {vocabulary[t]: c for t, c in counts.items()}
        sides.append((item_id, own, np.array([float(repeats[t] * weights[t]) for t in own])))
    sides.sort(key=lambda s: (int(s[1][np.argmax(s[2])]) if len(s[1]) else -1))   # like items in one node
    shared = {"items": [s[1:] for s in sides], "item_ids": [s[0] for s in sides], "size": len(vocabulary), "weights": weights,
              "n_docs": n_docs, "n_terms": n_terms, "least": np.ones(len(sides), np.int64), "k": k}

    def found(vectors, shared):
        shared = spark.sparkContext.broadcast(shared)
        rows = vectors.mapInArrow(_searcher(shared, to_arrow_type(kinds[1]), to_arrow_type(kinds[0])),
                                  f"at int, item_id {named[0]}, doc_id {named[1]}, score bigint")
        order = W.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    sample = vectors.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    for at, score in found(sample, shared).where(F.col("rank") == k).select("at", "score").collect():   # at most one an item
        shared["least"][at] = score
    return found(vectors, shared).select("item_id", "rank", "doc_id", "score")


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    out = None
    for block in _blocks(items):
        part = _ranked_block(spark, docs, items, block, k)
        if part is not None:
            part = stored(part, "dual-ranks")
            out = part if out is None else out.unionByName(part)
    if out is None:
        kinds = (items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString())
        out = spark.createDataFrame([], "item_id {}, rank int, doc_id {}, score bigint".format(*kinds))
    return out


_TERMS_SQL = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

RANK_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL.format("text")} AS ts FROM documents),
i AS (SELECT row_number() OVER () AS it, item_id, {_TERMS_SQL.format("text")} AS ts FROM benchmark),
size AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY t, n_docs),
q AS (SELECT it, t, count(*) AS q FROM (SELECT it, unnest(ts) AS t FROM i) GROUP BY it, t),
m AS (SELECT r, 25 + (75 * len(ts) * n_docs) // n_terms AS m FROM d, size),
scored AS (
  SELECT it, r, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY it, r),
placed AS (
  SELECT i.it, item_id, doc_id, score, row_number() OVER (PARTITION BY i.it ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored JOIN d USING (r) JOIN i ON i.it = scored.it WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= {BEST}"""
