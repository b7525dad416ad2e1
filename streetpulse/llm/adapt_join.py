"""Jaccard join of documents on word 5-shingles with adaptive multi-match
prefixes.

All shingles have one global order: estimated document frequency first, then
hash. With n shingles, any partner at similarity s shares at least
T = ceil(s * n) of them, so a prefix of n - T + l shingles of either document
shares at least l. Each document picks its own l by estimated cost: a longer
prefix reads more (and more frequent) posting entries, but a partner must then
share l of them before it is verified. For a pair of known sizes the overlap is
at least o = ceil(s (n + n') / (1 + s)): with the smaller l of the two, at least
l shingles are common among the first n - o + l and n' - o + l, which both
prefixes hold. Fewer make no candidate, and no linked pair is lost.

The frequencies are estimated by a counter sketch of fixed size, summed over
the whole corpus. The order only has to be the same for all documents; the
estimate decides cost, never results.

Links are only needed up to connectivity, so pairs inside a component are not
enumerated. Exact copies (equal shingle sets) are linked by digest. Then, in a
few rounds, each document is verified against hubs of a sample of its posting
lists, and what is linked is contracted; this only saves work. At last every
posting list that still holds several components is enumerated in full: all
pairs of different components that share enough prefix shingles are verified,
but for those whose parity bitmaps differ in more bits than the shingles of a
linked pair can.

Defined cases: a text without words (or null) has no shingles and is its own
component; fewer than five words count as one shingle; rows with one doc_id are
one document; a null doc_id takes part in links and gets the smallest doc_id it
reaches, null if there is none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from streetpulse.llm.components import components, merged_labels
from streetpulse.llm.tables import packed, stored

SHINGLE = 5
PERCENT = 75
SKETCH_BITS = 20
SKETCH_BLOCK = 4096
MAX_EXTRA = 64        # largest l tried; any l is correct
VERIFY_COST = 0.1    # cost of verifying one shingle of a candidate against joining one posting entry
NO_ID = 1 << 62       # nodes of rows without doc_id lie above this
LONG_WORD = 64
WORDS = 4             # 64-bit words of a set's parity bitmap
BITS = [f"bits{i}" for i in range(WORDS)]
HUB_ROUNDS = 4        # rounds of verifying against hubs before all open pairs
HUB_LISTS = 8         # posting lists a document uses in such a round
HUBS_TRIED = 2        # hubs a document is verified against in a round

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    while len(_POWERS[0]) < n:
        k = len(_POWERS[0])
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[i] = np.concatenate([_POWERS[i], _POWERS[i] * np.uint64(pow(b, k, 1 << 64))])
    return _POWERS[0], _POWERS[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, size: int = SHINGLE, block: int = 65536) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text: a
    polynomial over the bytes of the words joined by one space, for all
    windows at once from prefix sums."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    if lens.max() > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\x00" + hashlib.blake2b(w, digest_size=24).hexdigest().encode()
                 for w in words]
        lens = np.fromiter(map(len, words), np.int64, len(words))
    size = min(size, len(words))
    parts = []
    for at in range(0, len(words) - size + 1, block):
        own, n = words[at:at + block + size - 1], lens[at:at + block + size - 1]
        joined = np.frombuffer(b" ".join(own), np.uint8).astype(np.uint64) + np.uint64(1)
        ends = np.cumsum(n) + np.arange(len(n))
        starts = (ends - n)[:len(n) - size + 1]
        ends = ends[size - 1:]
        power, inverse = _powers(len(joined) + 1)
        sums = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(joined * power[:len(joined)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * inverse[starts]
        parts.append(_mixed(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return np.unique(np.concatenate(parts))


def parity_bits(h: np.ndarray) -> list[int]:
    """Bit b is the parity of the shingles with hash b. Two sets differ in at
    least as many shingles as their bitmaps differ in bits."""
    odd = (np.bincount((h % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def _node(doc_id, digest: bytes) -> int:
    return NO_ID + (int.from_bytes(digest[:8], "big") >> 3) if doc_id is None or doc_id != doc_id else int(doc_id)


def _ids(pdf: pd.DataFrame) -> list:
    return [None if x is None or x is pd.NA or x != x else int(x) for x in pdf["doc_id"]]


MEASURED = ("doc_id long, node long, n long, digest binary, " + ", ".join(f"bits{i} long" for i in range(WORDS))
            + ", block int, task long, counts binary")
SUMS = "block int, task long, counts binary"
FAN_IN = 256    # blocks summed in one group


def _measure(batches):
    """Per row: set size and digest; per task: blocks of the counter sketch,
    to which each distinct set of the task adds once."""
    counts, seen = np.zeros(1 << SKETCH_BITS, np.int64), set()
    for pdf in batches:
        out, held = [], []
        for doc_id, text in zip(_ids(pdf), pdf["text"]):
            h = shingle_hashes(text)
            digest = hashlib.md5(h.tobytes()).digest()
            out.append((doc_id, _node(doc_id, digest), len(h), digest, *parity_bits(h)))
            if len(h) and digest not in seen:
                seen.add(digest)
                held.append(h >> np.uint64(64 - SKETCH_BITS))
        if held:
            counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(counts))
        df = pd.DataFrame(out, columns=["doc_id", "node", "n", "digest", *BITS])
        df["doc_id"] = pd.array([r[0] for r in out], dtype="Int64")
        yield df.assign(block=pd.array([None] * len(df), dtype="Int32"),
                        task=pd.array([None] * len(df), dtype="Int64"), counts=None)
    if counts.any():
        k = range(0, len(counts), SKETCH_BLOCK)
        yield pd.DataFrame({
            "doc_id": pd.array([None] * len(k), dtype="Int64"), "node": pd.array([None] * len(k), dtype="Int64"),
            "n": pd.array([None] * len(k), dtype="Int64"), "digest": None,
            **{b: pd.array([None] * len(k), dtype="Int64") for b in BITS},
            "block": pd.array([i // SKETCH_BLOCK for i in k], dtype="Int32"),
            "task": pd.array([TaskContext.get().partitionId()] * len(k), dtype="Int64"),
            "counts": [counts[i:i + SKETCH_BLOCK].astype(np.uint32).tobytes() for i in k]})


def _sum_blocks(pdfs):
    total = np.zeros(SKETCH_BLOCK, np.int64)
    for raw in pdfs["counts"]:
        total += np.frombuffer(raw, np.uint32 if len(raw) == 4 * SKETCH_BLOCK else np.int64)   # a task's, or a sum
    return pd.DataFrame({"block": pdfs["block"][:1], "task": pdfs["task"][:1], "counts": [total.tobytes()]})


def _sketch(measured: DataFrame, fan_in: int = FAN_IN) -> np.ndarray:
    """The counters of the whole corpus (2**SKETCH_BITS numbers, whatever its size).
    The tasks' blocks are summed as a tree: about ``fan_in`` of them meet in a
    group, dealt by the hash of their counters and task."""
    parts = measured.where("block IS NOT NULL").select("block", "task", "counts")
    groups = parts.where("block = 0").count()       # one block of each number a task
    while groups > fan_in:
        groups = -(-groups // fan_in)
        parts = parts.groupBy("block", F.pmod(F.xxhash64("task", F.lit(groups)), F.lit(groups)).alias("task")) \
            .applyInPandas(_sum_blocks, SUMS)
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in parts.groupBy("block").applyInPandas(_sum_blocks, SUMS).collect():
        counts[r["block"] * SKETCH_BLOCK:(r["block"] + 1) * SKETCH_BLOCK] = np.frombuffer(r["counts"], np.int64)
    return counts


def chosen_prefix(h: np.ndarray, counts: np.ndarray, percent: int = PERCENT,
                  max_extra: int = MAX_EXTRA, verify_cost: float = VERIFY_COST) -> tuple[int, np.ndarray]:
    """(l, prefix) of a document: the l of least estimated cost."""
    n = len(h)
    least = n - (-(-percent * n // 100))          # prefix length is least + l
    top = min(max_extra, n - least)
    df = counts[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.argsort(df, kind="stable")[:least + top]
    read = np.cumsum(df[order])[least:]           # entries read for l = 1, 2, ...
    tried = np.arange(1, top + 1)
    cost = read + verify_cost * n * read / tried / max(n, 1)
    best = int(np.argmin(cost))
    return best + 1, h[order[:least + best + 1]]


def _emitter(counts):
    def emit(batches):
        seen = set()
        for pdf in batches:
            nodes, ns, ls, tokens = [], [], [], []
            for doc_id, text in zip(_ids(pdf), pdf["text"]):
                h = shingle_hashes(text)
                digest = hashlib.md5(h.tobytes()).digest()
                if len(h) == 0 or digest in seen:
                    continue
                seen.add(digest)
                best, prefix = chosen_prefix(h, counts.value)
                nodes.append(_node(doc_id, digest))
                ns.append(len(h))
                ls.append(best)
                tokens.append(prefix.astype(np.int64))
            yield pd.DataFrame({"node": nodes, "n": ns, "l": ls, "tokens": tokens})
    return emit


def _packer(batches):
    squeeze = zstandard.ZstdCompressor(level=3)
    for pdf in batches:
        out = []
        for doc_id, text in zip(_ids(pdf), pdf["text"]):
            raw = text if text is not None else ""
            node = doc_id
            if node is None:
                node = _node(None, hashlib.md5(shingle_hashes(raw).tobytes()).digest())
            out.append((node, squeeze.compress(raw.encode("utf-8", "surrogatepass"))))
        yield pd.DataFrame(out, columns=["node", "packed"])


def _verify(batches):
    unpack = zstandard.ZstdDecompressor()
    last, held = None, None

    def shingles(packed):
        return shingle_hashes(unpack.decompress(bytes(packed)).decode("utf-8", "surrogatepass"))
    for pdf in batches:
        out = []
        for a, b, pa, pb in zip(pdf["a"], pdf["b"], pdf["packed_a"], pdf["packed_b"]):
            if pa != last:
                last, held = pa, shingles(pa)
            other = shingles(pb)
            both = len(np.intersect1d(held, other, assume_unique=True))
            if both and 100 * both >= PERCENT * (len(held) + len(other) - both):
                out.append((a, b))
        yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    side = {k: texts.select(F.col("node").alias(k), F.col("packed").alias(f"packed_{k}")).hint("merge") for k in "ab"}
    both = pairs.join(side["b"], "b").join(side["a"], "a")
    return both.select("a", "b", "packed_a", "packed_b").mapInPandas(_verify, "a long, b long")


def _size_class(n: Column) -> Column:
    """Linked documents are in the same or in neighbouring classes."""
    return F.floor(F.log(n.cast("double")) / float(np.log(100 / PERCENT))).cast("int")


def links_and_sizes(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): per input row doc_id, node, n, digest; per linked node
    its component's smallest node."""
    docs = docs.select("doc_id", "text")
    measured = stored(docs.mapInPandas(_measure, MEASURED), "adapt-rows")
    rows = measured.where("block IS NULL").select("doc_id", "node", "n", "digest")
    # A doc_id with several texts has no bitmap of its own.
    bits = measured.where("block IS NULL").groupBy("node").agg(
        (F.min("digest") == F.max("digest")).alias("one"), *[F.max(b).alias(b) for b in BITS]).select(
        "node", *[F.when(F.col("one"), F.col(b)).alias(b) for b in BITS])
    counts = spark.sparkContext.broadcast(_sketch(measured))
    entries = docs.mapInPandas(_emitter(counts), "node long, n int, l int, tokens array<long>").select(
        "node", "n", "l", F.posexplode("tokens").alias("pos", "token"))
    by_token = W.partitionBy("token").orderBy("node")
    shared = entries.select(
        "token", "node", "n", "l", "pos",
        (F.lag("node").over(by_token).isNotNull() | F.lead("node").over(by_token).isNotNull()).alias("met")) \
        .where("met").drop("met")
    shared = stored(shared, "adapt-entries")
    # The join kinds are fixed: both sides grow with the corpus, at every size.
    held = shared.select("node").distinct().hint("shuffle_hash")
    texts = stored(docs.mapInPandas(_packer, "node long, packed binary").join(held, "node", "left_semi")
                   .dropDuplicates(["node", "packed"]), "adapt-texts")
    copies = rows.where("n > 0").groupBy("digest").agg(F.min("node").alias("a"))
    copies = rows.where("n > 0").join(copies, "digest").where("node > a").select("a", F.col("node").alias("b"))
    links = stored(copies.distinct(), "adapt-copies")
    labels = stored(components(links), "adapt-labels")
    for turn in range(HUB_ROUNDS):
        pairs = stored(_hub_pairs(shared, labels, turn), "adapt-hub-pairs")
        found = stored(_verified(pairs, texts), "adapt-hub-links")
        if found.isEmpty():
            break
        labels = merged_labels(labels, found)
    second = stored(_verified(_open_pairs(shared, labels, bits), texts), "adapt-open-links")
    return rows, merged_labels(labels, second)


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels.hint("merge"), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _hub_pairs(shared: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b): each document b with the hubs of other components it shares most
    sampled posting lists with. A list's hub is its first document in an order
    that differs from turn to turn; the lists are sampled by the hash of their
    shingle, about ``HUB_LISTS`` for each document."""
    every = F.greatest(F.lit(1.0), F.pow(F.lit(100 / PERCENT), F.col("class")) * ((100 - PERCENT) / 100 / HUB_LISTS))
    some = shared.drop("pos").withColumn("class", _size_class(F.col("n")))
    some = _labelled(some.where(F.pmod(F.xxhash64("token"), F.floor(every)) == 0), labels)
    order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
    hubs = some.groupBy("token", "class").agg(F.min(F.struct(order.alias("o"), "node", "label", "n")).alias("hub"))
    met = some.join(hubs.hint("merge"), ["token", "class"]).where(
        (F.col("label") != F.col("hub.label")) & _size_fits(F.col("n"), F.col("hub.n")))
    counted = met.groupBy("node", F.col("hub.node").alias("a")).agg(F.count(F.lit(1)).alias("k"))
    best = W.partitionBy("node").orderBy(F.desc("k"), "a")
    return counted.withColumn("at", F.row_number().over(best)).where(F.col("at") <= HUBS_TRIED).select(
        "a", F.col("node").alias("b"))


def _open_pairs(shared: DataFrame, labels: DataFrame, bits: DataFrame) -> DataFrame:
    """(a, b): all pairs of different components whose prefixes share enough
    shingles. Only lists that hold several components are enumerated, only
    shingles in the first n - overlap + l places of both documents count, and
    pairs whose bitmaps differ in more bits than a linked pair can are left out."""
    base = _labelled(shared, labels).join(bits.hint("merge"), "node").select(
        "token", "node", "n", "l", "pos", "label", *BITS).repartition("token")
    mixed = base.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(
        "low < high").select("token")
    some = base.join(mixed.hint("merge"), "token", "left_semi")
    x, y = (some.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "l", "pos", "label", *BITS)])
            for side in "ab")
    overlap = F.expr(f"({PERCENT} * (n_a + n_b) + {99 + PERCENT}) DIV {100 + PERCENT}")
    least = F.least("l_a", "l_b")
    early = (F.col("pos_a") < F.col("n_a") - overlap + least) & (F.col("pos_b") < F.col("n_b") - overlap + least)
    differ = sum((F.bit_count(F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b"))) for b in BITS), F.lit(0))
    near = F.coalesce(differ <= F.col("n_a") + F.col("n_b") - 2 * overlap, F.lit(True))
    return x.join(y.hint("merge"), "token").where(
        (F.col("label_a") < F.col("label_b")) & _size_fits(F.col("n_a"), F.col("n_b")) & early & near).groupBy(
        "node_a", "node_b").agg(F.count(F.lit(1)).alias("k"), F.min(least).alias("l")).where("k >= l").select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _size_fits(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text)."""
    rows, labels = links_and_sizes(spark, docs)
    smallest = F.coalesce("label", "node")
    return rows.join(labels, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(smallest < NO_ID, smallest).alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) whose document is the smallest of its
    component; of its rows with equal texts and shingles the least one (as JSON)
    stays. Rows without shingles all stay."""
    rows, labels = links_and_sizes(spark, docs)
    linked = rows.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("times")).join(labels, "node", "left")
    touched = stored(linked.select("node", (F.col("label") < F.col("node")).alias("gone"), "times").where(
        "gone OR times > 1"), "adapt-gone")
    repeated = touched.where("times > 1 AND (gone IS NULL OR NOT gone)").select("node")
    keyed = _keyed(docs)
    single = keyed.join(touched.select("node"), "node", "left_anti")
    once = keyed.join(repeated, "node", "left_semi").groupBy("node", F.md5(F.col("row")["text"])).agg(
        F.min_by("row", F.to_json("row")).alias("row")).select("node", "row")
    return single.unionByName(once).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _keyed(docs: DataFrame) -> DataFrame:
    """(node, row) with all columns of a row in one struct."""
    row = packed(docs).alias("row")
    named = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("node"), row)
    nameless = F.pandas_udf(_nameless, "long")
    return named.unionByName(docs.where(F.col("doc_id").isNull()).select(nameless("text").alias("node"), row))


def _nameless(texts: pd.Series) -> pd.Series:
    return pd.Series([_node(None, hashlib.md5(shingle_hashes(t).tobytes()).digest()) for t in texts], dtype="int64")
