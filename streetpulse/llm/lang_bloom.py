"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, bit-sliced: slot s holds a bit mask of the
languages whose filter has slot s. Looking an n-gram up is the AND of its
slots' masks and returns all languages that contain it. Per document the bits
are counted per language, corrected for the filter's false-positive rate, and
the language with the largest share of n-grams decides.

A language's filter has the letter n-grams that are at least ``LEAST`` of its
n-grams and at least ``SHARE`` as frequent as in the language where they are
most frequent; so a filter has at most 1 / LEAST n-grams per size. Filters are
fitted on up to ``SAMPLE`` documents of each language (those with the smallest
hash); every document is predicted from its whole text alone.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language first in the alphabet; a null doc_id or lang is never
learned from and not held out; without any language to learn all are ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SIZES = (2, 3, 4)
SAMPLE = 4000
LEAST = 2e-5
SHARE = 0.25
HASHES = 3
SLOTS_PER_GRAM = 16
CHUNK = 1 << 20

_LETTER: list = []


def _letter_table() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters
    than letters as one space, and a space at either end; empty without a letter."""
    if not text:
        return np.empty(0, np.uint32)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]).astype(np.uint32)
    is_letter = _letter_table()[points]
    if not is_letter.any():
        return np.empty(0, np.uint32)
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]
    return np.where(is_letter, points, np.uint32(32))[keep]


def gram_hashes(points: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of the n-grams, one array per size."""
    out = []
    for n in SIZES:
        if len(points) < n:
            out.append(np.empty(0, np.uint64))
            continue
        x = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            x = (x ^ points[k:len(points) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        out.append(x)
    return out


@dataclass
class Filters:
    languages: list       # in alphabetical order; bit l of a mask is languages[l]
    masks: np.ndarray     # slots x words
    false_rate: np.ndarray

    @property
    def bits(self) -> int:
        return int(len(self.masks) - 1).bit_length()

    def lookup(self, x: np.ndarray) -> np.ndarray:
        """Masks of the languages that contain each hash."""
        both = None
        for k in range(HASHES):
            y = x * np.uint64(2 * k + 0x632BE59BD9B4E019)
            got = self.masks[y >> np.uint64(64 - self.bits)]
            both = got if both is None else both & got
        return both

    def counts(self, x: np.ndarray) -> np.ndarray:
        """Number of hashes that each language's filter contains."""
        out = np.zeros(len(self.languages), np.int64)
        for at in range(0, len(x), CHUNK):
            masks = self.lookup(x[at:at + CHUNK])
            if masks.dtype.itemsize <= 2:
                seen = np.bincount(masks[:, 0])
                value = np.arange(len(seen))
                out += [int(seen[(value >> i) & 1 == 1].sum()) for i in range(len(out))]
            else:
                for i in range(len(out)):
                    out[i] += np.count_nonzero(masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1))
        return out


def build_filters(grams: dict[str, np.ndarray]) -> Filters:
    """Filters from the hashes of each language."""
    languages = sorted(grams)
    most = max([len(g) for g in grams.values()] or [0])
    bits = max(10, int(most * SLOTS_PER_GRAM).bit_length())
    kind = np.uint8 if len(languages) <= 8 else np.uint16 if len(languages) <= 16 else np.uint64
    out = Filters(languages, np.zeros((1 << bits, -(-max(1, len(languages)) // 64)), kind), np.zeros(len(languages)))
    for i, lang in enumerate(languages):
        used = np.zeros(1 << bits, bool)
        for k in range(HASHES):
            used[(grams[lang] * np.uint64(2 * k + 0x632BE59BD9B4E019)) >> np.uint64(64 - bits)] = True
        out.masks[used, i // 64] |= kind(1 << (i % 64))
        out.false_rate[i] = used.mean() ** HASHES
    return out


def predict(text: str | None, filters: Filters) -> tuple[str, float]:
    points = letters(text)
    if not len(points) or not filters.languages:
        return "und", 0.0
    x = np.concatenate(gram_hashes(points))
    share = filters.counts(x) / len(x)
    corrected = np.clip((share - filters.false_rate) / (1 - filters.false_rate), 0, 1)
    best = int(np.argmax(corrected))
    return filters.languages[best], float(corrected[best])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _gram_counts(batches):
    """Occurrences of each (language, size, hash) in the task's documents."""
    held: dict[tuple, list] = {}

    def flush():
        for (lang, n), parts in held.items():
            x, c = np.unique(np.concatenate(parts), return_counts=True)
            yield pd.DataFrame({"lang": lang, "size": n, "gram": x.astype(np.int64), "n": c})
        held.clear()
    total = 0
    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            for n, x in zip(SIZES, gram_hashes(letters(text))):
                held.setdefault((lang, n), []).append(x)
                total += len(x)
            if total > 4 * CHUNK:
                yield from flush()
                total = 0
    yield from flush()


def _least_hashes(ids: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` (doc_id, lang) of least hash of each language. Of n ids only
    those are ranked whose hash is below the share (sample + 8 sqrt(sample) + 64) / n
    of all hashes: a little over ``sample`` a language, however many it has (fewer
    than ``sample`` are below it once in 10^14 languages)."""
    h = F.xxhash64("doc_id")
    many = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("many"))
    share = F.lit(sample + 8 * sample ** 0.5 + 64.0) / F.col("many")
    near = ids.join(many, "lang").where((h.cast("double") + 2.0 ** 63) / 2.0 ** 64 < share)
    order = W.partitionBy("lang").orderBy(h, "doc_id")
    return near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= sample).select("doc_id", "lang")


def fit_filters(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    """Fit on (doc_id, text, lang). Collected: at most 1 / LEAST n-grams per
    language and size."""
    able = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = _least_hashes(able.select("doc_id", "lang").distinct(), sample)
    # At most ``sample`` ids per language are broadcast; equal rows count once.
    counts = able.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).distinct().select(
        "lang", "text").mapInPandas(_gram_counts, "lang string, size int, gram long, n long")
    per = counts.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("size", "lang").agg(F.sum("n").alias("all"))
    rated = per.join(F.broadcast(totals), ["size", "lang"]).select(
        "size", "gram", "lang", (F.col("n") / F.col("all")).alias("rate")).where(F.col("rate") >= LEAST)
    strongest = F.max("rate").over(W.partitionBy("size", "gram"))
    rows = rated.withColumn("top", strongest).where(F.col("rate") >= SHARE * F.col("top")).select("lang", "gram").toPandas()
    return build_filters({lang: g["gram"].to_numpy(np.int64).astype(np.uint64) for lang, g in rows.groupby("lang")})


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    filters = spark.sparkContext.broadcast(fit_filters(docs.select("doc_id", "text", "lang")))

    def run(batches):
        for pdf in batches:
            got = [predict(t, filters.value) for t in pdf["text"]]
            yield pdf[["doc_id", "held_out"]].assign(doc_id=pdf["doc_id"].astype("Int64"),
                                                     lang_pred=[g[0] for g in got], score=[g[1] for g in got])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")
