"""Cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, digits to 0, white space runs to one space,
trimmed) and hashed. For each host (``source``) the distinct texts that hold a
line are counted; exact copies of a text count once, so a group of copies does
not turn its own lines into boilerplate. A line in more than ``max_docs``
distinct texts of a host is removed from all of them but the first holder (the
text with the smallest doc_id, then the smallest text hash). A text that loses
more than ``max_removed_percent`` of its words this way is depleted and
rejected.

Skew: the counts are partial aggregates keyed by (host, text, line), then
(host, line); a hot host or line only meets after them. No text is shuffled:
verdicts are per (host, text hash) and joined to the documents on that pair.

Defined cases: a null text has no words and fails the base rules; a null source
is a host of its own; lines without a word are never counted nor removed;
repeated rows share one verdict; null doc_ids come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetpulse.llm.tables import SPACE_RUN, packed, stored, words

HAS_WORD = "[^\\x20\\x09-\\x0D]"
NOT_SYMBOLS = "[^#*$%&|<>]+"
MAX_DOCS = 10
MAX_REMOVED_PERCENT = 70


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACE_RUN, " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def text_hash(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text, F.octet_length(text))


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, host, text_hash and the base measures of every row of
    (doc_id, text, source).

    Words in repeated 3-word windows: the window hashes of a text are sorted
    with their positions, windows whose neighbour has the same hash are
    repeated, and the words they cover are counted from the gaps between their
    sorted positions.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", F.col("source").alias("host"), text.alias("t"))
    df = df.select("doc_id", "host", text_hash(F.col("t")).alias("text_hash"), "t", words(F.col("t")).alias("w"))
    windows = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.struct(
        F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))
    with_words = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(HAS_WORD))
    df = df.select(
        "doc_id", "host", "text_hash", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("t", NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        with_words.alias("lines"),
        F.when(F.size("w") >= 3, F.sort_array(windows)).alias("windows"))
    at = F.filter(F.sequence(F.lit(0), F.size("windows") - 1), lambda k: (
        F.get("windows", k)["h"].eqNullSafe(F.get("windows", k + 1)["h"])
        | F.get("windows", k)["h"].eqNullSafe(F.get("windows", k - 1)["h"])))
    df = df.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("windows") > 1, F.sort_array(F.transform(at, lambda k: F.get("windows", k)["i"])))
        .otherwise(F.array().cast("array<int>")).alias("at"))
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("at") - 1), F.lit(0),
        lambda total, k: total + F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - F.get("at", k), F.lit(3))))
    return df.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("at") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"))


def text_lines(docs: DataFrame) -> DataFrame:
    """One row per distinct (host, text, line): words (over all its rows) and
    the first doc_id."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.col("source").alias("host"), text_hash(F.col("text")).alias("text_hash"),
        F.explode(F.split("text", "\n", -1)).alias("line")).where(F.col("line").rlike(HAS_WORD))
    return lines.select("doc_id", "host", "text_hash", line_hash(F.col("line")).alias("line_hash"),
                        F.size(words(F.col("line"))).cast("long").alias("n")) \
        .groupBy("host", "text_hash", "line_hash").agg(F.sum("n").alias("words"), F.min("doc_id").alias("doc_id"))


def marked_lines(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The distinct text lines with ``removed``."""
    lines = stored(text_lines(docs), "text-lines")
    frequent = lines.groupBy("host", "line_hash").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc_id", "text_hash"))["text_hash"].alias("first_text")) \
        .where(F.col("n_docs") > max_docs)
    # A merge join at every size: the frequent lines grow with the corpus.
    a, b = lines.alias("a"), frequent.hint("merge").alias("b")
    on = F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line_hash") == F.col("b.line_hash"))
    marked = a.join(b, on, "left").select(
        "a.host", "a.text_hash", "a.line_hash", "a.words",
        (F.col("b.first_text").isNotNull() & (F.col("b.first_text") != F.col("a.text_hash"))).alias("removed"))
    return marked


def verdicts(marked: DataFrame, max_removed_percent: int = MAX_REMOVED_PERCENT, with_hashes: bool = False) -> DataFrame:
    """Per (host, text): the share of words removed and ``depleted``. The word
    sums run over all copies alike, so their share is that of one text."""
    gone = F.sum(F.when(F.col("removed"), F.col("words")).otherwise(0))
    extra = [F.collect_list(F.when(F.col("removed"), F.col("line_hash"))).alias("gone")] if with_hashes else []
    return marked.groupBy("host", "text_hash").agg(
        F.count_if("removed").alias("n_removed_lines"),
        (gone * 100 > F.sum("words") * max_removed_percent).alias("depleted"), *extra)


def line_frequency(docs: DataFrame, max_docs: int = MAX_DOCS,
                   max_removed_percent: int = MAX_REMOVED_PERCENT) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, text, source)."""
    base = base_measures(docs).alias("d")
    marked = marked_lines(docs, max_docs)
    v = verdicts(marked, max_removed_percent).alias("v")
    on = F.col("d.host").eqNullSafe(F.col("v.host")) & (F.col("d.text_hash") == F.col("v.text_hash"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.coalesce(F.col("v.depleted"), F.lit(False))
    return base.join(v, on, "left").select(
        "d.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"),
        F.coalesce("v.n_removed_lines", F.lit(0).cast("long")).alias("n_removed_lines"))


def cleaned_documents(docs: DataFrame, max_docs: int = MAX_DOCS,
                      max_removed_percent: int = MAX_REMOVED_PERCENT) -> DataFrame:
    """The kept rows of ``docs`` with all their columns; frequent lines are cut
    from ``text`` (rows without such lines keep it as it is) and ``n_chars``
    follows the text."""
    names = docs.columns
    keyed = docs.select(packed(docs).alias("row"), "doc_id", "text", "source")
    rows = keyed.select("row", F.col("source").alias("host"), text_hash(F.col("text")).alias("text_hash"))
    base = base_measures(docs).select(
        "host", "text_hash", ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .alias("base_failed")).groupBy("host", "text_hash").agg(F.max("base_failed").alias("base_failed"))
    marked = marked_lines(docs, max_docs)
    v = verdicts(marked, max_removed_percent, with_hashes=True).alias("v")
    b = base.alias("b")
    same = F.col("b.host").eqNullSafe(F.col("v.host")) & (F.col("b.text_hash") == F.col("v.text_hash"))
    keep = b.join(v, same, "left").where(~F.col("base_failed") & ~F.coalesce("depleted", F.lit(False))).select(
        "b.host", "b.text_hash", "v.gone").alias("k")
    r = rows.alias("r")
    on = F.col("r.host").eqNullSafe(F.col("k.host")) & (F.col("r.text_hash") == F.col("k.text_hash"))
    text = F.when(F.size("k.gone") > 0, F.array_join(F.filter(
        F.split(F.col("row.text"), "\n", -1),
        lambda x: ~(x.rlike(HAS_WORD) & F.array_contains(F.col("k.gone"), line_hash(x)))), "\n")) \
        .otherwise(F.col("row.text"))
    out = r.join(keep, on).withColumn("cut", text)
    cols = [F.col("cut").alias(c) if c == "text" else
            F.char_length("cut").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
            F.col("row").getField(c).alias(c) for c in names]
    return out.select(*cols)


# The same rows in SQL: words and lines by regular expressions and unnest.
LINE_FREQUENCY_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rw AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
ln AS (
  SELECT rid, doc_id, host, t, line,
         trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS nl,
         len(list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT rid, doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY rid),
tl AS (SELECT host, t, nl, sum(n) AS words, min(doc_id) AS doc_id FROM ln GROUP BY host, t, nl),
fr AS (
  SELECT host, nl, arg_min(t, struct_pack(a := doc_id, b := md5(t))) AS first_text
  FROM tl GROUP BY host, nl HAVING count(*) > {MAX_DOCS}),
v AS (
  SELECT tl.host, tl.t, count_if(fr.first_text <> tl.t) AS n_removed,
         100 * coalesce(sum(tl.words) FILTER (WHERE fr.first_text <> tl.t), 0)
           > {MAX_REMOVED_PERCENT} * sum(tl.words) AS depleted
  FROM tl LEFT JOIN fr ON tl.host IS NOT DISTINCT FROM fr.host AND tl.nl = fr.nl GROUP BY tl.host, tl.t),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rw.n, 0)::BIGINT AS n_repeat_words,
         coalesce(v.depleted, false) AS depleted, coalesce(v.n_removed, 0)::BIGINT AS n_removed_lines
  FROM d LEFT JOIN rw USING (rid) LEFT JOIN dup USING (rid)
  LEFT JOIN v ON d.host IS NOT DISTINCT FROM v.host AND d.t = v.t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT depleted AS kept, n_removed_lines
FROM m
"""
