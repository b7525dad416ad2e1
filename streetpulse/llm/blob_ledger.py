"""Secret scans over a blob ledger, in DataFrame functions only.

A version is a path with a text. Its blob is the SHA-256 of the text. The
ledger keeps which (blob, rule, rule version) pairs were scanned and what was
found; an increment scans only pairs that the ledger lacks: each unseen blob
once, however many paths hold it, and known blobs only for new or changed
rules. Findings are joined back to all paths by blob.

Match positions come from the pieces between matches: a regular expression
splits the text, and running sums of the lengths of pieces and matches (a
window per blob and rule) give start and end in code points.

Skew: blobs are found by aggregating digests (copies meet after the partial
aggregate); the representative row of a blob is fetched by a join on
(path, blob), so copies of one blob do not meet in one task.

Recovery: findings are appended before the pairs that vouch for them; a scan
lost between the two is done again, and readers take distinct findings.

Defined cases: a null text is the empty text and has no findings; repeated rows
of a path are scanned once and all get the findings; a null path has a digest
like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from streetpulse.llm.tables import packed
from streetpulse.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters, else the match is
    dropped (without a retry inside it)."""
    name: str
    version: int
    pattern: str
    group: int
    least: int


# The base patterns of the scan, in the order of the kinds.
RULES = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18),
    # Runs below 16 characters fail anyway; asking for 16 at once finds the same runs.
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
)

PAIRS = "blob binary, rule string, version int"
FINDINGS = "blob binary, rule string, version int, start int, end int"


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class Ledger:
    """Two Parquet tables under ``path``: pairs scanned and findings."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def pairs(self) -> DataFrame:
        return self.read("pairs", PAIRS).distinct()

    def findings(self) -> DataFrame:
        return self.read("findings", FINDINGS).distinct()

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")


def matches(blobs: DataFrame, rule: Rule) -> DataFrame:
    """(blob, rule, version, start, end) of the rule's spans in (blob, text)."""
    hit = blobs.where(F.col("text").rlike(rule.pattern)).select(
        "blob", F.arrays_zip(
            F.split("text", rule.pattern, -1).alias("piece"),
            F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)).alias("whole"),
            F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)).alias("part")).alias("m"))
    each = hit.select("blob", F.posexplode("m").alias("at", "m")).where("m.whole IS NOT NULL").select(
        "blob", "at", F.char_length("m.piece").alias("before"), F.char_length("m.whole").alias("long"),
        F.char_length("m.part").alias("part"))
    so_far = W.partitionBy("blob").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.col("long")).over(so_far).cast("int")
    spans = each.select("blob", "part", end.alias("end"), "long").where(F.col("part") >= rule.least)
    return spans.select("blob", F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"),
                        (F.col("end") - F.col("long")).alias("start"), "end")


def scan_increment(spark: SparkSession, versions: DataFrame, ledger: Ledger, rules: tuple = RULES) -> None:
    """Scan the unseen (blob, rule version) pairs of ``versions``
    (path, blob, text) and add them to the ledger."""
    first = versions.groupBy("blob").agg(F.min(F.struct("path"))["path"].alias("path"))
    seen = ledger.pairs()
    findings, pairs = [], []
    for rule in rules:
        known = seen.where((F.col("rule") == rule.name) & (F.col("version") == rule.version)).select("blob")
        unseen = first.join(known, "blob", "left_anti")
        pairs.append(unseen.select("blob", F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version")))
    wanted = pairs[0]
    for more in pairs[1:]:
        wanted = wanted.unionByName(more)
    # One row per unseen blob with the rules it lacks, and its text fetched once.
    lacking = wanted.groupBy("blob").agg(F.collect_set("rule").alias("lacks")).join(first, "blob")
    v, n = versions.alias("v"), lacking.hint("shuffle_hash").alias("n")
    texts = v.join(n, (F.col("v.blob") == F.col("n.blob")) & F.col("v.path").eqNullSafe(F.col("n.path"))).select(
        "v.blob", "v.text", "n.lacks")
    every = [r.pattern for r in rules]
    texts = texts.where(F.col("text").rlike("|".join(f"(?:{p})" for p in every)))
    texts = texts.dropDuplicates(["blob"]).persist()  # repeated rows of the representative path
    for rule in rules:
        findings.append(matches(texts.where(F.array_contains("lacks", rule.name)), rule))
    found = findings[0]
    for more in findings[1:]:
        found = found.unionByName(more)
    ledger.append("findings", found.distinct())
    ledger.append("pairs", wanted)
    texts.unpersist()


def path_findings(versions: DataFrame, ledger: Ledger, rules: tuple = RULES) -> DataFrame:
    """One row per version (path, blob) with the array of its findings
    (rule, start, end), from the ledger, for the given rule versions."""
    current = F.lit(False)
    for rule in rules:
        current = current | ((F.col("rule") == rule.name) & (F.col("version") == rule.version))
    by_blob = ledger.findings().where(current).groupBy("blob").agg(
        F.collect_list(F.struct("rule", "start", "end")).alias("findings"))
    return versions.join(by_blob, "blob", "left").withColumn(
        "findings", F.coalesce("findings", F.array().cast("array<struct<rule:string,start:int,end:int>>")))


def _versions(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").alias("path"), blob_of(text).alias("blob"), text.alias("text"))


def _joined(kinds: list[str]) -> Column:
    order = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform("findings", lambda x: F.struct(x["start"], order[x["rule"]], x["end"], x["rule"]))
    return F.array_join(F.transform(F.sort_array(keyed), lambda x: F.concat_ws(
        ":", x["rule"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def document_findings(spark: SparkSession, docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Digest of the findings of every document (path: doc_id), after bringing
    the ledger (a fresh one unless a path is given) up to date."""
    ledger = Ledger(spark, ledger_path or scratch_path(spark, "blob-ledger"))
    versions = _versions(docs)
    scan_increment(spark, versions, ledger)
    rows = path_findings(versions.drop("text"), ledger)
    def count(kind):
        return F.size(F.filter("findings", lambda x: x["rule"] == kind)).cast("long").alias(f"n_{kind}")
    spans = _joined([r.name for r in RULES])
    return rows.select(F.col("path").alias("doc_id"), *[count(r.name) for r in RULES],
                       F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def redacted_documents(spark: SparkSession, docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """``docs`` with all columns; the secret of each finding is replaced by
    ``[SECRET]`` in the text, and ``n_chars`` follows. Rows without findings
    keep their text as it is."""
    ledger = Ledger(spark, ledger_path or scratch_path(spark, "blob-ledger"))
    scan_increment(spark, _versions(docs), ledger)
    found = ledger.findings().select("blob").distinct().withColumn("found", F.lit(True))
    rows = docs.select(packed(docs).alias("row")).withColumn("blob", blob_of(F.col("row.text")))
    text = F.col("row.text")
    for rule in RULES:
        text = _redact(text, rule)
    out = rows.join(found, "blob", "left").withColumn("cut", F.when(F.col("found"), text).otherwise(F.col("row.text")))
    return out.select(*[F.col("cut").alias(c) if c == "text" else
                        F.char_length("cut").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
                        F.col("row").getField(c).alias(c) for c in docs.columns])


def _redact(text: Column, rule: Rule) -> Column:
    if rule.group == 0:
        return F.regexp_replace(text, rule.pattern, "[SECRET]") if rule.pattern.endswith(",}") else F.array_join(
            _rebuilt(text, rule, lambda whole, part: F.lit("[SECRET]")), "")
    return F.array_join(_rebuilt(text, rule, lambda whole, part: F.concat(
        F.substring(whole, F.lit(1), F.char_length(whole) - F.char_length(part)), F.lit("[SECRET]"))), "")


def _rebuilt(text: Column, rule: Rule, put) -> Column:
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    return F.transform(F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), part.alias("part")), lambda m: F.concat(
        m["piece"], F.when(m["whole"].isNull(), F.lit("")).when(
            F.char_length(m["part"]) >= rule.least, put(m["whole"], m["part"])).otherwise(m["whole"])))


# The same rows in SQL: every text scanned in full, positions by running sums.
def _kind_sql(i: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT rid, {i} AS k, '{kind}' AS kind, e - n AS s, e FROM (
    SELECT rid, length(whole[j]) AS n, length(part[j]) AS p,
           sum(length(piece[j]) + length(whole[j])) OVER (PARTITION BY rid ORDER BY j) AS e, whole, j, part
    FROM (SELECT rid, piece, whole, part, unnest(range(1, len(whole) + 1)) AS j FROM (
      SELECT rid, regexp_split_to_array(t, '{pattern}') AS piece, regexp_extract_all(t, '{pattern}', 0) AS whole,
             regexp_extract_all(t, '{pattern}', {group}) AS part FROM d
      WHERE regexp_matches(t, '{pattern}'))))
  WHERE p >= {least}"""


_ASSIGN_SQL = ("((?i:password|passwd|secret|token|api_?key))[\"\\x27]?\\x20*[:=]\\x20*[\"\\x27]?"
               "([A-Za-z0-9+/_.=-]+)")
BLOB_LEDGER_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_kind_sql(0, 'assign', _ASSIGN_SQL, 2, 12)} UNION ALL {_kind_sql(1, 'access', 'AKIA[A-Z0-9]+', 0, 18)}
  UNION ALL {_kind_sql(2, 'hex', '[0-9a-f]+', 0, 16)}),
g AS (
  SELECT rid, count_if(k = 0) AS n_assign, count_if(k = 1) AS n_access, count_if(k = 2) AS n_hex,
         string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k) AS spans
  FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""
