"""Information-theoretic sanitisation of personal data.

Base spans (e-mail, IP address, card, phone) are found in every whole text and
are the protected entities. For an entity c and a term t anywhere in a text
that mentions it, the corpus says how strongly t reveals c:
PMI(c; t) = log2(N df(c, t) / (df(c) df(t))) against the information content
IC(c) = log2(N / df(c)), where N and all df count documents of the whole
corpus. Terms that carry at least ``REMOVE`` of the entity's information are
removed, from ``GENERALISE`` on they are replaced by their class; estimates from
fewer than ``SUPPORT`` documents are no evidence, so an entity of one document gets
none. All occurrences of a disclosing term go in every text that mentions the
entity. Texts without protected entities are left alone.

Document frequencies of terms are counted per task and summed. Only texts with
entities give pairs, and of their terms only those rare enough to disclose:
df(c, t) <= df(c), so PMI >= g IC(c) needs df(t) <= N^(1 - g) df(c)^g. Everything
joins on text, (entity, term) or term; no entity's documents are gathered.

Defined cases: a null text is empty; a null doc_id is kept; repeated rows each
count as a document and get the same spans; an entity in every document has no
information and discloses nothing.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetpulse.llm.qgram_decon import normalised
from streetpulse.llm.tables import packed, stored

KINDS = ("email", "ip", "card", "phone")
WINDOW = 10
SUPPORT = 2
GENERALISE, REMOVE = 0.6, 0.9
FLUSH = 300_000

# The base patterns. Digit runs of an address are taken whole
# (possessive, not entered in the middle): the same matches in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part reaches back from an @ to the last
    character that cannot be in it, or to the match before."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, entity), by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", s, e, text[s:e].lower()) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end(), m.group()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end(), digits))
    for m in _PHONE.finditer(text) if "+" in text else ():
        digits = re.sub("[^0-9]", "", m.group())
        if 9 <= len(digits) <= 15:
            out.append(("phone", m.start(), m.end(), digits))
    return out


def free_terms(text: str, spans: list) -> list[tuple[int, int]]:
    """(start, end) of all terms; parts of base spans are no terms."""
    taken = sorted((s, e) for _, s, e, _ in spans)
    starts = [s for s, _ in taken]
    ends_so_far, top = [], 0
    for _, e in taken:
        top = max(top, e)
        ends_so_far.append(top)
    terms = []
    for m in _TERM.finditer(text):
        i = bisect.bisect_left(starts, m.end())
        if i == 0 or ends_so_far[i - 1] <= m.start():
            terms.append((m.start(), m.end()))
    return terms


def nearby_terms(text: str, spans: list, window: int = WINDOW) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms within ``window`` terms of each mention."""
    terms = free_terms(text, spans)
    at = [s for s, _ in terms]
    out = set()
    for kind, s, e, entity in spans:
        left, right = bisect.bisect_left(at, s), bisect.bisect_left(at, e)
        for a, b in terms[max(0, left - window):left] + terms[right:right + window]:
            out.add((f"{kind}:{entity}", text[a:b].lower(), a, b))
    return sorted(out)


PASS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
        "text_key string, entities array<string>, places array<struct<term:string,start:int,end:int>>, term string, n long")
_PASS_NAMES = [c.split()[0] for c in PASS.split(", ")]


def text_key(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()


def _scan(batches):
    """Per row its base spans, and its terms if it has any; per task the document
    frequencies of all terms, in parts of at most ``FLUSH``."""
    df: Counter = Counter()
    for pdf in batches:
        rows = []
        ids = [None if x is None or x is pd.NA or x != x else int(x) for x in pdf["doc_id"]]
        for doc_id, text in zip(ids, pdf["text"]):
            text = text or ""
            df.update(set(normalised(text).split()))
            if len(df) > FLUSH:
                yield _counts(df)
                df = Counter()
            spans = base_spans(text)
            base = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)
            n = Counter(k for k, *_ in spans)
            entities = sorted({f"{k}:{entity}" for k, _, _, entity in spans})
            places = [{"term": text[a:b].lower(), "start": a, "end": b} for a, b in free_terms(text, spans)] if spans else []
            rows.append((doc_id, *(n[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base,
                         text_key(text) if spans else None, entities, places, None, None))
        yield _frame(rows)
    if df:
        yield _counts(df)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_PASS_NAMES)
    for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "n"):
        out[c] = pd.array(out[c].tolist(), dtype="Int64")
    return out


def _counts(df: Counter) -> pd.DataFrame:
    return _frame([(None,) * 10 + (w.decode("utf-8", "replace"), k) for w, k in df.items()])


def term_spans(passed: DataFrame) -> DataFrame:
    """(text_key, start, end, share, act) of the terms that disclose an entity."""
    rows = passed.where("base IS NOT NULL")
    total = rows.agg(F.count(F.lit(1))).first()[0]
    n = float(total or 1)
    # One row per text; documents are its rows, repeated ones included.
    texts = rows.where("text_key IS NOT NULL").groupBy("text_key").agg(
        F.count(F.lit(1)).alias("times"), F.first("entities").alias("entities"), F.first("places").alias("places"))
    mentions = texts.select("text_key", "times", F.explode("entities").alias("entity"))
    entities = mentions.groupBy("entity").agg(F.sum("times").alias("of_entity")).where(F.col("of_entity") >= SUPPORT)
    mentions = mentions.join(entities, "entity")
    terms = passed.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("of_term")).where(
        F.col("of_term") >= SUPPORT)
    held = texts.join(mentions.select("text_key").distinct(), "text_key", "left_semi")
    once = held.select("text_key", F.explode(F.array_distinct(F.col("places")["term"])).alias("term")).join(terms, "term")
    rare = F.col("of_term") <= F.lit(n ** (1 - GENERALISE) * (1 + 1e-9)) * F.pow(F.col("of_entity"), F.lit(GENERALISE))
    pairs = once.join(mentions, "text_key").where(rare).groupBy("entity", "term", "of_entity", "of_term").agg(
        F.sum("times").alias("both")).where(F.col("both") >= SUPPORT)
    pmi = F.log2(F.lit(n) * F.col("both") / (F.col("of_entity") * F.col("of_term")))
    share = F.try_divide(pmi, F.log2(F.lit(n) / F.col("of_entity")))
    told = pairs.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE)
    # All occurrences in every text that mentions the entity.
    marked = mentions.select("text_key", "entity").join(told, "entity").groupBy("text_key", "term").agg(
        F.max("share").alias("share"))
    places = held.select("text_key", F.explode("places").alias("x")).select("text_key", "x.*")
    spans = places.join(marked, ["text_key", "term"]).select("text_key", "start", "end", "share")
    return spans.withColumn("act", F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise"))


def disclosure_spans(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the scan, added spans collected per text)."""
    passed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_scan, PASS),
                    "disclosure")
    added = term_spans(passed).groupBy("text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "act", "share"))).alias("terms"))
    return passed.where("base IS NOT NULL"), added


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Digest of the spans of every document."""
    rows, added = disclosure_spans(spark, docs)
    terms = F.array_join(F.transform("terms", lambda x: F.concat_ws(
        ":", F.lit("term"), x["start"].cast("string"), x["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(terms, F.lit("")))
    # Texts without entities have no key and no added spans: they do not enter
    # the join, where all of them would meet in one task.
    keyed = rows.where("text_key IS NOT NULL").join(added, "text_key", "left")
    clean = rows.where("text_key IS NULL").withColumn("terms", F.lit(None).cast(added.schema["terms"].dataType))
    return keyed.unionByName(clean).select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"),
        F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_term"))


def sanitised(text: str | None, terms: list | None) -> str | None:
    """Base spans become [KIND], disclosing terms go or become their class."""
    if text is None:
        return None
    marks = [(s, e, f"[{k.upper()}]") for k, s, e, _ in base_spans(text)]
    for x in terms if terms is not None else []:
        word = text[x["start"]:x["end"]]
        kind = "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"
        marks.append((x["start"], x["end"], kind if x["act"] == "generalise" else ""))
    out, at = [], 0
    for s, e, put in sorted(marks):
        if s < at:  # inside a span that is gone already
            at = max(at, e)
            continue
        out += [text[at:s], put]
        at = e
    return "".join(out) + text[at:]


def sanitised_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with all columns and sanitised texts."""
    _, added = disclosure_spans(spark, docs)
    keyed = docs.select(packed(docs).alias("row"), F.col("text")).withColumn(
        "text_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    clean = F.pandas_udf(lambda texts, terms: pd.Series([sanitised(t, x) for t, x in zip(texts, terms)]), "string")
    out = keyed.join(added, "text_key", "left").withColumn("clean", clean("text", "terms"))
    return out.select(*[F.col("clean").alias(c) if c == "text" else F.col("row").getField(c).alias(c)
                        for c in docs.columns])
