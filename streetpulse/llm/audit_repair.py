"""Conversation structure repair: the cheapest audit of edits that makes a
conversation's role initials match ``(s?(ua)+)?``.

Every row gets one edit (Keep, Rerole, Delete) and empty turns may be Inserted
anywhere; an audit is the string of the edits' initials. The dynamic program
walks the rows with four states (nothing yet, after s, after u, after a) and
holds one audit a state as a node of a persistent tree: audits share their
prefixes, each node knows its depth, the rolling hash of its string and its
ancestors at distances 1, 2, 4, ... Of two audits of equal cost the smaller
string stays: their longest common prefix is found by descending the ancestors
with equal hashes, and what the hashes call equal is verified letter by letter.

An audit prefix fixes the state it leads to, and a proper prefix of an audit
over the same rows is cheaper, so the least of all audits is made of least
prefixes. For the same reason tables of (state before, state after) -> least
(cost, audit) compose over consecutive runs of rows: rows are put in order by a
range partitioning, cut into segments of at most ``SEGMENT`` rows, segments get
their tables in parallel, and only the tables of a conversation meet. The
repaired text is hashed in one stream over the sorted rows. No task holds a
conversation's texts; its audit (a letter a row) is one value and must fit one.

Defined cases: a null role, text or part of the damage key counts as one space;
conv_id null is a conversation of its own; null turns come first; equal turns
are in order of role and text; repeated rows are duplicates; a role that starts
with none of s, u, a (also an empty one) cannot be kept; a very long text is
hashed as it streams; a conversation without rows, or with all deleted, has the
empty audit; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetpulse.llm.tables import SPACES, stored

SEGMENT_BITS = 12            # segments of at most 4096 rows
SEGMENT = 1 << SEGMENT_BITS
REROLE, INSERT, DELETE, TRUNCATED = 3, 3, 4, 3   # costs of a rerole, an insert, a delete, of what stays truncated
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (START, AFTER_A)
SAID = {AFTER_U: "user", AFTER_A: "assistant"}
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Edits:
    """An audit: its last letter and its prefixes, shared with other audits."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter="", before=None):
        self.letter, self.depth, self.hash, self.up = letter, 0, 0, []
        if before is not None:
            self.depth = before.depth + 1
            self.hash = (before.hash * BASE + ord(letter)) % MODULUS
            self.up = [before]
            while len(self.up[-1].up) >= len(self.up):
                self.up.append(self.up[-1].up[len(self.up) - 1])

    def at(self, depth: int) -> "Edits":
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node

    def spelled(self) -> str:
        letters, node = [], self
        while node.depth:
            letters.append(node.letter)
            node = node.up[0]
        return "".join(reversed(letters))


def same(a: Edits, b: Edits) -> bool:
    """Whether two audits of one length are the same string: letter by letter
    down to the prefix they share as one node."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def comes_first(x: Edits, y: Edits) -> bool:
    """Whether the string of ``x`` is less than that of ``y``."""
    a, b = x.at(min(x.depth, y.depth)), y.at(min(x.depth, y.depth))
    if a.hash == b.hash:
        return x.depth < y.depth if same(a, b) else x.spelled() < y.spelled()
    for k in range(len(a.up) - 1, -1, -1):
        if k < len(a.up) and a.up[k].hash != b.up[k].hash:
            a, b = a.up[k], b.up[k]
    if same(a.up[0], b.up[0]):
        return a.letter < b.letter
    return x.spelled() < y.spelled()


def _said_next(state: int) -> int:
    """The state after an inserted or reroled turn: the only role that fits."""
    return AFTER_A if state == AFTER_U else AFTER_U


def _kept_next(state: int, initial: str) -> int | None:
    if initial == "s":
        return AFTER_S if state == START else None
    if initial in "ua" and SAID[_said_next(state)][0] == initial:
        return _said_next(state)
    return None


def _offer(best: list, state: int, cost: int, before: Edits, letter: str) -> None:
    held = best[state]
    if held is None or cost < held[0]:
        best[state] = (cost, Edits(letter, before))
    elif cost == held[0]:
        node = Edits(letter, before)
        if comes_first(node, held[1]):
            best[state] = (cost, node)


def _with_inserts(best: list) -> None:
    """Audits followed by inserts; two at most are ever worth their cost."""
    for target, sources in ((AFTER_U, (START, AFTER_S, AFTER_A)), (AFTER_A, (AFTER_U,))):
        for state in sources:
            if best[state] is not None:
                _offer(best, target, best[state][0] + INSERT, best[state][1], "I")


def least_audits(codes: str, entry: int) -> list[tuple[int, int, str]]:
    """(state after, cost, audit) of the least audits of a run of rows from
    state ``entry``. ``codes`` has two characters a row: the role's initial (x
    for another) and 0 clean, 1 truncated, 2 to be deleted."""
    best: list = [None] * 4
    best[entry] = (0, Edits())
    _with_inserts(best)
    for at in range(0, len(codes), 2):
        initial, fault = codes[at], codes[at + 1]
        more = TRUNCATED if fault == "1" else 0
        step: list = [None] * 4
        for state, held in enumerate(best):
            if held is None:
                continue
            cost, node = held
            _offer(step, state, cost + DELETE, node, "D")
            if fault == "2":
                continue
            kept = _kept_next(state, initial)
            if kept is not None:
                _offer(step, kept, cost + more, node, "K")
            _offer(step, _said_next(state), cost + REROLE + more, node, "R")
        best = step
        _with_inserts(best)
    return [(state, held[0], held[1].spelled()) for state, held in enumerate(best) if held is not None]


def illegal_pairs(initials: str) -> int:
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


class Pieces:
    """An audit made of the pieces of several segments, prefixes shared."""

    __slots__ = ("before", "piece", "depth")

    def __init__(self, before, piece):
        self.before, self.piece, self.depth = before, piece, 0 if before is None else before.depth + 1

    def list(self) -> list[str]:
        out, node = [], self
        while node.before is not None:
            out.append(node.piece)
            node = node.before
        return out[::-1]


def _tails(x: Pieces, y: Pieces) -> tuple[str, str]:
    """What two audits over the same segments spell after the last node they
    share."""
    a, b = [], []
    while x is not y:
        a.append(x.piece)
        b.append(y.piece)
        x, y = x.before, y.before
    return "".join(reversed(a)), "".join(reversed(b))


def joined(tables: list) -> tuple[int, list[str]]:
    """(cost, pieces) of the least audit over segments in order; a table has
    (state before, state after, cost, piece)."""
    best: dict = {START: (0, Pieces(None, ""))}
    for table in tables:
        step: dict = {}
        for entry, state, cost, piece in table:
            if entry not in best:
                continue
            node = (best[entry][0] + cost, Pieces(best[entry][1], piece))
            held = step.get(state)
            if held is None or node[0] < held[0]:
                step[state] = node
            elif node[0] == held[0]:
                mine, other = _tails(node[1], held[1])
                if mine < other:
                    step[state] = node
        best = step
    ends = [best[s] for s in ENDS if s in best]
    least = min(ends, key=lambda e: e[0])
    for e in ends:
        if e[0] == least[0] and e is not least and "".join(e[1].list()) < "".join(least[1].list()):
            least = e
    return least[0], least[1].list()


def _segment_tables(batches):
    seen: dict = {}
    for pdf in batches:
        tables = []
        for codes in pdf["codes"]:
            if codes not in seen:
                if len(seen) > 1000:
                    seen.clear()
                seen[codes] = json.dumps([(entry, *x) for entry in range(4) for x in least_audits(codes, entry)])
            tables.append(seen[codes])
        initials = [c[::2] for c in pdf["codes"]]
        yield pd.DataFrame({"conv_id": pdf["conv_id"], "seg": pdf["seg"], "illegal": [illegal_pairs(i) for i in initials],
                            "first": [i[0] for i in initials], "last": [i[-1] for i in initials], "table": tables})


def _joined_tables(batches):
    for pdf in batches:
        out = []
        for tables, illegal, first, last in zip(pdf["table"], pdf["illegal"], pdf["first"], pdf["last"]):
            cost, pieces = joined([json.loads(t) for t in tables])
            ends = [illegal_pairs(a + b) for a, b in zip(last[:-1], first[1:])]
            out.append((int(sum(illegal)) + sum(ends), cost, "".join(pieces), pieces))
        yield pd.DataFrame(out, columns=["illegal", "cost", "audit", "pieces"]).assign(conv_id=pdf["conv_id"], segs=pdf["seg"])


class _Repaired:
    """Applies an audit to the rows of one conversation, hashing what it gives."""

    def __init__(self):
        self.hash, self.state, self.lines, self.piece, self.at = hashlib.sha256(), START, 0, "", 0

    def _line(self, role, text):
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _inserts(self):
        while self.piece[self.at:self.at + 1] == "I":
            self.state = _said_next(self.state)
            self._line(SAID[self.state], "")
            self.at += 1

    def start(self, piece):
        self._inserts()
        self.piece, self.at = piece, 0

    def row(self, role, text):
        self._inserts()
        edit = self.piece[self.at]
        self.at += 1
        if edit == "R":
            self.state = _said_next(self.state)
            self._line(SAID[self.state], text)
        elif edit == "K":
            self.state = _kept_next(self.state, role[0])
            self._line(role, text)

    def done(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def _repaired_hashes(batches):
    """Streams rows sorted by conversation and segment, a segment's piece first."""
    now, own, held = None, None, False
    for pdf in batches:
        out = []
        for conv_id, piece, role, text in zip(pdf["conv_id"], pdf["piece"], pdf["role"], pdf["text"]):
            conv_id = None if conv_id is None or conv_id != conv_id else conv_id
            if not held or conv_id != now:
                if held:
                    out.append((now, own.done()))
                now, own, held = conv_id, _Repaired(), True
            if piece is not None:
                own.start(piece)
            else:
                own.row(role, text)
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"], dtype=object)
    if held:
        yield pd.DataFrame([(now, own.done())], columns=["conv_id", "repaired_sha256"], dtype=object)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage of the row's key."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                                harm.alias("harm")).where("harm <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    ).drop("copy")


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with ``ord``, which ascends with (conv_id, turn, role, text). A
    conversation of any size is spread over tasks by the range partitioning."""
    near = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 32)]
    ordered = rows.repartitionByRange(*near).sortWithinPartitions("conv_id", "turn", "role", "text")
    trimmed = F.btrim("text", F.lit(SPACES))
    return ordered.select(
        "*", F.monotonically_increasing_id().alias("ord"), (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"))


def _with_faults(ordered: DataFrame) -> DataFrame:
    """Rows with ``fault``: blank, duplicate, truncated or null."""
    first = ordered.where("NOT blank").groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min("ord").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    both = ordered.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    return both.select("conv_id", "turn", "role", "text", "ord", F.when(F.col("blank"), "blank").when(
        F.col("ord") > F.col("first"), "duplicate").when(F.col("cut"), "truncated").alias("fault"))


def repair(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    faulty = stored(_with_faults(stored(_in_order(rows.select("conv_id", "turn", "role", "text")), "audit-order")),
                    "audit-faults").withColumn("seg", F.shiftright("ord", SEGMENT_BITS)).withColumn(
        "conv_id", F.col("conv_id").cast("string"))   # pandas turns long ids with nulls into doubles
    initial = F.left("role", F.lit(1))
    code = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"),
                    F.when(F.col("fault").isNull(), "0").when(F.col("fault") == "truncated", "1").otherwise("2"))
    segments = faulty.select("conv_id", "seg", F.struct("ord", code.alias("code")).alias("row")).groupBy(
        "conv_id", "seg").agg(F.array_join(F.array_sort(F.collect_list("row"))["code"], "").alias("codes"))
    tables = segments.mapInPandas(_segment_tables, "conv_id string, seg bigint, illegal bigint, first string, "
                                                   "last string, table string")
    together = tables.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "seg", "illegal", "first", "last", "table"))).alias("s")).select(
        "conv_id", *[F.col("s")[c].alias(c) for c in ("seg", "illegal", "first", "last", "table")])
    audits = stored(together.mapInPandas(_joined_tables, "conv_id string, illegal bigint, cost bigint, audit string, "
                                                         "segs array<bigint>, pieces array<string>"), "audit-pieces")
    pieces = audits.select("conv_id", F.explode(F.arrays_zip("segs", "pieces")).alias("p")).select(
        "conv_id", F.col("p.segs").alias("seg"), F.lit(-1).cast("bigint").alias("ord"), F.col("p.pieces").alias("piece"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"))
    stream = pieces.unionByName(faulty.select("conv_id", "seg", "ord", F.lit(None).cast("string").alias("piece"), "role", "text"))
    hashes = stream.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "ord").select(
        "conv_id", "piece", "role", "text").mapInPandas(_repaired_hashes, "conv_id string, repaired_sha256 string")
    counts = faulty.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    named = {n: d.withColumnRenamed("conv_id", f"{n}_id") for n, d in
             (("a", audits.drop("segs", "pieces")), ("h", hashes), ("c", counts))}
    both = named["c"].join(named["a"], F.col("c_id").eqNullSafe(F.col("a_id"))).join(
        named["h"], F.col("c_id").eqNullSafe(F.col("h_id")))
    return both.select(F.col("c_id").cast(kind).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                       "repaired_sha256")


def damaged_and_repaired(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The repair of the damaged rows, for every conv_id of the given ones."""
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(repair(spark, damaged(conversations)), F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return found.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _crc32_sql(text: str) -> str:
    byte = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, {})"
    step = byte.format("xor(c, b)")
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {step}, "
            "4294967295::BIGINT), 4294967295)")


def _edit_sql(source: str, letter: str, cost: str, line: str, allowed: str) -> str:
    text = f"{source}.t || {line}" if line else f"{source}.t"
    return (f"{{'c': CASE WHEN {allowed} THEN {source}.c + {cost} END, 'a': {source}.a || '{letter}', 't': {text}}}")


def _least_sql(*candidates: str) -> str:
    return f"list_min(list_filter([{', '.join(candidates)}], lambda x: x.c IS NOT NULL))"


def _audit_sql() -> str:
    """DuckDB twin: the same program as a recursion over positions; each state
    is a struct of cost, audit and repaired text, of which the least is kept."""
    stay = "r.fault IS NULL OR r.fault = 'truncated'"
    more = "CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END"
    kept = "[r.role || ':' || r.text]"
    row = {}
    user = [_edit_sql(f"p.s{q}", "K", f"({more})", kept, f"({stay}) AND left(r.role, 1) = 'u'") for q in (0, 1, 3)]
    user += [_edit_sql(f"p.s{q}", "R", f"3 + ({more})", "['user:' || r.text]", stay) for q in (0, 1, 3)]
    row[0] = [_edit_sql("p.s0", "D", "4", "", "true")]
    row[1] = [_edit_sql("p.s1", "D", "4", "", "true"),
              _edit_sql("p.s0", "K", f"({more})", kept, f"({stay}) AND left(r.role, 1) = 's'")]
    row[2] = [_edit_sql("p.s2", "D", "4", "", "true"), *user]
    row[3] = [_edit_sql("p.s3", "D", "4", "", "true"),
              _edit_sql("p.s2", "K", f"({more})", kept, f"({stay}) AND left(r.role, 1) = 'a'"),
              _edit_sql("p.s2", "R", f"3 + ({more})", "['assistant:' || r.text]", stay)]
    moved = ", ".join(f"{_least_sql(*row[q])} AS e{q}" for q in range(4))
    inserted_u = _least_sql("e2", *[_edit_sql(f"e{q}", "I", "3", "['user:']", "true") for q in (0, 1, 3)])
    inserted_a = _least_sql("e3", _edit_sql("s2", "I", "3", "['assistant:']", "true"))
    none = "{'c': NULL::BIGINT, 'a': '', 't': []::VARCHAR[]}"
    start = "{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}"
    begin_u = "{'c': 3::BIGINT, 'a': 'I', 't': ['user:']}"
    begin_a = "{'c': 6::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}"
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32_sql(key)} % 20 AS harm
  FROM conversations),
harmed AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM given WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM harmed),
trimmed AS (
  SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS seen FROM placed),
rows AS (
  SELECT conv_id, turn, role, text, pos, CASE WHEN final = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
         WHEN final NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM trimmed),
walk AS (
  SELECT conv_id, 0::BIGINT AS pos, {start} AS s0, {none} AS s1, {begin_u} AS s2, {begin_a} AS s3
  FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT conv_id, pos, e0 AS s0, e1 AS s1, s2, {inserted_a} AS s3 FROM (
    SELECT *, {inserted_u} AS s2 FROM (
      SELECT p.conv_id, r.pos, {moved} FROM walk p JOIN rows r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.pos = p.pos + 1))),
ended AS (
  SELECT conv_id, {_least_sql("s0", "s3")} AS least FROM walk
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id)
SELECT g.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.least.c, 0)::BIGINT AS cost, coalesce(e.least.a, '') AS audit,
       sha256(coalesce(array_to_string(e.least.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counted c ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON g.conv_id IS NOT DISTINCT FROM e.conv_id"""


AUDIT_SQL = _audit_sql()
