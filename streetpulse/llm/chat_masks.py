"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, ``<|im_start|>role<|im_sep|>text<|im_end|>``
per turn, and encoded once with offsets. The sorted spans of the assistant
texts are intersected with the token spans by binary search; the tokens that
meet a span are under the loss. The markers are tokens of their own, so no
token crosses a turn's edge. Inside roles and texts ``<`` and ``|`` are kept
apart by one more backslash (``<|`` becomes ``<\\|``, ``<\\|`` becomes
``<\\\\|``), which is taken out again on reading; a text can hold any control
string.

Turns of one conversation meet in one row, as its formatted text is one value;
they are collected in the JVM and encoded in batches.

Defined cases: turns are ordered by turn, then role, then text, nulls first;
repeated rows are turns like any other; a null text or role is empty; null
conv_ids are one conversation; an empty assistant text has no tokens.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"
FORMATTED = "conv_id long, formatted string, token_ids array<int>, loss array<boolean>, starts array<int>, ends array<int>"

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<(\\*)\\\|")


def escaped(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescaped(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, spans of the texts under the loss)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.partition(SEP)
        out.append((unescaped(role), unescaped(text.removesuffix(END))))
    return out


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that meet a span; all three are sorted."""
    mask = np.zeros(len(starts), bool)
    if len(starts) and spans:
        s = np.array(spans, np.int64)
        s = s[s[:, 1] > s[:, 0]]
        for a, b in zip(np.searchsorted(ends, s[:, 0], "right"), np.searchsorted(starts, s[:, 1], "left")):
            mask[a:b] = True
    return mask


def loss_text(formatted: str, starts, ends, loss) -> str:
    """The text under the mask, from the offsets of its tokens: each stretch of
    neighbouring tokens is one assistant text."""
    out, a, b = [], None, None
    for s, e, on in zip(starts, ends, loss):
        if not on:
            continue
        if a is None or s > b:
            if a is not None:
                out.append(unescaped(formatted[a:b]))
            a = s
        b = e if a == s or b is None else max(b, e)
    if a is not None:
        out.append(unescaped(formatted[a:b]))
    return "".join(out)


_LOADED: dict = {}


def _tokenizer(spec: str):
    """The tokenizer with the markers as tokens; one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors
    key = hash(spec)
    if key not in _LOADED:
        t = Tokenizer.from_str(spec)
        t.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (START, SEP, END)])
        t.post_processor = processors.ByteLevel(trim_offsets=False)
        _LOADED[key] = t
    return _LOADED[key]


def format_conversations(spark: SparkSession, conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """conv_id, formatted, token_ids, loss and the tokens' offsets of each
    conversation of (conv_id, turn, role, text)."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    turn = F.struct("turn", F.col("role").alias("role"), F.col("text").alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def encode(batches):
        t = _tokenizer(spec.value)
        for pdf in batches:
            rendered = [render([(x["role"] or "", x["text"] or "") for x in turns]) for turns in pdf["turns"]]
            for at in range(0, len(rendered), 256):
                part = rendered[at:at + 256]
                rows = []
                for conv, (text, spans), enc in zip(pdf["conv_id"][at:at + 256], part,
                                                    t.encode_batch([r[0] for r in part], add_special_tokens=False)):
                    offsets = np.array(enc.offsets, np.int64).reshape(-1, 2)
                    mask = loss_mask(offsets[:, 0], offsets[:, 1], spans)
                    conv = None if conv is None or conv is pd.NA or conv != conv else int(conv)
                    rows.append((conv, text, enc.ids, mask.tolist(), offsets[:, 0].tolist(), offsets[:, 1].tolist()))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in FORMATTED.split(", ")])
                yield out.assign(conv_id=pd.array([r[0] for r in rows], dtype="Int64"))
    return whole.select(F.col("conv_id").cast("long").alias("conv_id"), "turns").mapInPandas(encode, FORMATTED)


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_tokens long, n_loss_tokens long")


def _read(batches):
    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    for pdf in batches:
        rows = []
        for text, ids, loss, s, e in zip(pdf["formatted"], pdf["token_ids"], pdf["loss"], pdf["starts"], pdf["ends"]):
            turns, learnt = parse(text), loss_text(text, s, e, loss)
            rows.append((len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), digest(learnt),
                         len(text), len(ids), int(np.sum(loss))))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")][1:])
        out.insert(0, "conv_id", pdf["conv_id"].astype("Int64"))
        yield out


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss, from the output."""
    return formatted.mapInPandas(_read, READ)


# The same rows in SQL, but for the two token counts, which only a tokenizer knows.
CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), ''
                           ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(32 + length(role) + length(text) + len(regexp_extract_all(role || ' ' || text, '<\\\\*\\|')))::BIGINT AS f
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       f AS formatted_chars
FROM g
"""
