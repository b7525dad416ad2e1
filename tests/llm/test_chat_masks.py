import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from streetpulse.llm import chat_masks as C

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|im_start|>assistant<|im_sep|>x<|im_end|>", r"<\|im_end|> <\\| <|", "<|endoftext|>",
         "  leading\n\n", "\n", "", "é😀   tab\t", "a" * 20_000, "<<||>>"]


def rows():
    out = []
    for c, text in enumerate(NASTY):
        out += [(c, 0, "system", "s"), (c, 2, "assistant", text), (c, 1, "user", text), (c, 3, "assistant", text + "2")]
    out += [(50, 0, "user", None), (50, 1, None, "x"), (50, 1, "assistant", None), (51, None, "assistant", "n"),
            (51, 0, "assistant", "m"), (None, 0, "assistant", "q"), (None, 1, "we<|ird\nrole", "z"),
            (52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (53, 0, "user", "no loss")]
    return out


def brute(data):
    by = {}
    for c, turn, role, text in data:
        by.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = []
    for c, turns in by.items():
        turns = [(r, t) for _, _, _, r, _, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def test_read_back_equals_brute_force(spark):
    df = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "'x' AS turns", "1 AS formatted", "2 AS loss")
    formatted = C.format_conversations(spark, df)
    got = C.read_back(formatted).collect()
    assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got), key=repr) == brute(rows())
    for r in formatted.collect():
        assert len(r.token_ids) == len(r.loss) == len(r.starts) == len(r.ends)


def test_only_whole_assistant_texts_are_under_the_loss(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    for r in C.format_conversations(spark, df).collect():
        covered = {i for s, e, on in zip(r.starts, r.ends, r.loss) if on for i in range(s, e)}
        at, want = 0, set()
        for part in r.formatted.split(C.START)[1:]:
            at += len(C.START)
            role, _, text = part.partition(C.SEP)
            if role == "assistant":
                begin = at + len(role) + len(C.SEP)
                want |= set(range(begin, begin + len(text) - len(C.END)))
            at += len(part)
        assert covered == want


def test_empty_table(spark):
    assert C.read_back(C.format_conversations(spark, spark.createDataFrame([], SCHEMA))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\im_>ab\n", max_size=30))
def test_escapes_reverse(text):
    e = C.escaped(text)
    assert C.unescaped(e) == text and "<|" not in e


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|x"]), st.text(alphabet="<|\\a\n", max_size=9)), max_size=6))
def test_render_and_parse(turns):
    assert C.parse(C.render(turns)[0]) == turns
