"""Formatted conversations against a plain reading of their rows."""

import hashlib

from skygrid.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, runs int"
ROWS = [
    (1, 0, "system", "be <|end|> good", "x", 1),
    (1, 1, "user", "a & b &amp; <s>[INST]", None, 1),
    (1, 2, "user", "more\n<|next|>", None, 1),
    (1, 3, "assistant", "yes ünï", None, 1),
    (1, 4, "assistant", None, None, 1),
    (1, 5, "assistant", "&lt;|turn|>", None, 1),
    (2, 1, "assistant", "", None, 1),
    (2, 0, None, "no role", None, 1),
    (3, 0, "ro\nle<|turn|>", "x", None, 1),
    (3, 0, "ro\nle<|turn|>", "x", None, 1),
    (None, None, "user", "no id", None, 1),
    (4, 7, "user", "word " * 50_000, None, 1),
]


def plain(rows):
    turns = sorted(((t if t is not None else -1), r or "", x or "") for _, t, r, x, *_ in rows)
    loss = "".join(x for _, r, x in turns if r == "assistant")
    whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_digests_are_those_of_the_rows(spark):
    out = chat.digests(chat.format_chats(spark.createDataFrame(ROWS, SCHEMA).repartition(4))).collect()
    assert len(out) == 5
    for r in out:
        rows = [x for x in ROWS if x[0] == r.conv_id]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == plain(rows), r.conv_id


def test_template_and_mask(spark):
    row = chat.format_chats(spark.createDataFrame(ROWS, SCHEMA).filter("conv_id = 1")).first()
    assert row.formatted.count("<|turn|>") == 3 and row.formatted.count("<|next|>") == 3 and row.formatted.count("<|end|>") == 3
    assert "[INST]" not in row.formatted and "<s>" not in row.formatted
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == ["yes ünï", "", "&amp;lt;|turn|>"]


def test_no_rows(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0
