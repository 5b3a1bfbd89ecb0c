"""Chat formatting (operator 2), in Spark expressions only.

The template, per run of adjacent turns of one role::

    <|turn|>role\\n text [<|next|> text ...] <|end|>\\n

``<|next|>`` stands between the texts of merged turns, so that the turns can be read back. Inside
roles and texts ``&``, ``<`` and ``[`` are written as ``&amp;``, ``&lt;`` and ``&lsqb;`` (and a line
feed in a role as ``&NewLine;``), so no control string of this or another common template can be
spelled by a text, and unescaping gives the text back.

The result has the formatted text, and the loss mask as (start, length) spans of it: the texts of
the assistant, without marks. Collecting a conversation's turns into one row is what the operator
is for: a conversation has to fit into a row, and merging copies its runs once per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, NEXT, END = "<|turn|>", "<|next|>", "<|end|>\n"
#: Escapes in the order of writing; reading back goes the other way.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;")]


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&NewLine;"))


def _role_back(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&NewLine;"), F.lit("\n")))


RUN = "struct<role:string,texts:array<string>>"
PIECE = "struct<start:int,length:int>"


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans from rows of conv_id, turn, role, text.

    Turns are ordered by ``turn``, a null one first, ties by role and text; repeated rows stay. Null
    roles and texts are empty. Rows without a conv_id form one conversation. An empty table gives
    no rows. Other columns are not read.
    """
    empty = F.lit("")
    turn = F.struct(F.col("turn"), _role(F.coalesce("role", empty)).alias("role"), escape(F.coalesce("text", empty)).alias("text"))
    merged = F.aggregate(
        "turns",
        F.array().cast(f"array<{RUN}>"),
        lambda runs, t: F.when(
            (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["role"] == t["role"]),
            F.concat(
                F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))),
                F.array(F.struct(t["role"].alias("role"), F.concat(F.try_element_at(runs, F.lit(-1))["texts"], F.array(t["text"])).alias("texts"))),
            ),
        ).otherwise(F.concat(runs, F.array(F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))))),
    )
    head = lambda r: F.concat(F.lit(TURN), r["role"], F.lit("\n"))
    body = lambda r: F.concat(head(r), F.array_join(r["texts"], NEXT), F.lit(END))
    # For each run, where its body starts; then, within a run, where each text starts.
    starts = F.aggregate(
        "runs",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda s, r: F.struct((s["at"] + F.length(body(r))).alias("at"), F.concat(s["starts"], F.array(s["at"] + F.length(head(r)))).alias("starts")),
    )["starts"]
    within = lambda at, r: F.aggregate(
        r["texts"],
        F.struct(at.alias("at"), F.array().cast(f"array<{PIECE}>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t) + len(NEXT)).alias("at"),
            F.concat(s["spans"], F.array(F.struct(s["at"].alias("start"), F.length(t).alias("length")))).alias("spans"),
        ),
    )["spans"]
    spans = F.flatten(
        F.transform(
            F.filter(F.arrays_zip(F.col("starts").alias("start"), F.col("runs").alias("run")), lambda x: x["run"]["role"] == _role(F.lit(loss_role))),
            lambda x: within(x["start"], x["run"]),
        )
    )
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", merged.alias("runs"))
        .select("conv_id", "runs", starts.alias("starts"))
        .select("conv_id", F.array_join(F.transform("runs", body), "").alias("formatted"), spans.alias("loss_spans"))
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, in order: array of struct(role, text), unescaped."""
    runs = F.filter(F.split(formatted, r"<\|turn\|>"), lambda x: F.length(x) > 0)

    def turns(run: Column) -> Column:
        role = F.substring_index(run, "\n", 1)
        texts = F.substr(run, F.length(role) + 2, F.length(run) - F.length(role) - 1 - len(END))
        return F.transform(F.split(texts, r"<\|next\|>"), lambda t: F.struct(_role_back(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(runs, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted rows hold: turns, loss text and lengths."""
    turns = F.col("turns")
    return (
        chats.withColumn("turns", read_turns(F.col("formatted")))
        .withColumn("loss", read_loss(F.col("formatted"), F.col("loss_spans")))
        .select(
            "conv_id",
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
