"""Chat formatting with typed content parts.

A turn's content is an ordered array of parts. The visitor flattens each part
by its type: text is escaped and copied, an image, audio clip or document
becomes a placeholder, its reference goes to the conversation's attachment
list, and its expanded tokens (units times the type's tokens per unit) are
counted. Everything is built-in expressions over one ``collect_list`` per
conversation.

Escaping inserts one backslash into every ``<``, backslashes, ``|`` of a text,
and reading back takes one out, so no text can forge a control string and every
text returns unchanged. A role escapes backslashes and line breaks as well.

Defined results: null text and null role are empty; a null conversation id is
its own conversation; turns order by (turn, role, parts) with null turns
first, so ties and repeated rows have one order; a conversation with empty
texts keeps its turns; an empty table gives no rows; unknown part types are
treated as ``document``. A conversation is one output row by contract, so its
size is bounded by Spark's row limit (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import with_running

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Placeholder and tokens per unit of each attachment type (units: image
#: tiles, audio seconds, document pages).
ATTACHMENTS = {"image": ("<|image|>", 256), "audio": ("<|audio|>", 50), "document": ("<|document|>", 1024)}
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*+)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    # every backslash of the result is followed by s or n
    role = F.replace(role, F.lit("\\"), F.lit("\\s"))
    return escape(F.replace(role, F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    role = F.replace(unescape(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(role, F.lit("\\s"), F.lit("\\"))


def text_turns(turns: DataFrame) -> DataFrame:
    """Plain turns (conv_id, turn, role, text) as turns with one text part."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"))
    return turns.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def _visit(part: Column) -> Column:
    """Text of one part in the formatted conversation."""
    out = F.lit(ATTACHMENTS["document"][0])
    for kind in ("audio", "image"):
        out = F.when(part["type"] == kind, F.lit(ATTACHMENTS[kind][0])).otherwise(out)
    return F.when(F.coalesce(part["type"], F.lit("text")) == "text",
                  escape(F.coalesce(part["text"], F.lit("")))).otherwise(out)


def _tokens(part: Column) -> Column:
    per = F.lit(ATTACHMENTS["document"][1])
    for kind in ("audio", "image"):
        per = F.when(part["type"] == kind, F.lit(ATTACHMENTS[kind][1])).otherwise(per)
    return F.coalesce(part["units"], F.lit(1)) * per


def format_chat(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, parts) -> one formatted row per conversation.

    Columns: conv_id, formatted, loss_spans (array of start and length in code
    points of ``formatted``, one for each assistant content), attachments
    (array of placeholder number, type, ref and expanded tokens, in order) and
    expanded_tokens.
    """
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    pieces = convs.select("conv_id", F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"),
        F.concat(F.lit(BEGIN), _escape_role(t["role"]), F.lit("\n")).alias("head"),
        F.array_join(F.transform(t["parts"], _visit), "").alias("body"))).alias("pieces"),
        F.filter(F.flatten(F.transform("turns", lambda t: t["parts"])),
                 lambda p: F.coalesce(p["type"], F.lit("text")) != "text").alias("files"))
    tail = f"{END}\n"
    sized = with_running(pieces.select(
        "*", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(tail))),
                          "").alias("formatted"),
        F.transform("pieces", lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(tail)).cast("bigint")).alias("sizes")),
        {"ends": "sizes"})
    bodies = F.transform("pieces", lambda p, i: F.struct(
        (F.get(F.col("ends"), i) - len(tail) - F.length(p["body"]) + 1).alias("start"),
        F.length(p["body"]).cast("bigint").alias("length"), p["role"].alias("role")))
    spans = F.transform(F.filter(bodies, lambda b: b["role"] == "assistant"),
                        lambda b: F.struct(b["start"].alias("start"), b["length"].alias("length")))
    return sized.select(
        "conv_id", "formatted", spans.alias("loss_spans"),
        F.transform("files", lambda p, i: F.struct(
            i.alias("n"), p["type"].alias("type"), p["ref"].alias("ref"),
            _tokens(p).cast("long").alias("tokens"))).alias("attachments"),
        F.aggregate("files", F.lit(0).cast("long"),
                    lambda acc, p: acc + _tokens(p).cast("long")).alias("expanded_tokens"))


def read_back(chats: DataFrame) -> DataFrame:
    """Parse ``formatted``: adds turns_back (role, text) and loss_back (texts)."""
    # what stands before the first turn is empty
    blocks = F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda b, i: i > 0)
    cut = F.transform(blocks, lambda b: F.substring_index(b, END, 1))
    turns = F.transform(cut, lambda b: F.struct(
        _unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substring(b, F.instr(b, "\n") + 1, F.lit(2**31 - 1))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), s["start"].cast("int"), s["length"].cast("int"))))
    return chats.withColumn("turns_back", turns).withColumn("loss_back", loss)
