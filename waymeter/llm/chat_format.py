"""Chat formatting of typed content parts, as column expressions only.

A message is a list of parts: text, image, audio or document. A visitor flattens them in order: text is escaped
and kept, any other part becomes a placeholder, and its reference and number of expanded tokens are recorded.
Each turn is then `<|im_start|>role`, a line feed, the body and `<|im_end|>` with a line feed.

Escaping is reversible: `\\` becomes `\\b` and `<|` becomes `<\\p`, so no text holds a control string or a placeholder
afterwards, and each `\\` is followed by its code letter. In roles a line feed becomes `\\n`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Role whose bodies are under the loss mask.
LEARNED_ROLE = "assistant"
#: Expanded tokens: one for each started image patch, stretch of sound, and so many for a page.
PATCH_PIXELS, AUDIO_MILLIS, PAGE_TOKENS = 14, 40, 256

PART = "struct<kind:string,text:string,ref:string,width:long,height:long,millis:long,pages:long>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"))).cast(f"array<struct<kind:string,text:string>>")


def _steps(n: Column, size: int) -> Column:
    return F.ceil(F.coalesce(n, F.lit(0)) / size)


def part_tokens(p: Column) -> Column:
    """Tokens that a part's placeholder expands to; 0 for text and unknown kinds."""
    return (
        F.when(p["kind"] == "image", _steps(p["width"], PATCH_PIXELS) * _steps(p["height"], PATCH_PIXELS))
        .when(p["kind"] == "audio", _steps(p["millis"], AUDIO_MILLIS))
        .when(p["kind"] == "document", F.coalesce(p["pages"], F.lit(0)) * PAGE_TOKENS)
        .otherwise(F.lit(0)).cast("long")
    )


def part_text(p: Column) -> Column:
    """What a part leaves in the body: its escaped text or its placeholder; any other kind keeps its text."""
    out = F.coalesce(escape(p["text"]), F.lit(""))
    for kind, mark in PLACEHOLDERS.items():
        out = F.when(p["kind"] == kind, F.lit(mark)).otherwise(out)
    return out


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation from (conv_id, turn, role, parts: array of PART, or of its kind and text).

    Columns: conv_id, formatted, n_turns, loss_spans (turn, within: offset in the turn after its start mark,
    start: offset in ``formatted``, length; in code points) of the assistant's bodies, attachments (turn, part,
    kind, ref, tokens) in order, expanded_tokens.

    Rows are ordered by turn, null first; ties by role and body, so repeated rows are repeated turns. A null
    role or text counts as empty, null parts as none, and a null conv_id is a conversation of its own. An empty
    table gives no rows. A conversation is one string, so its rows meet in one task; nothing else is gathered.
    """
    fields = messages.schema["parts"].dataType.elementType.names
    full = F.transform(
        F.coalesce("parts", F.array().cast(messages.schema["parts"].dataType)),
        lambda p: F.struct(*[(p[n] if n in fields else F.lit(None)).alias(n) for n in ("kind", "text", "ref", "width", "height", "millis", "pages")]).cast(PART),
    )
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    rows = messages.select("conv_id", "turn", role.alias("role"), full.alias("parts"))
    rows = rows.select("conv_id", "turn", "role", "parts", F.array_join(F.transform("parts", part_text), "").alias("body"))
    rows = rows.withColumn("piece", F.concat(F.lit(START), "role", F.lit("\n"), "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "body")
    until = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "conv_id", "role", "parts", "body", "piece",
        (F.row_number().over(order) - 1).alias("at"),
        F.coalesce(F.sum(F.length("piece").cast("long")).over(until), F.lit(0)).alias("before"),
    )
    within = F.length("role") + 1
    span = F.struct(
        "at", within.alias("within"), (F.col("before") + len(START) + within).alias("start"), F.length("body").alias("length")
    )
    found = F.filter(
        F.transform("parts", lambda p, k: F.struct(F.col("at").alias("at"), k.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens"))),
        lambda p: p["kind"].isin(*PLACEHOLDERS),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role") == LEARNED_ROLE, span))).alias("loss_spans"),
        F.sort_array(F.flatten(F.collect_list(found))).alias("attachments"),
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.size("pieces").cast("long").alias("n_turns"),
        "loss_spans",
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, each from after its start mark to before its end mark."""
    marked = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(marked, 2, F.size(marked)), lambda t: F.left(t, F.length(t) - len(END)))


def roles_and_bodies(turns: Column) -> Column:
    """(role, text) of each turn, unescaped."""

    def read(t: Column) -> Column:
        raw = F.substring_index(t, "\n", 1)
        role = unescape(F.replace(raw, F.lit("\\n"), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substr(t, F.length(raw) + 2)).alias("text"))

    return F.transform(turns, read)


def learned_text(turns: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substr(turns[s["at"]], s["within"] + 1, s["length"]))), "")
