"""Chat formatting of typed content parts.

A turn's content is a list of parts: text, image, audio or document. The formatter visits them
in order, writes texts with control strings escaped and a placeholder for every other part, and
records where each placeholder points and how many tokens it stands for. A conversation is
``<|turn|>role<|sep|>content<|end|>`` for each turn; the loss mask covers assistant texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SEP, END = "<|turn|>", "<|sep|>", "<|end|>"
#: Kinds of parts with a placeholder ``<|kind|>``.
ATTACHED = ("image", "audio", "document")
#: Tokens a placeholder expands to: an image's patches of 14 x 14 pixels merged 2 x 2, 25 frames
#: of audio a second, and 576 for a page of a document.
PATCH, FRAMES, PAGE = 28, 25, 576
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
# A control string opens with < or [; what follows the bracket tells it from ordinary text.
_TAIL = r"(?=\||/?s>|/?INST\])"


def escaped(text: Column) -> Column:
    """Text without control strings: a tilde, or one more, after the bracket that opens one."""
    return F.regexp_replace(text, rf"([<\[])(~*){_TAIL}", "$1~$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])~(~*){_TAIL}", "$1$2")


def _tokens(part: Column) -> Column:
    up = lambda a, b: F.ceil(F.coalesce(a, F.lit(0)) / F.lit(b))
    return (
        F.when(part["type"] == "image", up(part["width"], PATCH) * up(part["height"], PATCH))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE)
        .otherwise(F.lit(0))
        .cast("long")
    )


def text_part(text: Column) -> Column:
    """A content of one text part."""
    null = F.lit(None)
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), null.alias("ref"), null.alias("width"), null.alias("height"), null.alias("seconds"), null.alias("pages"))
    return F.array(part.cast(PART))


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss, attachments, expanded_tokens``.

    ``content`` is an array of :data:`PART`. ``loss`` lists assistant texts in order as
    ``turn`` (0-based place in the conversation), ``start`` (0-based, code points after that
    turn's marker) and ``length``; ``attachments`` has ``turn, part, type, ref, tokens`` of every
    placeholder in order, ``expanded_tokens`` sums those tokens.

    Turns are ordered by ``turn``, null last, then by role and content. Null texts, roles and
    contents are empty, null parts are skipped, unknown types are text. Repeated rows are turns
    of their own; rows without a conversation id form one conversation. A conversation is one
    value, so it is put together in one task; turns are formatted before, wherever they lie.
    """
    known = F.filter(F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    shown = F.transform(
        known,
        lambda p: F.struct(
            p["type"].isin(*ATTACHED).alias("attached"),
            F.when(p["type"].isin(*ATTACHED), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escaped(F.coalesce(p["text"], F.lit("")))).alias("out"),
            p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens"), F.coalesce(p["text"], F.lit("")).alias("raw"),
        ),
    )
    named = escaped(F.coalesce(F.col(role), F.lit("")))
    each = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), named.alias("named"), shown.alias("shown"))
    head = F.length("named") + len(SEP)
    before = lambda i: F.aggregate(F.slice("shown", 1, i), head, lambda n, p: n + F.length(p["out"]))
    spans = F.filter(
        F.transform("shown", lambda p, i: F.struct(p["attached"].alias("attached"), before(i).alias("start"), F.length(p["out"]).alias("length"))),
        lambda s: ~F.coalesce(s["attached"], F.lit(False)),
    )
    places = F.filter(
        F.transform("shown", lambda p, i: F.struct(p["attached"].alias("attached"), i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))),
        lambda a: F.coalesce(a["attached"], F.lit(False)),
    )
    body = F.array_join(F.transform("shown", lambda p: p["out"]), "")
    each = each.select(
        "conv_id",
        F.struct(
            F.col("turn").isNull().alias("last"), "turn",
            F.coalesce("role", F.lit("")).alias("role"), F.transform("shown", lambda p: p["raw"]).alias("raw"),
            F.concat(F.lit(TURN), "named", F.lit(SEP), body, F.lit(END)).alias("piece"),
            F.when(F.col("role") == "assistant", spans).otherwise(F.slice(spans, 1, 0)).alias("spans"),
            places.alias("places"),
        ).alias("t"),
    )
    whole = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    whole = whole.select("conv_id", "ts", F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("formatted"))
    loss = F.flatten(F.transform("ts", lambda t, k: F.transform(t["spans"], lambda s: F.struct(k.alias("turn"), s["start"].alias("start"), s["length"].alias("length")))))
    attachments = F.flatten(
        F.transform("ts", lambda t, k: F.transform(t["places"], lambda a: F.struct(k.alias("turn"), a["part"].alias("part"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    )
    out = whole.select("conv_id", F.size("ts").cast("long").alias("n_turns"), "formatted", loss.alias("loss"), attachments.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text out of formatted conversations: ``conv_id, turns, loss_text, loss_chars``.

    ``turns`` has ``role`` and ``text`` (placeholders left out), ``loss_text`` the texts under
    the loss mask, end to end.
    """
    pieces = F.split("formatted", r"<\|turn\|>")
    cut = formatted.select("conv_id", "formatted", "loss", F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("pieces"))
    inner = lambda p: F.regexp_replace(F.substring(p, F.length(F.substring_index(p, SEP, 1)) + F.lit(len(SEP) + 1), F.length(p)), r"<\|[a-z]+\|>", "")
    turns = F.transform("pieces", lambda p: F.struct(unescaped(F.substring_index(p, SEP, 1)).alias("role"), unescaped(inner(p)).alias("text")))
    under = F.transform("loss", lambda s: unescaped(F.substring(F.get("pieces", s["turn"]), s["start"] + 1, s["length"])))
    out = cut.select("conv_id", "formatted", turns.alias("turns"), F.array_join(under, "").alias("loss_text"), F.size("pieces").alias("n"))
    return out.select("conv_id", "formatted", "turns", "loss_text", F.length("loss_text").cast("long").alias("loss_chars"))
