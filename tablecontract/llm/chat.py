"""Chat formatting: typed content parts flattened by a visitor, turns marked, control strings escaped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import name_in

TURN, TEXT, END = "<turn>", "<text>", "</turn>"
#: What a part may be made of; a part only has what its type needs.
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    """Text in which no control string can occur: a backslash follows each backslash, ``<`` and ``[``, with which all of them begin."""
    for sign in ("\\", "<", "["):
        text = F.replace(text, F.lit(sign), F.lit(sign + "\\"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


class Visitor:
    """What each type of part becomes: its text, and for an attachment the tokens it stands for.

    Subclass it to add a type or to count tokens as another model does.
    """

    patch, tokens_a_second, tokens_a_page = 14, 25, 400

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0)

    def image(self, part: Column) -> tuple[Column, Column]:
        side = [F.ceil(F.coalesce(part[x], F.lit(0)) / self.patch) for x in ("width", "height")]
        return F.lit("<image>"), F.greatest(side[0] * side[1], F.lit(1))

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<audio>"), F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.tokens_a_second), F.lit(1))

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<document>"), F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * self.tokens_a_page

    def visit(self, part: Column) -> Column:
        """``content, kind, uri, tokens`` of a part. Of an unknown type, or none, its text counts."""
        content, tokens = self.text(part)
        attached = F.lit(None).cast("string")
        for kind in ("image", "audio", "document"):
            is_kind, (words, n) = part["type"] == kind, getattr(self, kind)(part)
            content, tokens = F.when(is_kind, words).otherwise(content), F.when(is_kind, n).otherwise(tokens)
            attached = F.when(is_kind, F.lit(kind)).otherwise(attached)
        return F.struct(content.alias("content"), attached.alias("kind"), part["uri"].alias("uri"), tokens.cast("long").alias("tokens"))



def format_conversations(
    messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str | None = "text",
    parts: str | None = None, learn: tuple[str, ...] = ("assistant",), visitor: Visitor | None = None,
) -> DataFrame:
    """One row per conversation, made of rows by turn.

    * ``formatted``: ``<turn>role<text>content</turn>`` for each turn in order. Roles and
      texts are escaped, so a control string in them is text, and ``turns`` reads it all back.
    * ``loss_spans``: start and length, in characters of ``formatted``, of each content of a role in ``learn``.
    * ``attachments``: turn, place in order, kind, ``uri`` and tokens of what stands behind each placeholder.
    * ``n_turns`` and ``n_tokens_expanded``, the tokens of all attachments.

    Content is the text column, or the column ``parts``, an array of ``PART``. Turns are ordered by
    their number, nulls first, and those with equal numbers by role and content. A null text,
    role or list of parts is empty; rows with a null conversation make one conversation;
    repeated rows are turns of their own; no rows give no conversations; other columns are not carried.
    A conversation is put together in one task, since it is one text in the end; its rows are shuffled once.
    """
    visitor = visitor or Visitor()
    content = name_in(messages, parts) if parts else None
    if content is None:
        content = F.array(F.struct(
            F.lit("text").alias("type"), name_in(messages, text).cast("string").alias("text"), F.lit(None).cast("string").alias("uri"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))
    visited = F.transform(F.coalesce(content.cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")), visitor.visit)
    said = F.coalesce(name_in(messages, role).cast("string"), F.lit(""))
    rows = messages.select(
        name_in(messages, conv).alias("conv_id"), name_in(messages, turn).alias("turn"), said.alias("role"), visited.alias("parts"))
    rows = rows.select(
        "conv_id", "turn", "role", F.array_join(F.transform("parts", lambda p: p["content"]), "").alias("content"),
        F.filter("parts", lambda p: p["kind"].isNotNull()).alias("attached"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content", "attached"))).alias("rows"))

    heads = F.transform("rows", lambda r: F.concat(F.lit(TURN), escape(r["role"]), F.lit(TEXT)))
    rows = rows.select("conv_id", "rows", heads.alias("heads"))
    sizes = F.transform("rows", lambda r, i: F.char_length(F.get("heads", i)) + F.char_length(r["content"]) + len(END))
    rows = rows.select(
        "*", sizes.alias("sizes"),
        F.array_join(F.transform("rows", lambda r, i: F.concat(F.get("heads", i), r["content"], F.lit(END))), "").alias("formatted"))
    # Where each turn begins, by a running sum that is kept in a text: appending to an array would copy it each time.
    starts = F.split(F.aggregate(
        "sizes", F.struct(F.lit("").alias("list"), F.lit(0).cast("long").alias("at")),
        lambda a, n: F.struct(F.concat(a["list"], a["at"].cast("string"), F.lit(",")).alias("list"), (a["at"] + n).alias("at")))["list"], ",")
    # An array of one element, transformed, gives the list a name, so it is made once and not for each turn.
    listed = F.array(F.filter(starts, lambda s: s != "").cast("array<long>"))
    spans = F.filter(F.flatten(F.transform(listed, lambda at: F.transform("rows", lambda r, i: F.struct(
        (F.get(at, i) + F.char_length(F.get("heads", i))).alias("start"), F.char_length(r["content"]).cast("long").alias("length"),
        r["role"].isin(*learn).alias("learn"))))), lambda s: s["learn"])
    attached = F.flatten(F.transform("rows", lambda r: F.transform(r["attached"], lambda p, k: F.struct(
        r["turn"].alias("turn"), (k + 1).alias("place"), p["kind"].alias("kind"), p["uri"].alias("uri"), p["tokens"].alias("tokens")))))
    rows = rows.select(
        "conv_id", "formatted", F.transform(spans, lambda s: F.struct(s["start"], s["length"])).alias("loss_spans"),
        attached.alias("attachments"), F.size("rows").cast("long").alias("n_turns"))
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return rows.withColumn("n_tokens_expanded", tokens)


def turns(formatted: Column) -> Column:
    """``role, text`` of each turn, read back from a formatted conversation."""
    parts = F.transform(F.split(formatted, END), lambda t: F.split(F.substr(t, F.lit(len(TURN) + 1)), TEXT, 2))
    return F.transform(
        F.filter(parts, lambda p: F.size(p) == 2),
        lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def learned(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read back."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
