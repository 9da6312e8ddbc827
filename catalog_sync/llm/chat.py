"""Chat formatting with typed content parts (DataFrame operations only).

A turn's content is an array of typed parts. A visitor turns each part into
text: text parts are escaped, image, audio and document parts become their
placeholder once per token they stand for, in order, while their references
are recorded. Turns are framed by control strings::

    <|im_start|>role\\ncontent<|im_end|>\\n

Control strings inside texts and roles are escaped reversibly: each gets one
more backslash after its first character (``</s>`` -> ``<\\/s>``), so none
remains in a text, and removing one backslash gives the text back exactly, also
if it held backslashes itself. In roles, which end at their line's end, a newline is written as
``\\n`` and a backslash doubled before that. The output is a list of segments, each under the
loss mask or not; the formatted string is their concatenation.

Defined cases: null text is empty; a null role is ``user``; null turns come
first; turns with the same number are ordered by role, then by their parts; repeated
rows are separate turns; a null conversation id is a conversation of its own; parts of unknown
type raise; null token counts are 1; an empty table gives an empty result.
A conversation is one row of the output, so one executor holds each (the format's unit); the collected
rows are the turns as they were, nothing is duplicated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.tables import let

START, END, ROLE_END = "<|im_start|>", "<|im_end|>\n", "\n"
#: Placeholders of the part types.
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: What may follow a control string's first character "<" or "[" (fixed values, regular expression).
BODIES = r"/?s>|/?INST\]|\|(?:im_start|im_end|endoftext|image|audio|document)\|>"
PART = "struct<type:string,text:string,ref:string,n_tokens:int>"


def escape(text: Column) -> Column:
    """``text`` without control strings: each gets one more backslash after its first character."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({BODIES})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({BODIES})", r"$1$2$3")


def escape_role(role: Column) -> Column:
    """A role on one line and without control strings."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """The inverse of :func:`escape_role`: between doubled backslashes, a backslash and ``n`` is a newline."""
    pieces = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def text_part(text: Column) -> Column:
    """A plain text as an array of one part."""
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("n_tokens"))
    return F.array(part.cast(PART))


def _visit(part: Column) -> Column:
    """The text of one part."""
    tokens = F.coalesce(part["n_tokens"], F.lit(1))
    out = F.when(part["type"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind, mark in PLACEHOLDERS.items():
        out = out.when(part["type"] == kind, F.repeat(F.lit(mark), tokens))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown content part: "), F.coalesce(part["type"], F.lit("null")))).cast("string"))


def format_chats(turns: DataFrame, *, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id, turn, role, parts``).

    Columns: ``conv_id``; ``segments`` array of (``text``, ``loss``), whose
    texts joined are ``formatted``; ``attachments`` array of (``turn_index``,
    ``part_index``, ``type``, ``ref``, ``n_tokens``) in order;
    ``expanded_tokens``, the placeholders' total. The loss mask lies on the
    contents of ``loss_roles``. One shuffle by conversation.
    """
    role = F.coalesce("role", F.lit("user"))
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    row = F.struct(F.col("turn"), role.alias("role"), parts.alias("parts"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def frame(t: Column) -> Column:
        content = F.array_join(F.transform(t["parts"], _visit), "")
        return F.array(
            segment(F.concat(F.lit(START), escape_role(t["role"]), F.lit(ROLE_END)), F.lit(False)),
            segment(content, t["role"].isin(*loss_roles)),
            segment(F.lit(END), F.lit(False)),
        )

    def attached(t: Column, at: Column) -> Column:
        seen = F.transform(t["parts"], lambda p, i: F.struct(
            at.alias("turn_index"), i.alias("part_index"), p["type"].alias("type"), p["ref"].alias("ref"),
            F.coalesce(p["n_tokens"], F.lit(1)).alias("n_tokens")))
        return F.filter(seen, lambda a: a["type"] != "text")

    out = chats.select(
        "conv_id",
        F.flatten(F.transform("turns", frame)).alias("segments"),
        F.flatten(F.transform("turns", attached)).alias("attachments"),
    )
    return out.select(
        "conv_id", "segments", "attachments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]).alias("expanded_tokens"),
    )


def parse_chats(chats: DataFrame) -> DataFrame:
    """Read :func:`format_chats` output back: ``turns`` array of (``role``, ``text``) from the formatted
    string, and ``loss_text``, the text under the mask (placeholders stay in both as they stand)."""
    framed = F.filter(F.split("formatted", START.replace("|", r"\|")), lambda x: x != "")

    def turn(x: Column) -> Column:
        head = F.substring_index(x, ROLE_END, 1)
        body = F.substring(x, F.length(head) + 2, F.length(x) - F.length(head) - 1 - len(END))
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return chats.select("conv_id", "formatted", let(framed, lambda f: F.transform(f, turn)).alias("turns"), loss.alias("loss_text"))
