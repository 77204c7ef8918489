"""Chat formatting: typed content parts to one training string per conversation.

DataFrame functions only. A turn's parts (text, image, audio, document) are visited
in order: text is escaped, every other part becomes a placeholder and is recorded as
an attachment with its position and the number of tokens it stands for. Turns are
then joined in order, with the spans of the text under the loss mask.

Marks are written ``<|name|>``. Inside texts and roles every control string (these
marks and those of common chat formats) gets a backslash after its first character;
a backslash already there is kept, so one backslash less gives the text back exactly.

Defined results: a null text, role or list of parts is empty; turns are ordered by
turn, null first, ties by role and text; repeated rows are turns of their own; a null
``conv_id`` is one conversation; an empty table gives no rows. One conversation is one
value of the output, so its turns meet in one task; they are formatted and measured
before that, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks of this format and control strings of common chat formats.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
OPENERS = r"[<\[]"
TAILS = r"\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|</?SYS>>|/?tool_calls?>|/?think>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
UNKNOWN = "<|unknown|>"

#: One content part. ``size_a`` and ``size_b``: width and height of an image in
#: pixels, seconds of audio, pages of a document.
PART = "struct<kind:string,text:string,ref:string,size_a:double,size_b:double>"

#: Tokens an attachment expands to: image patches, audio frames, pages.
IMAGE_PATCH, AUDIO_TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({OPENERS})(\\*)({TAILS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({OPENERS})\\(\\*)({TAILS})", r"$1$2$3")


def text_part(text: Column) -> Column:
    """Parts of a plain text turn."""
    nothing = F.lit(None).cast("double")
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            nothing.alias("size_a"),
            nothing.alias("size_b"),
        )
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def _visit(seen: Column, part: Column) -> Column:
    """Add a part: texts side by side are one run, escaped as a whole, since a control string
    may begin in one and end in the next; any other part ends the run."""
    other = F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv])
    mark = F.coalesce(other[part["kind"]], F.lit(UNKNOWN))
    longer = F.concat(seen["run"], F.coalesce(part["text"], F.lit("")))
    closed = F.concat(seen["done"], escape(seen["run"]), mark)
    return F.struct(
        F.when(_is_text(part), seen["done"]).otherwise(closed).alias("done"),
        F.when(_is_text(part), longer).otherwise("").alias("run"),
    )


def _visit_tokens(part: Column) -> Column:
    a, b = F.coalesce(part["size_a"], F.lit(0.0)), F.coalesce(part["size_b"], F.lit(0.0))
    return (
        F.when(part["kind"] == "image", F.ceil(a / IMAGE_PATCH) * F.ceil(b / IMAGE_PATCH))
        .when(part["kind"] == "audio", F.ceil(a * AUDIO_TOKENS_A_SECOND))
        .when(part["kind"] == "document", F.ceil(a) * TOKENS_A_PAGE)
        .otherwise(F.lit(0))
        .cast("long")
    )


def flatten_parts(parts: Column) -> tuple[Column, Column]:
    """The turn's string with ordered placeholders, and its attachments in order."""
    parts = F.coalesce(parts, F.expr(f"CAST(array() AS array<{PART}>)"))
    nothing = F.struct(F.lit("").alias("done"), F.lit("").alias("run"))
    text = F.aggregate(parts, nothing, _visit, lambda seen: F.concat(seen["done"], escape(seen["run"])))
    numbered = F.transform(
        parts,
        lambda p, i: F.struct(
            i.alias("part"),
            p["kind"].alias("kind"),
            p["ref"].alias("ref"),
            _visit_tokens(p).alias("n_tokens"),
        ),
    )
    return text, F.filter(numbered, lambda x: ~_is_text(x))


def format_conversations(
    turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per conversation.

    ``turns``: conv_id, turn, role, parts (array of ``PART``). Returns conv_id,
    n_turns, formatted, loss_spans (start and length in code points of ``formatted``),
    attachments (turn number, part number, kind, ref, n_tokens), n_attachment_tokens.
    """
    text, attachments = flatten_parts(F.col("parts"))
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("body"), attachments.alias("attached"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    rows = rows.withColumn("head_chars", F.length(head)).withColumn(
        "piece", F.concat(head, "body", F.lit(END))
    )
    in_order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "body"
    )
    rows = rows.withColumn("nr", F.row_number().over(in_order)).withColumn(
        "start",
        F.coalesce(
            F.sum(F.length("piece")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    )
    span = F.struct(
        (F.col("start") + F.col("head_chars")).cast("long").alias("start"),
        F.length("body").cast("long").alias("length"),
    )
    turn = F.struct(
        "nr", "piece", F.when(F.col("role").isin(*loss_roles), span).alias("span"), "attached"
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct(
                    t["nr"].alias("turn_nr"), a["part"].alias("part"), a["kind"].alias("kind"),
                    a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens"),
                ),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        attached.alias("attachments"),
    ).withColumn(
        "n_attachment_tokens",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["n_tokens"]),
    )


def _turns(formatted: Column, body) -> Column:
    pieces = F.split(formatted, r"<\|turn\|>", -1)
    pieces = F.filter(pieces, lambda x, i: i > 0)

    def turn(piece: Column) -> Column:
        halves = F.split(piece, r"<\|body\|>", 2)
        return F.struct(
            unescape(halves[0]).alias("role"),
            body(F.substring(halves[1], F.lit(1), F.length(halves[1]) - len(END))),
        )

    return F.transform(pieces, turn)


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct<role, text>, unescaped."""
    return _turns(formatted, lambda body: unescape(body).alias("text"))


def parse_parts(formatted: Column) -> Column:
    """The same with the parts of each turn: array of struct<role, parts>, a part being
    struct<kind, text>. A real placeholder is a part of its kind; what only reads like one
    is text. Runs of text come back as one part, empty ones not at all."""
    names = "|".join([*PLACEHOLDERS, "unknown"])

    def parts(body: Column) -> Column:
        texts = F.split(body, rf"<\|(?:{names})\|>", -1)
        kinds = F.regexp_extract_all(body, F.lit(rf"<\|({names})\|>"), F.lit(1))
        part = lambda kind, text: F.struct(kind.alias("kind"), text.alias("text"))
        none = F.lit(None).cast("string")
        # each text, then the placeholder after it; there is one text more
        both = F.transform(
            texts, lambda x, i: F.array(part(F.lit("text"), unescape(x)), part(F.get(kinds, i), none))
        )
        said = lambda p: F.when(p["kind"] == "text", p["text"] != "").otherwise(p["kind"].isNotNull())
        return F.filter(F.flatten(both), said)

    return _turns(formatted, lambda body: parts(body).alias("parts"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order, unescaped."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
