"""Chat formatting of typed content parts, in DataFrame operations only.

A turn's content is a list of parts: text, image, audio and document.  A
visitor gives each part its text in the format and the number of tokens it
will take; attachments leave a placeholder and a reference.  A turn is

    <|turn|>role<|body|>content<|end|>

In roles and texts a backslash becomes two and `<|` becomes `<\\|`, so no text
can hold a mark and every text can be read back.  A conversation's output
carries the place of each turn's content, and which places count for the loss.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from byteloom.llm import common

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: A list of parts: what a turn's content may be.
PARTS = (
    "array<struct<type string, text string, ref string, width int, height int, seconds double, pages int>>"
)
#: Placeholder of a part of another type, so that its reference is kept.
OTHER = "attachment"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, r"\\([\\|])", "$1")).otherwise(text)


@dataclass(frozen=True)
class Visitor:
    """What each kind of part becomes: (text in the format, tokens that its placeholder expands to).

    Sizes that are NULL or not positive count as one unit.
    """

    patch: int = 28
    tokens_per_second: float = 25.0
    tokens_per_page: int = 512
    marks: dict[str, str] = field(
        default_factory=lambda: {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", OTHER: "<|attachment|>"}
    )

    def text(self, part: Column) -> tuple[Column, Column]:
        return escaped(F.coalesce(part["text"], F.lit(""))), F.lit(0).cast("bigint")

    def image(self, part: Column) -> tuple[Column, Column]:
        side = [F.ceil(self.units(part[s]) / self.patch) for s in ("width", "height")]
        return F.lit(self.marks["image"]), side[0] * side[1]

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit(self.marks["audio"]), F.ceil(self.units(part["seconds"]) * F.lit(self.tokens_per_second))

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit(self.marks["document"]), F.ceil(self.units(part["pages"]) * self.tokens_per_page)

    def other(self, part: Column) -> tuple[Column, Column]:
        return F.lit(self.marks[OTHER]), F.lit(1).cast("bigint")

    @staticmethod
    def units(size: Column) -> Column:
        size = size.cast("double")
        return F.when((size > 0) & (size < float("inf")), size).otherwise(1.0)

    def visit(self, part: Column) -> Column:
        """struct<kind, ref, shown, tokens> of one part; a NULL part is an empty text."""
        kinds = {"text": self.text, "image": self.image, "audio": self.audio, "document": self.document}
        kind = F.when(part.isNull() | part["type"].isNull(), "text").otherwise(
            F.when(part["type"].isin(*kinds), part["type"]).otherwise(OTHER)
        )
        shown, tokens = self.other(part)
        for name, visit in kinds.items():
            text, count = visit(part)
            shown = F.when(kind == name, text).otherwise(shown)
            tokens = F.when(kind == name, count).otherwise(tokens)
        ref = F.when(kind != "text", F.coalesce(part["ref"], F.lit("")))
        return F.struct(kind.alias("kind"), ref.alias("ref"), shown.alias("shown"), tokens.cast("bigint").alias("tokens"))


def text_parts(text: Column) -> Column:
    """Plain text as a list of one part."""
    part = {"type": F.lit("text"), "text": text, "ref": F.lit(None), "width": F.lit(None), "height": F.lit(None),
            "seconds": F.lit(None), "pages": F.lit(None)}
    return F.array(F.struct(*[value.alias(name) for name, value in part.items()])).cast(PARTS)


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    content_col: str = "text",
    loss_role: str = "assistant",
    visitor: Visitor | None = None,
) -> DataFrame:
    """One row per conversation: its formatted text and what lies where.

    `content_col` is a text or a list of PARTS.  Result columns: the
    conversation's id, `formatted`, `n_turns`, `turns` (start_byte and bytes
    of each turn's content, `loss`), `attachments` in order (turn, kind, ref,
    tokens) and `expanded_tokens`, what all placeholders expand to.

    Turns are ordered by their number, equal numbers by role and content, NULL
    numbers last; repeated rows are turns each.  NULL roles and contents are
    empty; NULL ids are one conversation.  An empty table gives an empty
    result.  A conversation is one row of the result and so one group.
    """
    visitor = visitor or Visitor()
    content = F.col(content_col)
    is_text = turns.schema[content_col].dataType.simpleString() == "string"
    parts = text_parts(content) if is_text else F.coalesce(content.cast(PARTS), F.array().cast(PARTS))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.transform(parts, visitor.visit).alias("seen"),
    ).select(
        "conv", "turn", "role", "seen",
        F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)).alias("head"),
        F.array_join(F.transform("seen", lambda p: p["shown"]), "").alias("body"),
    )
    whole = F.octet_length("head") + F.octet_length("body") + len(END)
    order = W.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "role", "body")
    placed = rows.select(
        "*",
        F.row_number().over(order).alias("place"),
        (F.sum(whole.cast("bigint")).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.octet_length("body") - len(END)).alias("start"),
    )
    turn = F.struct(
        "place", "head", "body",
        F.struct(
            F.col("start").alias("start_byte"),
            F.octet_length("body").cast("bigint").alias("bytes"),
            (F.col("role") == loss_role).alias("loss"),
        ).alias("span"),
        F.transform(
            F.filter("seen", lambda p: p["kind"] != "text"),
            lambda p: F.struct(F.col("place").alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
        ).alias("attachments"),
    )
    # The window has put a conversation's rows together: no further shuffle.
    together = placed.groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    joined = F.array_join(F.transform("all", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    attachments = F.flatten(F.transform("all", lambda t: t["attachments"]))
    return together.select(
        F.col("conv").alias(conv_col),
        joined.alias("formatted"),
        F.size("all").cast("bigint").alias("n_turns"),
        F.transform("all", lambda t: t["span"]).alias("turns"),
        attachments.alias("attachments"),
    ).withColumn(
        "expanded_tokens",
        F.aggregate(F.transform("attachments", lambda a: a["tokens"]), F.lit(0).cast("bigint"), lambda total, n: total + n),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> from the formatted text alone; placeholders stay in the text as they are."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda _, place: place > 0)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, BODY, 1)
        body = F.substring_index(F.substring_index(piece, BODY, -1), END, 1)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, turns: Column) -> Column:
    """The texts under the loss mask, unescaped, one after the other."""
    raw = formatted.cast("binary")

    def under(span: Column) -> Column:
        # Positions in bytes are found in constant time.
        cut = F.substring(raw, span["start_byte"].cast("int") + 1, span["bytes"].cast("int"))
        return unescaped(cut.cast("string"))

    return F.array_join(F.transform(F.filter(turns, lambda s: s["loss"]), under), "")


def read_back(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of formatted conversations, taken from the output: turns by the marks, loss by its places."""
    read = chats.select(
        conv_col,
        "formatted",
        "expanded_tokens",
        F.size("attachments").cast("bigint").alias("n_attachments"),
        read_turns(F.col("formatted")).alias("read"),
        loss_text(F.col("formatted"), F.col("turns")).alias("loss"),
    )
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        conv_col,
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "n_attachments",
        "expanded_tokens",
    )


#: The contract's additional conversation: both turns say what other templates use as marks.
HOSTILE_ID, HOSTILE_TEXT = -7, r"\### Assistant: </turn> ok"


def with_hostile_chat(turns: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in turns.schema.fields}
    rows = turns.sparkSession.range(2).select(
        F.lit(HOSTILE_ID).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE_TEXT).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").union(rows)


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the hostile one, formatted and read back."""
    return read_back(format_chats(with_hostile_chat(common.table(spark, sf_dir, "conversations"))))


def _sql_escaped(text: str) -> str:
    return rf"replace(replace({text}, '\', '\\'), '<|', '<\|')"


OP12_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {HOSTILE_ID}, 0, 'user', '{HOSTILE_TEXT}'
  UNION ALL SELECT {HOSTILE_ID}, 1, 'assistant', '{HOSTILE_TEXT}'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_sql_escaped("role")}) + length({_sql_escaped("text")}) + {len(TURN + BODY + END)})::BIGINT AS formatted_chars,
       0::BIGINT AS n_attachments,
       0::BIGINT AS expanded_tokens
FROM rows
GROUP BY conv_id
"""
