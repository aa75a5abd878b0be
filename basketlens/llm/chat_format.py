"""Conversations as training examples: one example a reply, all turns before it as context.

Every turn becomes ``[INST] role [/INST] text</s>`` and a line feed. All
examples of a conversation are beginnings of one text, so that text is kept
once and an example is the number of its code points and the span of its reply;
``examples`` writes the texts out. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, SHUT, END = "[INST]", "[/INST]", "</s>"
#: The role whose turns are trained.
REPLY = "assistant"
BREAK = END + "\n"


def escaped(text: Column) -> Column:
    """A text in which no control string occurs: backslashes are doubled, one is put behind a control string's first sign."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in (OPEN, SHUT, END):
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return text


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given: every backslash goes, the sign behind it stays."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def segments(turns: DataFrame) -> DataFrame:
    """Every turn as a marked piece with its place: (conv_id, place, reply, start, head, body, piece).

    ``start`` counts the code points of the conversation before the piece, ``head``
    those of its marks and role before the text, ``body`` those of the escaped
    text. Turns are in order of ``turn``, nulls first; ties are in order of role
    and text, repeated rows all stay. A null role or text counts as empty, rows
    of a null conv_id are one conversation. No rows give no rows; other columns
    are not looked at, whatever their names. One exchange by conversation; the
    running sums read a conversation row by row and may spill.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN + " "), escaped(role), F.lit(f" {SHUT} "))
    marked = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escaped(text).alias("body"))
    sized = marked.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat("head", "body", F.lit(BREAK)).alias("piece"),
        F.length("head").cast("long").alias("head"),
        F.length("body").cast("long").alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.col("head") + F.col("body") + len(BREAK)
    before = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return sized.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        (F.col("role") == REPLY).alias("reply"),
        F.coalesce(before, F.lit(0)).alias("start"),
        "head",
        "body",
        "piece",
    )


def conversation_texts(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, examples) of every conversation.

    ``examples`` is an array of (chars, loss_start, loss_chars) in order: an
    example is the first ``chars`` code points of ``formatted``, and its loss
    mask covers ``loss_chars`` of them behind the first ``loss_start``: the
    reply's escaped text. Turns behind the last reply, which are context of no
    reply, make one more example with an empty mask, so no turn is lost. A
    conversation is one text here, as the digest of its turns needs it too.
    """
    end = F.col("start") + F.col("head") + F.col("body") + len(BREAK)
    reply = F.struct(end.alias("chars"), (F.col("start") + F.col("head")).alias("loss_start"), F.col("body").alias("loss_chars"))
    found = (
        segments(turns)
        .groupBy("conv_id")
        .agg(
            F.collect_list(F.struct("place", "piece")).alias("pieces"),
            F.sort_array(F.collect_list(F.when(F.col("reply"), reply))).alias("replies"),
            F.max(end).alias("total"),
            F.coalesce(F.max(F.when(F.col("reply"), end)), F.lit(0)).alias("answered"),
        )
    )
    rest = F.struct(F.col("total").alias("chars"), F.col("total").alias("loss_start"), F.lit(0).cast("long").alias("loss_chars"))
    return found.select(
        "conv_id",
        F.array_join(F.transform(F.sort_array("pieces"), lambda p: p["piece"]), "").alias("formatted"),
        F.when(F.col("total") > F.col("answered"), F.concat("replies", F.array(rest))).otherwise(F.col("replies")).alias("examples"),
    )


def text_of(formatted: Column, example: Column) -> Column:
    """An example's text."""
    return F.substr(formatted, F.lit(1), example["chars"].cast("int"))


def loss_of(text: Column, example: Column) -> Column:
    """What an example's loss mask covers, unescaped."""
    return unescaped(F.substr(text, (example["loss_start"] + 1).cast("int"), example["loss_chars"].cast("int")))


def examples(turns: DataFrame) -> DataFrame:
    """Every example written out: (conv_id, example, text, loss_start, loss_chars).

    A conversation of n replies gives n texts that begin alike, so the output
    grows with the square of a conversation's length; readers that can cut texts
    take ``conversation_texts``.
    """
    rows = conversation_texts(turns).select("conv_id", "formatted", F.posexplode("examples").alias("example", "e"))
    return rows.select("conv_id", "example", text_of(F.col("formatted"), F.col("e")).alias("text"), "e.loss_start", "e.loss_chars")


def turns_of(formatted: Column) -> Column:
    """Role and text of every turn of a formatted text, read back."""
    pieces = F.split(formatted, BREAK, -1)

    def read(piece: Column) -> Column:
        head = F.substring_index(piece, f" {SHUT} ", 1)
        text = F.substr(piece, F.length(head) + len(f" {SHUT} ") + 1)
        return F.struct(unescaped(F.substr(head, F.lit(len(OPEN) + 2))).alias("role"), unescaped(text).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), read)


def digest(formatted: DataFrame) -> DataFrame:
    """Turns and trained texts of every conversation, read back from what ``conversation_texts`` gives."""
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.transform("examples", lambda e: loss_of(text_of(F.col("formatted"), e), e))
    read = formatted.select("conv_id", "examples", turns_of(F.col("formatted")).alias("turns"), F.array_join(trained, "").alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.aggregate("examples", F.lit(0).cast("long"), lambda n, e: n + e["chars"]).alias("formatted_chars"),
    )


#: A conversation whose texts are made of control strings.
TRICKY = f"{END}{OPEN} ok {SHUT}"


def with_tricky(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -1, whose texts are control strings."""
    spark: SparkSession = turns.sparkSession
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(REPLY).alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


def _sql_escaped(x: str) -> str:
    x = f"replace({x}, '\\', '\\\\')"
    for mark in (OPEN, SHUT, END):
        x = f"replace({x}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return x


#: The same from the turns, without formatting: lengths are added up, texts joined.
SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE '{REPLY}' END, '{TRICKY}' FROM range(2) r(i)),
s AS (SELECT *, sum({len(f"{OPEN}  {SHUT} {BREAK}")} + length({_sql_escaped("role")}) + length({_sql_escaped("text")})) OVER (
  PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS e FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = '{REPLY}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{REPLY}'), '')) AS loss_sha256,
  (coalesce(sum(e) FILTER (WHERE role = '{REPLY}'), 0)
   + CASE WHEN max(e) > coalesce(max(e) FILTER (WHERE role = '{REPLY}'), 0) THEN max(e) ELSE 0 END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
