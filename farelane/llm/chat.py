r"""Chat formatting with a grammar round trip (operator 9, native).

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "### " role ": " body "\n</turn>\n"

``role`` holds no ``:``, ``#`` or ``<``: they and the backslash are written ``\c \h \l \b``. In ``body``
the control strings ``### `` and ``</turn>`` are data only if at least one backslash stands before them;
the parser takes exactly one backslash off each such run, and reads no turn from a body in which a control string stands
without one. A text that holds a control string, with or
without backslashes before it, therefore doesn't read back as itself: after rendering, the parser's
turns are compared with the source, and conversations that differ are rendered again with one more
backslash before each control string, until they are identical (the first escape suffices, since
escaping is a bijection; a difference after the last level raises an error rather than passing).

Everything is one aggregation by conversation and higher-order functions: no Python on the data. A
conversation is one text, so it must fit into one row, as its digest asks for.

Nulls and edges: null text and null role are empty strings; a null conv_id is a conversation of its
own; equal turn numbers are ordered by role, then text, a null turn first. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "\n</turn>\n"
CONTROL = r"(\\*)(### |</turn>)"
ROLE_CODES = [("\\", r"\b"), (":", r"\c"), ("#", r"\h"), ("<", r"\l")]
#: A control string that isn't data.
RAW = r"(?<!\\)(### |</turn>)"
#: Levels of escaping tried in turn.
LEVELS = 2


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1$2")


def unescape(body: Column) -> Column:
    return F.regexp_replace(body, r"\\" + CONTROL, "$1$2")


def write_role(role: Column) -> Column:
    for raw, code in ROLE_CODES:
        role = F.replace(role, F.lit(raw), F.lit(code))
    return role


def read_role(role: Column) -> Column:
    for raw, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(raw))
    return role


def render(turns: Column, escapes: int) -> Column:
    """Text of an array of struct(role, text)."""

    def one(t: Column) -> Column:
        body = t["text"]
        for _ in range(escapes):
            body = escape(body)
        return F.concat(F.lit(OPEN), write_role(t["role"]), F.lit(AFTER_ROLE), body, F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """The turns read from a formatted text: array of struct(role, text), null for a turn with a raw control string in its body; its only input is that text."""
    pieces = F.split(formatted, r"(?<!\\)</turn>\n")  # after the last marker an empty piece is left

    def one(piece: Column) -> Column:
        colon = F.locate(":", piece)
        role = F.substring(piece, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)
        body = F.substring(piece, colon + len(AFTER_ROLE), F.char_length(piece) - colon - len(AFTER_ROLE))
        return let(body, lambda b: F.when(~b.rlike(RAW), F.struct(read_role(role).alias("role"), unescape(b).alias("text"))))

    return F.transform(F.filter(pieces, lambda p: p != ""), one)


def conversations_as_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turns: array of struct(role, text) in order."""
    empty = F.lit("")
    rows = rows.select("conv_id", F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def written(turns: Column) -> Column:
    """struct(formatted, parsed): the first level of escaping at which the parser gives the turns back; null if none does."""

    def level(k: int) -> Column:
        def tried(formatted: Column) -> Column:
            return let(parse(formatted), lambda parsed: F.when(parsed.eqNullSafe(turns), F.struct(formatted.alias("formatted"), parsed.alias("parsed"))))

        return let(render(turns, k), tried)

    return F.coalesce(*[level(k) for k in range(LEVELS)])


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns (source), formatted, parsed (read back from it), loss (array of struct(start, length, text)).

    ``loss`` are the spans of the assistant's bodies in ``formatted``, in code points from 0, and the unescaped text under each.
    """
    wrong = F.raise_error(F.concat(F.lit("conversation doesn't read back as written: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    done = let(F.col("turns"), lambda t: let(written(t), lambda x: F.when(x.isNotNull(), F.struct(x["formatted"].alias("formatted"), x["parsed"].alias("parsed"), loss_spans(x["formatted"]).alias("loss")))))
    return conversations_as_turns(rows).select("conv_id", "turns", done.alias("x")).select("conv_id", "turns", F.when(F.col("x").isNull(), wrong).otherwise(F.col("x")).alias("x")).select("conv_id", "turns", "x.*")


def loss_spans(formatted: Column) -> Column:
    """Spans of assistant bodies and the text under them, found in the formatted text alone."""
    pieces = F.transform(
        F.filter(F.split(formatted, r"(?<!\\)</turn>\n"), lambda p: p != ""),
        lambda p: let(F.locate(":", p), lambda colon: F.struct(colon.alias("colon"), F.char_length(p).alias("size"), p.alias("piece"))),
    )
    step = len(CLOSE) - 1  # the piece keeps the line break before the marker
    assistant = OPEN + "assistant:"

    def spans(all_pieces: Column) -> Column:
        ends = let(F.transform(all_pieces, lambda p: p["size"] + step), running_sums)
        placed = F.arrays_zip(all_pieces.alias("p"), ends.alias("end"))
        on = F.filter(placed, lambda x: x["p"]["piece"].startswith(assistant))
        return F.transform(on, one)

    def one(x: Column) -> Column:
        p, end = x["p"], x["end"]
        length = p["size"] - p["colon"] - len(AFTER_ROLE)
        start = end - step - p["size"] + p["colon"] + len(AFTER_ROLE) - 1
        return F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), unescape(F.substring(p["piece"], p["colon"] + len(AFTER_ROLE), length)).alias("text"))

    return let(pieces, spans)


def running_sums(values: Column) -> Column:
    """Inclusive sums of an array, in one pass: an accumulator of (sum, list) would copy the list at every step."""
    half = F.lit(64)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(values) / half).cast("int")), lambda b: F.slice(values, b * half + 1, half))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def within(before: Column, block: Column) -> Column:
        return F.transform(block, lambda x, i: before + total(F.slice(block, 1, i + 1)))

    def joined(bs: Column) -> Column:
        return let(F.transform(bs, total), lambda totals: F.flatten(F.transform(bs, lambda block, b: let(total(F.slice(totals, 1, b)), lambda before: within(before, block)))))

    return let(blocks, joined)


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns, all from what was read back from the formatted text and its mask."""
    whole = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss", lambda s: s["text"]), "")
    made = let(
        masked,
        lambda m: F.struct(
            F.size("parsed").cast("long").alias("n_turns"),
            F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
            F.char_length(m).cast("long").alias("loss_chars"),
            F.sha2(m.cast("binary"), 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        ),
    )
    return formatted.select("conv_id", made.alias("x")).select("conv_id", "x.*")


#: The contract's extra conversation.
HARD = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD).alias("text"),
    )
    return digests(format_conversations(rows.unionByName(hard)))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, regexp_replace(text, '(### |</turn>)', '\\\1', 'g') AS body,
         length(role) + length(regexp_replace(role, '[^\\:#<]', '', 'g')) AS role_chars
  FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS masked,
         CAST(sum(15 + role_chars + length(body)) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(masked) AS BIGINT) AS loss_chars,
       sha256(masked) AS loss_sha256, formatted_chars
FROM g
"""
