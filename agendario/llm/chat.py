"""Chat formatting by prefix-target expansion, in column expressions only.

Every assistant turn becomes an example of its own: all preceding turns are its context and
only that reply is trainable. A conversation that does not end with an assistant turn yields one
more example without a target, so that no turn is lost.

Format of an example: ``prompt`` is the rendered context followed by the opening of the reply;
``target`` is the escaped reply and its end mark; the loss mask covers ``target`` up to the end
mark. A turn is ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>``. Control strings inside
roles and texts are escaped by a backslash after their first character, and a backslash by
doubling it, so that ``unescape`` restores every text exactly.

Defined cases: null role or text counts as empty; turns are ordered by (turn, role, text), null
first; repeated rows and ties stay, in that order; a null ``conv_id`` is one conversation of its
own; an empty table gives no rows; extra columns are ignored. A conversation is one row while it
is formatted, so it must fit in a task: its rendered turns are a sequence that no key can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: What a text may not hold as it is: this template's marks and those of common others.
CONTROL = (START, SEP, END, "<|endoftext|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    """Reversible: a backslash is doubled, a control string gets one after its first character."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expand(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text): conv_id, example, prompt, target.

    ``example`` counts from 0 within a conversation; ``target`` is null where nothing is trainable.
    """
    row = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    by_conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    rendered = by_conv.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == "assistant").alias("replies"),
        F.transform("turns", lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(SEP))).alias("heads"),
        F.transform("turns", lambda t: F.concat(escape(t["text"]), F.lit(END))).alias("bodies"),
    )
    n = F.size("heads")
    places = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("replies", i - 1) | (i == n))
    at = rendered.select("conv_id", "replies", "heads", "bodies", F.posexplode(places).alias("example", "at"))
    whole = F.zip_with(F.slice("heads", 1, F.col("at") - 1), F.slice("bodies", 1, F.col("at") - 1), lambda h, b: F.concat(h, b))
    head, body = F.get("heads", F.col("at") - 1), F.get("bodies", F.col("at") - 1)
    reply = F.get("replies", F.col("at") - 1)
    return at.select(
        "conv_id",
        "example",
        F.concat(F.array_join(whole, ""), head, F.when(reply, F.lit("")).otherwise(body)).alias("prompt"),
        F.when(reply, body).alias("target"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, in order: array of (role, text)."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(p, SEP, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(p, SEP, -1), END, 1)).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation, what its examples say when they are read back."""
    loss = unescape(F.substring_index("target", END, 1))
    size = F.length("prompt") + F.coalesce(F.length("target"), F.lit(0))
    whole = F.concat(F.col("prompt"), F.coalesce(F.col("target"), F.lit("")))
    per = examples.groupBy("conv_id").agg(
        F.max_by(whole, "example").alias("longest"),
        F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("example", loss.alias("loss"))))).alias("losses"),
        F.sum(size.cast("long")).alias("formatted_chars"),
    )
    read = per.select("conv_id", "formatted_chars", read_turns(F.col("longest")).alias("turns"), F.array_join("losses.loss", "").alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(
        """SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(p AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0, 'user'), (1, 'assistant') AS t(p, role)"""
    )
    return digest(expand(turns.unionByName(added)))


def _sql_escape(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for mark in CONTROL:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length({_sql_escape("role")}) + length({_sql_escape("text")}) + {len(START) + len(SEP) + len(END)} AS size FROM t
), s AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY p) AS upto FROM r
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR p = n) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id"""
