r"""Chat formatting by grammar round trip (operator 3, DataFrame functions only).

A turn is written ``<s>[role]text</s>``.  The parser is deterministic: cut at
each ``</s>``, take the role up to the first bare ``]``, and undo the escapes
(``\x`` stands for ``x``).  Every turn is first written as it is and parsed
back; where the recovered role or text differs from the source, the turn is
written with its control strings escaped.  The whole conversation is then parsed
again and compared, and should it still differ, all its turns are escaped.

Scale: turns are written and checked row by row, before grouping; one shuffle
brings a conversation's turns together, which the result, one text per
conversation, asks for.

Defined results: a null text or role is empty; turns order by turn, then role,
then text (nulls first), so ties and repeated rows have one order; rows with a
null ``conv_id`` form one conversation; extra columns are dropped; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import let, prepare, table

# Fixed values of the template.
OPEN, ROLE_END, CLOSE = "<s>[", "]", "</s>"
LOSS_ROLE = "assistant"
_ROLE = r"(?s)^<s>\[((?:[^\]\\]++|\\.)*+)\].*$"


def escape_text(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CLOSE), F.lit("<\\/s>"))


def escape_role(role: Column) -> Column:
    return F.replace(escape_text(role), F.lit(ROLE_END), F.lit("\\" + ROLE_END))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(ROLE_END), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""

    def turn(segment):
        return let(F.regexp_extract(segment, _ROLE, 1), lambda role: F.struct(
            unescape(role).alias("role"),
            unescape(F.substring(segment, F.char_length(role) + F.lit(len(OPEN) + len(ROLE_END) + 1),
                                 F.char_length(segment))).alias("text")))

    segments = F.split(formatted, CLOSE, -1)
    return let(segments, lambda s: F.transform(F.slice(s, F.lit(1), F.size(s) - 1), turn))


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_mask`` (one
    flag per turn of ``formatted``) and ``n_escaped`` (turns that needed it)."""
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    source = F.struct("role", "text")
    rows = rows.withColumn("raw", render(F.col("role"), F.col("text"))).withColumn(
        "escaped", render(escape_role(F.col("role")), escape_text(F.col("text"))))
    rows = rows.withColumn("same", parse(F.col("raw")) == F.array(source)).withColumn(
        "written", F.when(F.col("same"), F.col("raw")).otherwise(F.col("escaped")))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "written", "escaped", "same"))).alias("turns"))
    joined = turns.withColumn("formatted", F.array_join(F.col("turns.written"), ""))
    sources = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return joined.withColumn("whole", parse(F.col("formatted")) == sources).select(
        "conv_id",
        F.when(F.col("whole"), F.col("formatted")).otherwise(
            F.array_join(F.col("turns.escaped"), "")).alias("formatted"),
        F.transform("turns", lambda t: t["role"] == LOSS_ROLE).alias("loss_mask"),
        F.when(F.col("whole"), F.size(F.filter("turns", lambda t: ~t["same"]))).otherwise(
            F.size("turns")).alias("n_escaped"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    prepare(spark)
    clash = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(clash)
    read = format_conversations(rows).withColumn("turns", parse(F.col("formatted")))
    loss = F.array_join(F.transform(
        F.filter(F.arrays_zip("turns", "loss_mask"), lambda t: t["loss_mask"]), lambda t: t["turns"]["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


OP3_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, length(role) + length(t) + 9
             + CASE WHEN contains(t, '</s>') OR contains(role, '</s>') OR contains(role, ']')
                      OR regexp_matches(t, '(?s)\\.') OR contains(role, '\')
                    THEN length(t) - length(replace(t, '\', ''))
                       + (length(t) - length(replace(t, '</s>', ''))) // 4
                       + length(role) - length(replace(role, '\', ''))
                       + (length(role) - length(replace(role, '</s>', ''))) // 4
                       + length(role) - length(replace(role, ']', ''))
                    ELSE 0 END AS chars FROM r),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t) AS said,
             coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '') AS loss,
             sum(chars)::BIGINT AS formatted_chars FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
