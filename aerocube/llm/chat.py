r"""Chat formatting with Spark expressions only.

A block is `### role: text</turn>` and a line end. Adjacent turns of one role share a block, with `<next/>` between their
texts. Inside roles and texts `\` becomes `\\`, and a `\` is put within `##`, `</turn>` and `<next/>`, so none of these
strings comes from a text; dropping each `\` but one that follows another restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns whose places are summed up at once.
STEP = 256
OPEN, NEXT, CLOSE = "### ", "<next/>", "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>")), F.lit("<next/>"), F.lit("<\\next/>"))
    return F.regexp_replace(text, "#(?=#)", "#\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: its id, `formatted`, and `loss`: (start, length) in code points of the texts to learn.

    Turns are sorted by turn (null first), ties by role and text. Null texts and roles are empty; very long texts stay
    whole; repeated rows are turns of their own. Each row whose conversation is null is a conversation by itself, so no group
    grows without bound. Only roles equal to `learn` are learnt, each text without its markers; `loss` counts escaped
    characters, and unescaping what it covers gives the texts. Other columns, of any name, don't matter; an empty
    table gives no rows.
    """
    empty = F.lit("")
    each = rows.select(F.col(conv).alias("__conv"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text")).alias("said"))
    turns = each.filter("__conv is not null").groupBy("__conv").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    turns = turns.unionByName(each.filter("__conv is null").select("__conv", F.array("said").alias("turns"))).withColumnRenamed("__conv", conv)

    def role_at(i: Column) -> Column:  # 0-based
        return F.get(F.col("turns"), i)["role"]

    def parts(t: Column, i: Column) -> Column:
        opens = (i == 0) | (role_at(i - 1) != t["role"])
        closes = F.coalesce(role_at(i + 1) != t["role"], F.lit(True))
        return F.struct(
            F.when(opens, F.concat(F.lit(OPEN), _role(t["role"]), F.lit(": "))).otherwise(F.lit(NEXT)).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(closes, F.lit(CLOSE)).otherwise(empty).alias("tail"),
            (t["role"] == learn).alias("learn"),
        )

    def starts(lengths: Column) -> Column:
        """Running sums before each element, in steps of STEP so that no array is copied for each turn."""
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP)), lambda k: F.slice(lengths, (k * STEP + 1).cast("int"), F.lit(STEP)))
        run = lambda xs: F.aggregate(xs, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all")), lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")))
        sums = F.transform(chunks, run)
        before = run(F.transform(sums, lambda s: s["at"]))["all"]
        return F.flatten(F.zip_with(sums, before, lambda s, b: F.transform(s["all"], lambda x: x + b)))

    def loss(parts: Column) -> Column:
        at = starts(F.transform(parts, lambda p: (F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])).cast("long")))
        spans = F.zip_with(parts, at, lambda p, a: F.struct(p["learn"].alias("learn"), (a + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("length")))
        return F.transform(F.filter(spans, lambda x: x["learn"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))

    return turns.withColumn("parts", F.transform("turns", parts)).select(
        F.col(conv),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        loss(F.col("parts")).alias("loss"),
    )


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    blocks = F.slice(F.split(formatted, CLOSE), 1, F.size(F.split(formatted, CLOSE)) - 1)
    head = r"(?s)^### ((?:[^\\:]++|\\.)*+): "

    def turns(block: Column) -> Column:
        role = F.regexp_extract(block, head, 1)
        body = F.substring(block, F.length(role) + len(OPEN) + 3, F.length(block))
        return F.transform(F.split(body, NEXT), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    made = format_chats(rows.unionByName(extra)).withColumn("turns", parse_chat(F.col("formatted")))
    learnt = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    line = F.lit("\n")
    return made.withColumn("learnt", learnt).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# the length of an escaped text
_LENGTH = r"(length({0}) + length({0}) - length(replace({0}, '\', '')) + (length({0}) - length(replace({0}, '</turn>', ''))) / 7 + (length({0}) - length(replace({0}, '<next/>', ''))) / 7 + coalesce(list_sum(list_transform(regexp_extract_all({0}, '##+'), lambda x: length(x) - 1)), 0))"
ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
  lag(coalesce(role, '')) OVER w AS before FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_LENGTH.format("text")} + CASE WHEN before = role THEN 7 ELSE 14 + {_LENGTH.format("role")} + length(role) - length(replace(role, ':', '')) END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
