"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only that reply is
trainable. A conversation that does not end with an assistant turn has one example more, with nothing trainable, so that
the output holds every turn and can be read back.

A turn is written `<|turn|>ROLE\\nTEXT<|end|>`. In texts and roles `&` becomes `&amp;` and `<|` becomes `&lt;|`, in roles
a line feed becomes `&nl;`; no control string is then left in them, and reading replaces the same the other way round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE = "<|turn|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def format_turn(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(turn["role"]), F.lit("\n"), escape(turn["text"]), F.lit(CLOSE))


def prefix_target_examples(conversations: DataFrame) -> DataFrame:
    """From rows (conv_id, turn, role, text): a row for each assistant turn, with conv_id, example (from 0), trainable,
    formatted (context and target), loss_start and loss_end (in characters of formatted, the trainable reply with its
    escapes).

    Null texts and roles are taken as empty; a null conv_id is a conversation like others. Rows of equal conv_id and turn
    follow by role, then text; null turns come first. Repeated rows are turns of their own. Only conv_id, turn, role
    and text are read. A conversation is put together in one task, since each example needs all of its turns.
    """
    text, role = F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role")
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", role, text))).alias("t"))
    turns = turns.select(
        "conv_id",
        F.transform("t", format_turn).alias("formatted"),
        F.transform("t", lambda t: t["role"] == "assistant").alias("reply"),
        F.transform("t", lambda t: F.length(escape(t["text"]))).alias("length"),
    )
    last = F.size("reply")
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: F.get("reply", i - 1) | (i == last))
    one = turns.select("conv_id", "formatted", "reply", "length", F.posexplode(ends).alias("example", "end"))
    formatted = F.array_join(F.slice("formatted", F.lit(1), F.col("end")), "")
    one = one.select(
        "conv_id",
        F.col("example"),
        F.get("reply", F.col("end") - 1).alias("trainable"),
        F.get("length", F.col("end") - 1).alias("length"),
        formatted.alias("formatted"),
    )
    stop = F.length("formatted") - F.lit(len(CLOSE))
    return one.select(
        "conv_id",
        "example",
        "trainable",
        "formatted",
        F.when(F.col("trainable"), stop - F.col("length")).alias("loss_start"),
        F.when(F.col("trainable"), stop).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    parts = F.split(formatted, F.lit(r"\Q" + CLOSE + r"\E"))
    bodies = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text"),
        ),
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text"))
                    for i, r in enumerate(("user", "assistant"))
                )
            )
        )
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    examples = prefix_target_examples(rows)
    # Everything below is read back from the formatted texts: the turns from each conversation's longest, the replies
    # from the loss mask of each.
    target = unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select(
        "conv_id",
        "example",
        F.length("formatted").cast("bigint").alias("chars"),
        F.when(F.col("trainable"), target).alias("target"),
        "formatted",
    )
    per = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", "target"))).alias("targets"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("targets", lambda t: F.coalesce(t["target"], F.lit(""))), "")
    per = per.select("conv_id", "formatted_chars", read_turns(F.col("longest")).alias("turns"), loss.alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP5_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    8 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;')) + 1
      + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + 7 AS chars
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), prefixes AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS prefix_chars FROM turns
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(prefix_chars) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM prefixes GROUP BY conv_id
"""

QUERIES = {"op5_chat_formatting": op5_chat_formatting}
ORACLES = {"op5_chat_formatting": OP5_SQL}
