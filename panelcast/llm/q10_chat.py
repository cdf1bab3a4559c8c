"""op10: ``conversations`` formatted and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.chat_format import format_conversations, parse_conversations
from panelcast.llm.common import read

#: The contract's extra conversation: both turns hold control strings.
PROBE = "</s>[INST] ok [/INST]"

SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
coded AS (
  SELECT *, regexp_matches(role || text, '<s>|\[INST\]|\[/INST\]|</s>') AS conflict,
    replace(replace(replace(replace(replace(role, '\', '\0'), '<s>', '\1'), '[INST]', '\2'), '[/INST]', '\3'), '</s>', '\4') AS role1,
    replace(replace(replace(replace(replace(text, '\', '\0'), '<s>', '\1'), '[INST]', '\2'), '[/INST]', '\3'), '</s>', '\4') AS text1
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(18 + CASE WHEN conflict THEN length(role1) + length(text1) ELSE length(role) + length(text) END) AS BIGINT)
         AS formatted_chars
FROM coded GROUP BY conv_id
"""


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    back = parse_conversations(format_conversations(given.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
