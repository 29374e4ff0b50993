"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "<s>" head text "</s>"
    head         := "[INST]" | "[/INST]" | "[ROLE]" role "[/ROLE]"

for user, assistant and any other role. The parser is deterministic: it cuts
at every ``</s>``, takes off ``<s>`` and the head, and takes one backslash
out of every escaped control string. An escaped control string is one with
backslashes after its bracket, as in ``[\\INST]``; escaping puts one more in,
so it can be undone whatever the text held before.

Round trip: each turn is first rendered with its text as it is. The rendered
text is parsed again and compared with the source; where they differ (the
text holds a control string, escaped or not) its content is escaped,
rendered, parsed and compared anew. One escape is enough: after it no control
string stands in the content, and none can arise across a border, as every
control string has a bracket only at its start. The formatted conversation is
parsed as a whole once more, and ``identical`` says whether its turns are
the source's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import pick

#: A control string with any number of backslashes after its bracket.
ESCAPABLE = r"([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>)"
ESCAPED = r"([\[<])\\(\\*)(/?INST\]|/?ROLE\]|/?s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def render(role: Column, text: Column) -> Column:
    """One turn; role and text are already escaped where they need it."""
    head = F.when(role == "user", F.lit("[INST]")).when(role == "assistant", F.lit("[/INST]")) \
        .otherwise(F.concat(F.lit("[ROLE]"), role, F.lit("[/ROLE]")))
    return F.concat(F.lit("<s>"), head, text, F.lit("</s>"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns of a formatted conversation."""
    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(4), F.length(piece))     # after <s>
        named = F.substring(body, F.lit(7), F.length(body))      # after [ROLE]
        border = F.instr(named, "[/ROLE]")
        role = F.when(body.startswith("[INST]"), F.lit("user")) \
            .when(body.startswith("[/INST]"), F.lit("assistant")) \
            .otherwise(unescape(F.substring(named, F.lit(1), border - 1)))
        text = F.when(body.startswith("[INST]"), named) \
            .when(body.startswith("[/INST]"), F.substring(body, F.lit(8), F.length(body))) \
            .otherwise(F.substring(named, border + 7, F.length(named)))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    pieces = F.split(formatted, "</s>")
    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, identical), one row per conversation.

    Turns stand in the order of turn (null first), then role, then text, so
    ties have one result; repeated rows are turns of their own. A null text
    or role is empty; rows with a null conv_id are one conversation. An empty
    table gives an empty result; other columns are ignored.

    A conversation is one output string, so its turns meet in one row; they
    are gathered by partial aggregation.
    """
    rows = pick(turns, conv_id="long", turn="long", role="string", text="string").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    source = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    plain = render(F.col("role"), F.col("text"))
    known = F.col("role").isin("user", "assistant")
    escaped = render(F.when(known, F.col("role")).otherwise(escape(F.col("role"))), escape(F.col("text")))
    rows = rows.withColumn("rendered", F.when(parse(plain) == source, plain).otherwise(escaped))
    whole = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("t"))
    formatted = F.array_join(F.col("t.rendered"), "")
    return whole.select("conv_id", F.size("t").cast("long").alias("n_turns"), formatted.alias("formatted"), "t") \
        .withColumn("identical", parse(F.col("formatted")) == F.transform(
            "t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))) \
        .drop("t")


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted text. The loss
    mask covers the text of assistant turns."""
    parsed = formatted.withColumn("turns", parse(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["role"] == "assistant"), lambda x: x["text"]), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return parsed.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                         sha(said).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                         sha(loss).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


#: The contract's columns in DuckDB, over the conversations and conversation -1.
ORACLE_SQL = r"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>)', '\1\\\2\3', 'g') AS etext,
         regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>)', '\1\\\2\3', 'g') AS erole
  FROM rows),
turns AS (
  SELECT *, 7 + length(etext) + CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 ELSE 13 + length(erole) END AS n
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
