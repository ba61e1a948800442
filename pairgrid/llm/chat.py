"""Chat formatting that is checked by parsing the result.

Grammar of a formatted conversation, turn after turn without anything between:

    user       [INST] body [/INST]
    assistant  <s>body</s>
    others     <<ROLE:role>> body <</ROLE>>

A body has no control string of its own. Text that has some is escaped: one backslash
goes behind the first character of each control string, or of each that already has
backslashes there, so taking one away restores the text. A turn is first written as it
is and parsed; only where the parse does not give back its role and text is it written
escaped. The formatted conversation is then parsed as a whole and its turns compared to
the source by digest. All steps are SQL functions.

A conversation is one text, so its turns meet in one task; turns are rendered before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairgrid.llm.common import query, table

# Control strings of the template.
_CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\]|<ROLE:|</ROLE>>)"
_ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\]|<ROLE:|</ROLE>>)"
_TURN = r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>|<<ROLE:.*?>> .*? <</ROLE>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """As for text; a pair of closing angles is parted as well."""
    return F.regexp_replace(escape(role), r">(?=\\*>)", r">\\")


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r">\\(?=\\*>)", ">"))


def render(role: Column, text: Column) -> Column:
    """One turn, its parts taken as they are."""
    return (
        F.when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .otherwise(F.concat(F.lit("<<ROLE:"), role, F.lit(">> "), text, F.lit(" <</ROLE>>")))
    )


def parse_turn(turn: Column) -> Column:
    """role, text and clean of one rendered turn; clean is false where a body or role holds a control string."""
    body = (
        F.when(turn.startswith("[INST] "), F.substring(turn, F.lit(8), F.length(turn) - 15))
        .when(turn.startswith("<s>"), F.substring(turn, F.lit(4), F.length(turn) - 7))
        .otherwise(F.regexp_extract(turn, r"(?s)^<<ROLE:.*?>> (.*) <</ROLE>>$", 1))
    )
    role = F.when(turn.startswith("[INST] "), F.lit("user")).when(turn.startswith("<s>"), F.lit("assistant"))
    named = F.regexp_extract(turn, r"(?s)^<<ROLE:(.*?)>> ", 1)
    raw = r"[<\[](/?s>|/?INST\]|<ROLE:|</ROLE>>)"
    return F.struct(
        F.coalesce(role, unescape_role(named)).alias("role"),
        unescape(body).alias("text"),
        (~body.rlike(raw) & (role.isNotNull() | ~named.rlike(raw + "|>>"))).alias("clean"),
    )


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation in order."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), parse_turn)


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(role, F.lit("\n"), text, F.lit("\n"))


def render_checked(role: Column, text: Column) -> Column:
    """A turn as it is where parsing gives it back, and escaped elsewhere."""
    plain = render(role, text)
    back = parse(plain)
    same = (F.size(back) == 1) & back[0]["clean"] & (back[0]["role"] == role) & (back[0]["text"] == text)
    return F.when(F.coalesce(same, F.lit(False)), plain).otherwise(render(escape_role(role), escape(text)))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, formatted, loss_spans, parsed and round_trip of each conversation.

    Turns go by ``turn`` (nulls first), ties by role and rendered text; repeated rows
    are turns of their own. Null roles and texts are empty. Rows with a null id make one
    conversation. loss_spans has start (from 0) and length, in code points, of each
    assistant body within ``formatted``. round_trip says that the turns parsed from
    ``formatted`` equal the source's. Other columns are ignored; an empty table gives an
    empty table.
    """
    own = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rendered = own.select(
        "conv_id", "turn", "role", render_checked(F.col("role"), F.col("text")).alias("shown"), F.sha2(turn_text(F.col("role"), F.col("text")), 256).alias("sha")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "shown")
    placed = rendered.withColumns(
        {
            "at": F.row_number().over(order),
            "start": F.sum(F.length("shown")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("shown"),
        }
    )
    span = F.when(F.col("role") == "assistant", F.struct((F.col("start") + 3).alias("start"), (F.length("shown").cast("long") - 7).alias("length")))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "shown", "sha", span.alias("span")))).alias("turns"))
    joined = whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.transform("turns", lambda t: t["sha"]).alias("shas"),
    )
    back = joined.withColumn("parsed", parse(F.col("formatted")))
    again = F.transform("parsed", lambda t: F.sha2(turn_text(t["role"], t["text"]), 256))
    return back.withColumn("round_trip", (again == F.col("shas")) & F.forall("parsed", lambda t: t["clean"])).drop("shas")


_CONTROL_SQL = r"(<|\[)(\\*)(/?s>|/?INST\]|<ROLE:|</ROLE>>)"
OP9_SQL = rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL_SQL}'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 20 + length(role) END AS shown
  FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(shown)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, in order and unescaped: cut out of ``formatted`` by the spans alone."""
    cut = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(loss_spans, cut), "")


@query("op9_chat_round_trip", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation's turns, read back from the formatted text, and of the text under its loss mask.

    A conversation that doesn't read back as it was stops the query.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{hard}'), (-1L, 1L, 'assistant', '{hard}') AS t(conv_id, turn, role, text)")
    done = format_conversations(turns.unionByName(more))
    lost = F.raise_error(F.concat(F.lit("conversation does not read back: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    spoken = done.withColumn("spoken", F.when(F.col("round_trip"), loss_text(F.col("formatted"), F.col("loss_spans"))).otherwise(lost.cast("string")))
    return spoken.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("parsed", lambda t: turn_text(t["role"], t["text"])), ""), 256).alias("turns_sha256"),
        F.length("spoken").cast("long").alias("loss_chars"),
        F.sha2("spoken", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
