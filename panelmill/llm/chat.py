"""Chat formatting by prefix-target expansion (operator 4, DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it are the
context, and the loss mask covers that reply alone. Turns after the last reply,
or a conversation without replies, give one more example without a target.

Control strings inside texts are defused by a ``~`` after their opening bracket;
one that is already followed by such signs gets one more, so taking one away
gives back the text, whatever it was.

Defined results: null text, role or turn sorts first and counts as empty; rows
that share a turn are ordered by role and text; repeated rows are repeated turns;
null conversation ids form one conversation; no rows give no rows; other columns
are ignored. The context of an example is as long as the method makes it, so a
conversation of n replies gives text in proportion to its n prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's marks, each role's opening and closing.
SYSTEM = ("<<SYS>>", "<</SYS>>")
USER = ("[INST] ", " [/INST]")
ASSISTANT = ("<s>", "</s>")
OTHER = ("<<ROLE>>", "<</ROLE>>")
OTHER_TEXT = "<<TEXT>>"
#: Everything in a text that could be read as a mark, after its opening bracket.
_MARK = r"/?s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(~*)({_MARK})", "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])~(~*)({_MARK})", "$1$2$3")


def _by_role(role: Column, system, user, assistant, other) -> Column:
    return (
        F.when(role == "user", user).when(role == "assistant", assistant).when(role == "system", system).otherwise(other)
    )


def opening(role: Column) -> Column:
    other = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER_TEXT))
    return _by_role(role, F.lit(SYSTEM[0]), F.lit(USER[0]), F.lit(ASSISTANT[0]), other)


def closing(role: Column) -> Column:
    return _by_role(role, F.lit(SYSTEM[1]), F.lit(USER[1]), F.lit(ASSISTANT[1]), F.lit(OTHER[1]))


def examples(turns: DataFrame) -> DataFrame:
    """Examples of conversations: conv_id, example, text, loss_start, loss_chars.

    ``loss_start`` counts code points from 0. ``example`` numbers the targets of
    a conversation in order; the one without a target has no loss.
    """
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn"), value("role").alias("role"), value("text").alias("text"))
    conv = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            t["role"].alias("role"),
            opening(t["role"]).alias("open"),
            escape(t["text"]).alias("body"),
            closing(t["role"]).alias("close"),
        ),
    )
    conv = conv.select("conv_id", parts.alias("parts"))
    last = F.size("parts")
    targets = F.filter(F.sequence(F.lit(1), last), lambda i: (F.element_at("parts", i)["role"] == "assistant") | (i == last))
    one = conv.select("conv_id", "parts", F.posexplode(targets).alias("example", "at"))
    render = lambda p: F.concat(p["open"], p["body"], p["close"])
    context = F.array_join(F.transform(F.slice("parts", F.lit(1), F.col("at") - 1), render), "")
    one = one.select("conv_id", "example", F.element_at("parts", F.col("at")).alias("p"), context.alias("context"))
    trained = F.col("p")["role"] == "assistant"
    return one.select(
        "conv_id",
        "example",
        F.concat("context", render(F.col("p"))).alias("text"),
        (F.length("context") + F.length(F.col("p")["open"])).cast("long").alias("loss_start"),
        F.when(trained, F.length(F.col("p")["body"])).otherwise(0).cast("long").alias("loss_chars"),
        trained.alias("has_target"),
    )


def parse(text: Column) -> Column:
    """Turns of a formatted text as an array of (role, text)."""
    marks = [SYSTEM[0], USER[0], ASSISTANT[0]]
    quoted = [m.replace("[", r"\[").replace("]", r"\]") for m in marks]
    ends = "|".join(m.replace("[", r"\[").replace("]", r"\]") for m in (SYSTEM[1], USER[1], ASSISTANT[1], OTHER[1]))
    pattern = rf"(?s)({'|'.join(quoted)}|{OTHER[0]}.*?{OTHER_TEXT})(.*?)({ends})"
    group = lambda k: F.regexp_extract_all(text, F.lit(pattern), F.lit(k))
    named = lambda m: F.substring(m, len(OTHER[0]) + 1, F.length(m) - len(OTHER[0]) - len(OTHER_TEXT))
    role = lambda m: (
        F.when(m == USER[0], "user").when(m == ASSISTANT[0], "assistant").when(m == SYSTEM[0], "system")
        .otherwise(unescape(named(m)))
    )
    return F.zip_with(group(1), group(2), lambda m, t: F.struct(role(m).alias("role"), unescape(t).alias("text")))


def digest(made: DataFrame) -> DataFrame:
    """Conversations read back from their examples: turns from the longest, losses from each."""
    loss = unescape(F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    reply = F.when(F.col("has_target"), F.struct("example", loss.alias("loss")))
    got = made.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("full"),
        F.array_sort(F.collect_list(reply)).alias("replies"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    got = got.withColumn("turns", parse(F.col("full")))
    got = got.withColumn("loss", F.array_join(F.transform("replies", lambda r: r["loss"]), ""))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: The conversation that the query adds has these roles, all with this text.
ADDED_ID, ADDED_ROLES, ADDED_TEXT = -7, ("user", "assistant"), "</s>[INST] ok [/INST]"


def op4_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    role = F.get(F.array(*map(F.lit, ADDED_ROLES)), F.col("id").cast("int"))
    added = spark.range(len(ADDED_ROLES)).select(
        F.lit(ADDED_ID).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(ADDED_TEXT).alias("text")
    )
    return digest(examples(turns.unionByName(added)))


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(text, '([<\[])(~*)(/?s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>)', '\1~\2\3', 'g'))
      + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 25 + length(role) END AS chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM e)
SELECT conv_id, CAST(max(n) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""
