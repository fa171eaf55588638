"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is written as its turns in order, each ``<s>[INST]role[/INST]text</s>``. The
parser is deterministic: a turn is ``<s>[INST]``, the role up to the next ``[/INST]``, the
text up to the next ``</s>``; neither may hold a control string; escapes are undone last.
Each turn is first rendered as it is and parsed again. If the parse does not give back the
very role and text, its content is escaped: the escape sign becomes sign + ``e`` and each
control string sign + its number, which no text can then be mistaken for. The parse of
the escaped turn is compared again and a difference stops the job, so what is written
always reads back identical.

The loss mask covers the texts of ``loss_role``. ``loss_spans`` gives them as 0-based
(start, length) in code points of the formatted string; they come from a running sum over
the turns, so a long conversation costs no more per turn than a short one.

Defined results: a null text or role is empty; turns are ordered by turn (null first), then
by role and text as given; repeated rows are repeated turns; a null conv_id is one
conversation, and a conversation -1 of the data takes the probe's turns too. A conversation
becomes one string, so it has to fit a row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The control strings of the template, numbered from 1 in escapes.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
SIGN = "␛"
TURN = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"
_ANY = r"<s>|</s>|\[INST\]|\[/INST\]"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit(SIGN), F.lit(SIGN + "e"))
    for i, s in enumerate(CONTROL, 1):
        c = F.replace(c, F.lit(s), F.lit(f"{SIGN}{i}"))
    return c


def unescape(c: Column) -> Column:
    for i, s in enumerate(CONTROL, 1):
        c = F.replace(c, F.lit(f"{SIGN}{i}"), F.lit(s))
    return F.replace(c, F.lit(SIGN + "e"), F.lit(SIGN))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<s>[INST]"), role, F.lit("[/INST]"), text, F.lit("</s>"))


def _reads_back(role: Column, text: Column, as_role: Column, as_text: Column) -> Column:
    """Does the parse of the turn written with ``as_role`` and ``as_text`` give role and text?"""
    written = _rendered(as_role, as_text)
    return ((F.regexp_extract(written, TURN, 0) == written)
            & (unescape(F.regexp_extract(written, TURN, 1)) == role) & (unescape(F.regexp_extract(written, TURN, 2)) == text)
            & ~as_role.rlike(_ANY) & ~as_text.rlike(_ANY))


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans) of ``conversations`` (conv_id, turn, role, text)."""
    rows = conversations.select(
        "conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    role, text = F.col("role"), F.col("text")
    checked = rows.withColumn("plain", _reads_back(role, text, role, text))
    checked = checked.withColumns({"r": F.when(F.col("plain"), role).otherwise(escape(role)), "t": F.when(F.col("plain"), text).otherwise(escape(text))})
    checked = checked.withColumn("t", F.when(F.col("plain") | _reads_back(role, text, F.col("r"), F.col("t")), F.col("t")).otherwise(
        F.raise_error(F.lit("a turn does not read back"))))
    turns = checked.select("conv_id", "turn", "role", "text", "r", "t", (role == loss_role).alias("loss"))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    ahead = len("<s>[INST][/INST]")
    turns = turns.withColumn("n", F.row_number().over(before)).withColumn("start", F.coalesce(
        F.sum(F.length("r") + F.length("t") + ahead + len("</s>")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    span = F.struct((F.col("start") + F.length("r") + ahead).cast("long").alias("start"), F.length("t").cast("long").alias("length"))
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("n", _rendered(F.col("r"), F.col("t")).alias("w"), F.when(F.col("loss"), span).alias("span")))).alias("turns"))
    return whole.select("conv_id", F.concat_ws("", F.col("turns.w")).alias("formatted"),
                        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    def texts(group):
        return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(group)), unescape)

    return F.transform(F.arrays_zip(texts(1).alias("role"), texts(2).alias("text")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted strings (conv_id, formatted, loss_spans) read
    back as. The loss columns are cut out of the string by the mask: a span that starts at no
    turn's text, or has another length, shows in them."""
    ahead = len("<s>[INST][/INST]")
    turns = formatted.select("conv_id", F.length("formatted").cast("long").alias("chars"),
                             F.posexplode(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0))).alias("n", "w"))
    before = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("head", F.length(F.regexp_extract("w", TURN, 1)) + ahead).withColumn(
        "start", (F.coalesce(F.sum(F.length("w")).over(before), F.lit(0)) + F.col("head")).cast("long"))
    mask = formatted.select(F.col("conv_id").alias("of"), F.explode("loss_spans").alias("s")).select("of", F.col("s.start").alias("at"), F.col("s.length").alias("length"))
    read = turns.join(mask, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("start") == F.col("at")), "left")
    role, text = (unescape(F.regexp_extract("w", TURN, g)) for g in (1, 2))
    loss = unescape(F.substring("w", F.col("head") + 1, F.col("length").cast("int")))
    whole = read.groupBy("conv_id").agg(F.max("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct(
        "n", F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("said"), F.coalesce(loss, F.lit("")).alias("loss")))).alias("turns"))
    said, loss = (F.concat_ws("", F.col(f"turns.{c}")) for c in ("said", "loss"))
    return whole.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


PROBE = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and one more, -1, whose texts are made of control strings."""
    spark = conversations.sparkSession
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


def oracle() -> str:
    """DuckDB SQL for the digests of all conversations and the probe."""
    def escaped(c):
        c = f"replace({c}, '{SIGN}', '{SIGN}e')"
        for i, s in enumerate(CONTROL, 1):
            c = f"replace({c}, '{s}', '{SIGN}{i}')"
        return c

    odd = " OR ".join(f"contains({c}, '{s}')" for c in ("role", "text") for s in [*CONTROL, *(SIGN + x for x in "e1234")])
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{PROBE}' FROM range(2) t(i)),
 e AS (SELECT *, 20 + CASE WHEN {odd} THEN length({escaped('role')}) + length({escaped('text')}) ELSE length(role) + length(text) END AS chars FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
