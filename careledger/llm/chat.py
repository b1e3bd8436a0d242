r"""Operator 4: chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one
role are merged into one block, and the blocks are concatenated:

    user       [INST]text[/INST]
    assistant  [REPLY]text</s>
    system     [SYS]text[/SYS]
    any other  [ROLE]role[SAYS]text[/ROLE]     (a null role: [NOBODY]text[/ROLE])

Texts of one block are set apart by ``[AND]``, so the turns can be read back. A control
string inside a text (or role) gets a backslash after its first character, one more if it
has some already; reading back takes one away, so the escape is reversible.

The loss mask is a list of run lengths over the code points of the formatted string, one
run for each turn's control strings before its text (loss = false) and one for its text
(loss = true for an assistant's), and a last one for the closing control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

_NAMES = r"(?:/?INST|REPLY|/?SYS|/?ROLE|SAYS|NOBODY|AND)\]|/?s>"
_ESCAPE = rf"([\[<])(\\*)({_NAMES})"
_UNESCAPE = rf"([\[<])(\\*)\\({_NAMES})"
_CLOSE = r"\[/INST\]|</s>|\[/SYS\]|\[/ROLE\]"
_OPEN = r"\[INST\]|\[REPLY\]|\[SYS\]|\[NOBODY\]|\[ROLE\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _opens(role: Column) -> Column:
    return (F.when(role == "user", "[INST]").when(role == "assistant", "[REPLY]").when(role == "system", "[SYS]")
            .when(role.isNull(), "[NOBODY]").otherwise(F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[SAYS]"))))


def _closes(role: Column) -> Column:
    return F.when(role == "user", "[/INST]").when(role == "assistant", "</s>").when(role == "system", "[/SYS]").otherwise("[/ROLE]")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row (conv_id, formatted, mask) per conversation of ``turns`` (conv_id, turn, role, text; others are ignored).

    Rows go by turn, null first, then role and text; equal rows stay. A null text is empty, a null role a role of
    its own; rows of a null conv_id are one conversation. mask is an array of (length, loss). An empty table
    gives no rows.
    """
    rows = c.columns_of(turns, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    rows = rows.select("conv_id", F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t, i):
        before = F.element_at("turns", F.greatest(i, F.lit(1)))  # counted from 1; the first looks at itself
        same = before["role"].eqNullSafe(t["role"])
        starts = F.when(i == 0, _opens(t["role"])).when(same, "[AND]").otherwise(F.concat(_closes(before["role"]), _opens(t["role"])))
        return F.struct(starts.alias("control"), escaped(t["text"]).alias("text"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("loss"))

    chats = chats.select("conv_id", F.transform("turns", piece).alias("p"), _closes(F.element_at("turns", -1)["role"]).alias("end"))
    text = F.concat(F.array_join(F.transform("p", lambda p: F.concat(p["control"], p["text"])), ""), F.col("end"))
    run = lambda s, loss: F.struct(F.char_length(s).alias("length"), loss.alias("loss"))
    mask = F.flatten(F.transform("p", lambda p: F.array(run(p["control"], F.lit(False)), run(p["text"], p["loss"]))))
    return chats.select("conv_id", text.alias("formatted"), F.concat(mask, F.array(run(F.col("end"), F.lit(False)))).alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_texts) from (conv_id, formatted, mask) alone.

    turns are structs (role, text). loss_texts are the unescaped texts of the runs under the mask; run 2k + 1 is
    that of turn k, and a mask whose runs do not fit the string's is an error.
    """
    blocks = F.filter(F.split("formatted", f"(?<={_CLOSE})", -1), lambda b: b != "")

    def turns(block):
        named = F.regexp_extract(block, r"(?s)\A\[ROLE\](.*?)\[SAYS\]", 1)
        role = (F.when(block.startswith("[INST]"), "user").when(block.startswith("[REPLY]"), "assistant").when(block.startswith("[SYS]"), "system")
                .when(block.startswith("[NOBODY]"), F.lit(None)).otherwise(unescaped(named)))
        body = F.regexp_replace(block, rf"(?s)\A(?:\[ROLE\].*?\[SAYS\]|{_OPEN})|(?:{_CLOSE})\z", "")
        return F.transform(F.split(body, r"\[AND\]", -1), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text"), F.char_length(x).alias("length")))

    read = chats.withColumn("read", F.flatten(F.transform(blocks, turns)))
    read = read.withColumn("read", F.transform("read", lambda t, k: F.struct(
        t["role"].alias("role"), t["text"].alias("text"), F.get("mask", 2 * k + 1)["loss"].alias("loss"),
        (t["length"] == F.get("mask", 2 * k + 1)["length"]).alias("fits"))))
    fits = F.forall("read", lambda t: F.coalesce(t["fits"], F.lit(False))) & (F.size("mask") == 2 * F.size("read") + 1) & (
        F.aggregate("mask", F.lit(0), lambda s, m: s + m["length"]) == F.char_length("formatted"))
    loss = F.transform(F.filter("read", lambda t: t["loss"]), lambda t: t["text"])
    return read.select("conv_id", "formatted", F.transform("read", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
                       F.when(fits, loss).otherwise(F.raise_error(F.lit("the loss mask does not fit the formatted string"))).alias("loss_texts"))


def op4_chat_formatting(spark, sf_dir):
    rows = c.columns_of(c.read_table(spark, sf_dir, "conversations"), {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    test = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = read_back(format_chats(rows.union(test)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.char_length("formatted").cast("long").alias("formatted_chars"))


def oracle_sql() -> str:
    """The digests straight from the turns; the length of the formatted string from the template."""
    names = "(?:/?INST|REPLY|/?SYS|/?ROLE|SAYS|NOBODY|AND)\\]|/?s>"
    return f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, lag(role) OVER w AS p, row_number() OVER w AS k, lead(role) OVER w AS q, count(*) OVER (PARTITION BY conv_id) AS n
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)),
s AS (SELECT *, CASE WHEN k > 1 AND p IS NOT DISTINCT FROM role THEN 5
                     ELSE CASE role WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 WHEN 'system' THEN 5 ELSE 12 + length(role) END END
              + CASE WHEN k < n AND q IS NOT DISTINCT FROM role THEN 0
                     ELSE CASE role WHEN 'user' THEN 7 WHEN 'assistant' THEN 4 WHEN 'system' THEN 6 ELSE 7 END END
              + length(text) + len(regexp_extract_all(text, '[\\[<]\\\\*(?:{names})')) AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
