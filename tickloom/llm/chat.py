"""Chat formatting with DataFrame functions only.

A formatted conversation is a row of groups, one for each run of turns with the same role:

    ### <role>:
    <text><next><text></turn>

Texts and roles are escaped, so that ``<`` and ``#`` (and in roles ``:``) only occur in the marks: a
backslash becomes ``\\b``, ``<`` ``\\l``, ``#`` ``\\h``, ``:`` ``\\c``. A conversation therefore splits at
its marks into the very turns it was made from, whatever they say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import col

# Fixed values of the template.
OPEN, AFTER_ROLE, NEXT, CLOSE = "### ", ":\n", "<next>", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
# Turns of a conversation that are collected together at first.
BLOCK_TURNS = 64


def escape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _ends(lengths: Column) -> Column:
    """The running sums of an array of numbers, 0 first."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(lengths, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def format_chats(
    turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), conv_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """One row per conversation: conv_id, text (formatted) and loss, the spans that are trained on.

    ``loss`` has start and length in code points, byte_start and byte_length in UTF-8, of each text
    of ``loss_roles``, in order and without marks. Turns are ordered by turn (null first), role and text, so
    ties and repeated rows have a place; adjacent turns of one role are merged into one group. Null roles and
    texts count as empty; a null conversation is one; an empty table gives no rows; other columns aren't read.

    Turns are collected by blocks of ``block_turns`` turn numbers and the blocks by conversation, so a
    conversation that holds a large part of all rows is sorted and escaped in many tasks, and only its
    finished blocks meet, in the one string that the result has for it anyway.
    """
    role = F.coalesce(col(turns, role_col), F.lit(""))
    text = F.coalesce(col(turns, text_col), F.lit(""))
    rows = turns.select(
        col(turns, conv_col).alias("conv_id"),
        F.floor(col(turns, turn_col) / block_turns).alias("block"),
        F.struct(
            col(turns, turn_col).alias("turn"), role.alias("role"), text.alias("plain"),
            role.isin(*loss_roles).alias("loss"), escape(role, ROLE_ESCAPES).alias("shown"), escape(text).alias("text"),
        ).alias("row"),
    )
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    # what stands before a turn: the last turn's role tells whether a new group begins
    def lead(x: Column, last: Column) -> Column:
        return F.when(x["role"] == last, F.lit(NEXT)).otherwise(
            F.concat(F.lit(CLOSE + OPEN), x["shown"], F.lit(AFTER_ROLE)))

    leads = F.transform("rows", lambda x, i: F.when(i == 0, F.lit("")).otherwise(
        lead(x, F.get(F.col("rows"), i - 1)["role"])))
    shown = F.zip_with("leads", "rows", lambda a, x: F.concat(a, x["text"]))
    blocks = blocks.withColumn("leads", leads)
    chars = F.transform(F.col("shown"), F.char_length)
    octets = F.transform(F.col("shown"), F.octet_length)
    # spans, counted from the end of the block's first lead
    spans = F.zip_with(
        F.zip_with("ends", "byte_ends", lambda c, b: F.struct(c.alias("c"), b.alias("b"))), "rows",
        lambda e, x: F.when(x["loss"], F.struct(
            (e["c"] - F.char_length(x["text"])).alias("start"), F.char_length(x["text"]).cast("long").alias("length"),
            (e["b"] - F.octet_length(x["text"])).alias("byte_start"),
            F.octet_length(x["text"]).cast("long").alias("byte_length"))))
    blocks = (
        blocks.withColumn("shown", shown)
        .withColumns({"ends": F.slice(_ends(chars), F.lit(2), F.size("rows")),
                      "byte_ends": F.slice(_ends(octets), F.lit(2), F.size("rows"))})
        .select(
            "conv_id",
            F.struct(
                "block", F.array_join("shown", "").alias("body"), F.col("rows")[0].alias("first"),
                F.element_at("rows", -1)["role"].alias("last"),
                F.filter(spans, lambda s: s.isNotNull()).alias("spans"),
                F.element_at("ends", -1).alias("chars"), F.element_at("byte_ends", -1).alias("octets"),
            ).alias("part"),
        )
        .withColumn("part", F.col("part").withField("first", F.struct(
            F.col("part.first.role").alias("role"), F.col("part.first.shown").alias("shown"))))
    )
    chats = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    heads = F.transform("parts", lambda p, i: F.when(
        i == 0, F.concat(F.lit(OPEN), p["first"]["shown"], F.lit(AFTER_ROLE))).otherwise(
        lead(p["first"], F.get(F.col("parts"), i - 1)["last"])))
    chats = chats.withColumn("heads", heads)
    bodies = F.zip_with("heads", "parts", lambda h, p: F.concat(h, p["body"]))
    # where each block's body begins
    starts = F.zip_with("heads", "parts", lambda h, p: F.char_length(h) + p["chars"])
    byte_starts = F.zip_with("heads", "parts", lambda h, p: F.octet_length(h) + p["octets"])
    chats = chats.withColumns({"ends": _ends(starts), "byte_ends": _ends(byte_starts)})
    loss = F.flatten(F.transform("parts", lambda p, i: F.transform(p["spans"], lambda s: F.struct(
        (s["start"] + F.get("ends", i) + F.char_length(F.get("heads", i))).alias("start"), s["length"].alias("length"),
        (s["byte_start"] + F.get("byte_ends", i) + F.octet_length(F.get("heads", i))).alias("byte_start"),
        s["byte_length"].alias("byte_length")))))
    return chats.select(
        "conv_id", F.concat(F.array_join(bodies, ""), F.lit(CLOSE)).alias("text"), loss.alias("loss"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted conversation, in order: an array of role and text."""
    groups = F.slice(F.split(text, CLOSE, -1), F.lit(1), F.size(F.split(text, CLOSE, -1)) - 1)

    def of(group: Column) -> Column:
        role = F.substring_index(F.substr(group, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)
        body = F.substr(group, F.lit(len(OPEN + AFTER_ROLE) + 1) + F.char_length(role))
        return F.transform(F.split(body, NEXT, -1), lambda t: F.struct(
            unescape(role, ROLE_ESCAPES).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(groups, of))


def read_loss(text: Column, loss: Column) -> Column:
    """The texts under the loss spans of a formatted conversation, one after the other."""
    octets = F.encode(text, "UTF-8")
    return F.array_join(F.transform(loss, lambda s: unescape(F.decode(
        F.substr(octets, (s["byte_start"] + 1).cast("int"), s["byte_length"].cast("int")), "UTF-8"))), "")
