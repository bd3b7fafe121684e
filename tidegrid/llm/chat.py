"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, merged where neighbours have the
same role, and concatenated:

    <s>[ROLE]user[TEXT]...[PART]...[END][ROLE]assistant[TEXT]...[END]</s>

``[PART]`` stands between merged turns. Roles and texts are escaped: ``\\`` is doubled, and each of
``<``, ``>``, ``[`` and ``]`` becomes ``\\`` with a letter. So no control string of this template
or of the usual chat formats survives inside a text, and the output can be read back exactly.

Turns are formatted in blocks of a conversation first. The rows of a long conversation
spread over many tasks, and the second shuffle moves one string a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Control strings of the template.
BEGIN, ROLE, TEXT, PART, END, CLOSE = "<s>", "[ROLE]", "[TEXT]", "[PART]", "[END]", "</s>"
#: A sign of a text and its escaped form; the escape sign comes first.
ESCAPES = [("\\", "\\\\"), ("<", "\\l"), (">", "\\g"), ("[", "\\o"), ("]", "\\c")]


def escape(text: Column) -> Column:
    for sign, code in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """The text before :func:`escape`. Splitting at doubled signs first keeps codes from being read across them."""
    def plain(part: Column) -> Column:
        for sign, code in ESCAPES[1:]:
            part = F.replace(part, F.lit(code), F.lit(sign))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def _opening(role: Column) -> Column:
    return F.concat(F.lit(ROLE), role, F.lit(TEXT))


def _between(before: Column, role: Column) -> Column:
    """What stands between a turn and the next: nothing but a mark when the role stays."""
    return F.when(before == role, F.lit(PART)).otherwise(F.concat(F.lit(END), _opening(role)))


def _spans(items: Column, first_role: str, last_role: str, own: Column, at: Column) -> Column:
    """Byte ranges under the loss mask, moved from each item's start to the start of all."""
    start = F.struct(at.alias("at"), F.lit(None).cast("string").alias("role"),
                     F.array().cast("array<struct<begin:int,length:int>>").alias("spans"))

    def step(done: Column, item: Column) -> Column:
        gap = F.when(done["role"].isNull(), F.lit(0)).otherwise(
            F.octet_length(_between(done["role"], item[first_role])))
        begin = done["at"] + gap
        moved = F.transform(own(item), lambda s: F.struct((s["begin"] + begin).alias("begin"), s["length"]))
        return F.struct((begin + item["size"]).alias("at"), item[last_role].alias("role"),
                        F.concat(done["spans"], moved).alias("spans"))

    return F.aggregate(items, start, step)["spans"]


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant", block_turns: int = 256) -> DataFrame:
    """One row a conversation: its id, ``formatted``, and ``loss``, the byte ranges to train on.

    ``loss`` holds ``begin`` and ``length`` in the UTF-8 bytes of ``formatted`` for each text of
    ``loss_role``, in order, without control strings. Turns are ordered by ``turn_col``, nulls first;
    ties by role, then text; repeated rows all stay. A null text or role is empty. Rows
    without a conversation id form one conversation. Other columns are ignored. An empty
    table gives no rows. A conversation is one value, so 2 GB is its limit.
    """
    raw = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    blocks = raw.groupBy("conv", F.floor(F.col("turn") / block_turns).alias("block")).agg(sorted_turns.alias("t"))
    blocks = blocks.withColumn("t", F.transform("t", lambda x: F.struct(
        escape(x["role"]).alias("role"), escape(x["text"]).alias("text"),
        F.octet_length(escape(x["text"])).alias("size"), (x["role"] == loss_role).alias("loss"))))
    t = F.col("t")
    no_span = F.array().cast("array<struct<begin:int,length:int>>")
    blocks = blocks.select(
        "conv",
        F.struct(
            "block", t[0]["role"].alias("first"), F.element_at(t, -1)["role"].alias("last"),
            F.array_join(F.transform(t, lambda x, i: F.when(i == 0, x["text"]).otherwise(
                F.concat(_between(t[i - 1]["role"], x["role"]), x["text"]))), "").alias("body"),
            _spans(t, "role", "role",
                   lambda x: F.when(x["loss"], F.array(F.struct(F.lit(0).alias("begin"), x["size"].alias("length"))))
                   .otherwise(no_span), F.lit(0)).alias("spans")).alias("b"))
    blocks = blocks.withColumn("b", F.col("b").withField("size", F.octet_length("b.body")))
    b = F.col("b")
    opening = F.concat(F.lit(BEGIN), _opening(b[0]["first"]))
    return blocks.groupBy("conv").agg(F.sort_array(F.collect_list("b")).alias("b")).select(
        F.col("conv").alias(conv_col),
        F.concat(
            opening,
            F.array_join(F.transform(b, lambda x, i: F.when(i == 0, x["body"]).otherwise(
                F.concat(_between(b[i - 1]["last"], x["first"]), x["body"]))), ""),
            F.lit(END + CLOSE)).alias("formatted"),
        _spans(b, "first", "last", lambda x: x["spans"], F.octet_length(opening)).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text."""
    inner = F.substr(formatted, F.lit(len(BEGIN + ROLE) + 1),
                     F.length(formatted) - F.lit(len(BEGIN + ROLE + END + CLOSE)))
    runs = F.split(inner, r"\[END\]\[ROLE\]")

    def turns(run: Column) -> Column:
        role = F.substring_index(run, TEXT, 1)
        texts = F.split(F.substr(run, F.length(role) + F.lit(len(TEXT) + 1)), r"\[PART\]")
        return F.transform(texts, lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(runs, turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    raw = F.encode(formatted, "UTF-8")
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.decode(F.substr(raw, s["begin"] + 1, s["length"]), "UTF-8"))), "")
