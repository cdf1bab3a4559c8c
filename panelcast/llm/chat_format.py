"""Chat formatting by a grammar round trip, with DataFrame functions only.

Grammar of a formatted conversation, with four control strings:

    conversation = "<s>" turn*
    turn         = "[INST]" level role "[/INST]" text "</s>"
    level        = "0" | "1" | "2"

Each turn is rendered raw (level 0) and reparsed by a deterministic parser that
takes every control string it meets as control. If the recovered role and text
are not the source, the turn is rendered again with the control strings
replaced by codes (level 1, reversible as every backslash is coded too), and if
that should not be identical either, in hexadecimal (level 2). The formatted
conversation is reparsed as a whole on reading.

The loss mask is a list of spans (turn, start, length) of the formatted string,
one per assistant text, in code points.

Defined results: null role or text is empty; turns are ordered by turn number
(null first), then role, then text, repeated rows are repeated turns; a null
conversation id is a conversation; an empty table gives no conversation. One
conversation is one training record, so its turns meet in one row. Extra
columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (BEGIN, OPEN, CLOSE, END)
ANY_CONTROL = r"<s>|\[INST\]|\[/INST\]|</s>"
LOSS_ROLE = "assistant"


def escape(text: Column, level: int) -> Column:
    if level == 1:
        text = F.replace(text, F.lit("\\"), F.lit("\\0"))
        for i, control in enumerate(CONTROLS, 1):
            text = F.replace(text, F.lit(control), F.lit(f"\\{i}"))
    elif level == 2:
        text = F.hex(F.encode(text, "utf-8"))
    return text


def unescape(text: Column, level: Column) -> Column:
    """Inverse of ``escape``; the backslash comes last, so that no code is read twice."""
    coded = text
    for i, control in enumerate(CONTROLS, 1):
        coded = F.replace(coded, F.lit(f"\\{i}"), F.lit(control))
    coded = F.replace(coded, F.lit("\\0"), F.lit("\\"))
    return F.when(level == "1", coded).when(level == "2", F.decode(F.unhex(text), "utf-8")).otherwise(text)


def render_turn(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(OPEN + str(level)), escape(role, level), F.lit(CLOSE), escape(text, level), F.lit(END))


def parse_turn(rendered: Column) -> Column:
    """struct(level, role, text, start, length) of a rendered turn, null if it is
    not a sentence of the grammar; start and length place the stored text."""
    parts = F.split(rendered, ANY_CONTROL, -1)

    def build(p: Column) -> Column:
        level, role, text = F.substring(p[1], 1, 1), F.substr(p[1], F.lit(2)), p[2]
        again = F.concat(F.lit(OPEN), p[1], F.lit(CLOSE), text, F.lit(END))
        return F.when((F.size(p) == 4) & (again == rendered) & level.isin("0", "1", "2"), F.struct(
            level.alias("level"), unescape(role, level).alias("role"), unescape(text, level).alias("text"),
            (F.char_length(p[1]) + len(OPEN) + len(CLOSE)).cast("long").alias("start"),
            F.char_length(text).cast("long").alias("length")))

    return F.element_at(F.transform(F.array(parts), build), 1)


def format_turn(role: Column, text: Column) -> Column:
    """The first rendering whose reparse gives the source back."""
    def tried(level: int) -> Column:
        out = render_turn(role, text, level)
        back = parse_turn(out)
        return F.when((back["role"] == role) & (back["text"] == text), out)

    return F.coalesce(tried(0), tried(1), tried(2), F.raise_error(F.lit("a turn cannot be formatted")))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, loss): one formatted string per conversation and its loss mask."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = (turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
            .select("conv_id", "turn", role.alias("role"), text.alias("text"))
            .withColumn("rendered", format_turn(F.col("role"), F.col("text"))))
    spans = rows.withColumn("parsed", parse_turn(F.col("rendered"))).select(
        "conv_id", F.struct("turn", "role", "text", "rendered", F.col("parsed.start").alias("start"),
                            F.col("parsed.length").alias("length")).alias("t"))
    convs = spans.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    first = F.lit(len(BEGIN)).cast("long")
    empty = F.array().cast("array<struct<turn:int,start:bigint,length:bigint>>")
    state = F.struct(first.alias("at"), F.lit(0).alias("i"), empty.alias("spans"))

    def step(s: Column, t: Column) -> Column:
        span = F.struct(s["i"].alias("turn"), (s["at"] + t["start"]).alias("start"), t["length"].alias("length"))
        return F.struct((s["at"] + F.char_length(t["rendered"])).cast("long").alias("at"), (s["i"] + 1).alias("i"),
                        F.when(t["role"] == loss_role, F.concat(s["spans"], F.array(span)))
                        .otherwise(s["spans"]).alias("spans"))

    return convs.select(
        "conv_id", F.concat(F.lit(BEGIN), F.array_join(F.transform("ts", lambda t: t["rendered"]), "")).alias("formatted"),
        F.aggregate("ts", state, step, lambda s: s["spans"]).alias("loss"))


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted): turns (role, text) recovered from the
    formatted string, and the unescaped text under the loss mask."""
    body = F.substr(F.col("formatted"), F.lit(len(BEGIN) + 1))
    pieces = F.split(body, END, -1)
    whole = formatted.select("conv_id", "formatted", "loss", pieces.alias("pieces"))
    found = F.transform(F.slice("pieces", F.lit(1), F.size("pieces") - 1), lambda p: parse_turn(F.concat(p, F.lit(END))))
    parsed = whole.withColumn("found", found)
    ok = F.col("formatted").startswith(BEGIN) & (F.element_at("pieces", -1) == "") & ~F.exists("found", lambda t: t.isNull())
    parsed = parsed.withColumn("found", F.when(ok, F.col("found")).otherwise(
        F.raise_error(F.lit("not a formatted conversation"))))
    under = F.transform("loss", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")),
        F.get("found", s["turn"])["level"]))
    turns = F.transform("found", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return parsed.select("conv_id", turns.alias("turns"), F.array_join(under, "").alias("loss_text"), "formatted")
