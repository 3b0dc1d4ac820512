"""Chat formatting with a grammar round trip, in DataFrame operations only.

    conversation := turn*
    turn         := "<|turn|>" role [ "|%" ] NEWLINE body "<|end|>" NEWLINE

Each turn is rendered plainly and read again by the parser below. Where the parser does not give back the turn, or the
text holds any control string of common templates, the turn is rendered again with its body percent-escaped and its
header marked "|%". The finished conversation is parsed once more and compared to its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, MARK = "<|turn|>", "<|end|>\n", "|%"
# fixed values: control strings of common chat templates
CONTROLS = ["<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
_CODES = {"%": "%25", "<": "%3C", "[": "%5B"}
_ROLE_CODES = _CODES | {"|": "%7C", "\n": "%0A"}


def escaped(c: Column, codes: dict[str, str] = _CODES) -> Column:
    for plain, code in codes.items():
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescaped(c: Column, codes: dict[str, str] = _CODES) -> Column:
    for plain, code in reversed(codes.items()):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def _head(role: Column, marked: bool) -> Column:
    return F.concat(F.lit(START), escaped(role, _ROLE_CODES), F.lit(MARK if marked else ""), F.lit("\n"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text, escaped>> of a formatted string, read by the grammar alone."""

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        marked = F.endswith(head, F.lit(MARK))
        role = F.when(marked, F.expr("0") + F.length(head) - len(MARK)).otherwise(F.length(head))
        body = F.substring_index(F.substr(piece, F.length(head) + 2), END, 1)
        return F.struct(
            unescaped(F.substr(head, F.lit(1), role), _ROLE_CODES).alias("role"), F.when(marked, unescaped(body)).otherwise(body).alias("text"), marked.alias("escaped")
        )

    pieces = F.split(formatted, r"\Q" + START + r"\E")
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def _agrees(rendered: Column, role: Column, text: Column) -> Column:
    """Whether the parser finds exactly this turn, and no other ink, in a rendered turn."""
    found = parse(rendered)
    end = F.length(rendered) - F.length(F.replace(rendered, F.lit(END), F.lit("")))
    return F.coalesce((F.size(found) == 1) & (F.get(found, F.lit(0))["role"] == role) & (F.get(found, F.lit(0))["text"] == text) & (end == len(END)), F.lit(False))


def render(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, rendered, escaped and body_at (characters before the body) of each turn. A null role
    or text is empty; other columns are ignored."""
    t = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    plain = F.concat(_head(F.col("role"), False), F.col("text"), F.lit(END))
    control = F.lit(False)
    for c in CONTROLS:
        control = control | F.contains("text", F.lit(c))
    t = t.withColumn("_plain", plain).withColumn("escaped", control | ~_agrees(F.col("_plain"), F.col("role"), F.col("text")))
    head = F.when(F.col("escaped"), _head(F.col("role"), True)).otherwise(_head(F.col("role"), False))
    second = F.concat(_head(F.col("role"), True), escaped(F.col("text")), F.lit(END))
    return t.select("conv_id", "turn", "role", "text", F.when(F.col("escaped"), second).otherwise(F.col("_plain")).alias("rendered"), "escaped", F.length(head).alias("body_at"))


def format_conversations(turns: DataFrame, loss_role: str = "assistant", **cols: str) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans, identical.

    loss_spans are the characters [begin, end) of formatted under the loss mask, which are loss_role's bodies, with
    whether they are escaped. identical says that formatted parses back into the source. Turns are in the order of turn,
    ties in that of role and text; rows that repeat are turns of their own; an empty table gives no rows. A null id is a
    conversation of its own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = render(turns, **cols).withColumn("seq", F.row_number().over(order))
    t = t.withColumn("at", F.coalesce(F.sum(F.length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    body = F.col("at") + F.col("body_at")
    t = t.withColumn("span", F.struct(body.alias("begin"), (F.col("at") + F.length("rendered") - len(END)).alias("end"), "escaped"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seq", "role", "text", "rendered", "span"))).alias("t"))
    c = c.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join("t.rendered", "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["role"] == loss_role), lambda x: x["span"]).alias("loss_spans"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("_source"),
    )
    again = F.transform(parse(F.col("formatted")), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return c.withColumn("identical", again == F.col("_source")).drop("_source")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text, escaped) and loss_text, read from formatted and loss_spans alone."""

    def text(span: Column) -> Column:
        raw = F.substr(F.col("formatted"), (span["begin"] + 1).cast("int"), (span["end"] - span["begin"]).cast("int"))
        return F.when(span["escaped"], unescaped(raw)).otherwise(raw)

    return formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), F.array_join(F.transform("loss_spans", text), "").alias("loss_text"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    back = read_back(formatted)
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
