"""Chat formatting: a state machine over roles and a declarative template.

``segments`` gives one row per turn with its text segments and their loss flags
and whether the turn may follow the one before it; ``formatted`` joins the
segments of a conversation; ``read_back`` parses such a text into turns again.
Everything is column functions.

The state after a turn is its role, so the machine is a table of allowed
(previous role, role) steps and a set of final roles. Text is escaped so that no
control string can come from it: ``&`` becomes ``&amp;``, then ``<|`` becomes
``&lt;|``; a role's line end becomes ``&#10;``. Reading back undoes this.

Cases: a null text or role is empty; a null conversation id is one conversation;
turns are ordered by turn (null first), role, text, so ties and repeated rows
have a defined place and all count; no rows give no conversations; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TEMPLATE = {
    "open": "<|im_start|>",
    "role_end": "\n",
    "close": "<|im_end|>\n",
    "loss_roles": ["assistant"],
    "start": ["system", "user"],
    "steps": {"system": ["user"], "user": ["assistant"], "assistant": ["user", "tool"], "tool": ["assistant", "tool"]},
    "final": ["assistant"],
}


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))


def _segments(role: Column, text: Column, template: dict) -> Column:
    """Opening, body and closing of one turn; the loss falls on the body of learnt roles."""
    def part(value, loss):
        return F.struct(value.alias("text"), loss.alias("loss"))

    head = F.concat(F.lit(template["open"]), escape_role(role), F.lit(template["role_end"]))
    return F.array(part(head, F.lit(False)), part(escape(text), role.isin(template["loss_roles"])),
                   part(F.lit(template["close"]), F.lit(False)))


def _allowed(before: Column, role: Column, template: dict) -> Column:
    ok = before.isNull() & role.isin(template["start"])
    for state, following in template["steps"].items():
        ok = ok | ((before == state) & role.isin(following))
    return F.coalesce(ok, F.lit(False))


def segments(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, turn, role, segments [{text, loss}], allowed."""
    turns = _turns(conversations)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select(
        "conv_id", "turn", "role", _segments(F.col("role"), F.col("text"), template).alias("segments"),
        _allowed(F.lag("role").over(order), F.col("role"), template).alias("allowed"))


def formatted(conversations: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per conversation: its segments in order, the whole text, and the machine's verdict.

    A conversation is one value here, as its text is; ``segments`` keeps turns apart.
    """
    turns = _turns(conversations).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    steps = F.transform(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: _allowed(
        F.when(i > 0, F.get("turns", i - 1)["role"]), F.get("turns", i)["role"], template))
    parts = F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"], template)))
    return turns.select(
        "conv_id", parts.alias("segments"),
        (F.forall(steps, lambda x: x) & F.element_at("turns", -1)["role"].isin(template["final"])).alias("valid"),
    ).withColumn("text", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(text: Column, template: dict = TEMPLATE) -> Column:
    """Array of {role, text} out of a formatted text."""
    def turn(piece):
        role = F.substring_index(piece, template["role_end"], 1)
        begin = F.length(role) + len(template["role_end"]) + 1
        body = F.substring(piece, begin, F.length(piece) - begin + 1 - len(template["close"]))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    pieces = F.split(text, "\\Q" + template["open"] + "\\E")
    return F.transform(F.slice(pieces, 2, F.size(pieces)), turn)
