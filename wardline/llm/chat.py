"""Chat formatting (DataFrame functions only).

A declarative ``Template`` names, for each role, the text before and after a
turn and whether the turn's text carries loss.  A finite-state machine over the
roles validates the order of turns.  Texts are escaped so that no control
string of the template can occur inside them; ``read_back`` undoes it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``label`` of each known role and the roles under loss; a turn is
    ``open + label + sep + text + close``.  ``follows`` is the state machine:
    the roles that may come after a role ("" is the start); ``final`` the
    states in which a conversation may end."""

    open: str = "### "
    sep: str = ": "
    close: str = " </turn>\n"
    mark: str = "\\"
    labels: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: tuple = ("assistant",)
    follows: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant", "user")

    def escapes(self) -> list[tuple[str, str]]:
        """Control string -> escape, the mark itself first.  The controls are
        the parts of the markers without the spaces around them, so that a
        text's end and a marker cannot form one together."""
        controls = [self.mark, self.open.strip(), self.close.strip()]
        return [(c, self.mark + chr(ord("a") + i)) for i, c in enumerate(controls)]


def escape(text: Column, t: Template) -> Column:
    for control, code in t.escapes():
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescape(text: Column, t: Template) -> Column:
    """The inverse: in an escaped text every mark begins a code, so the codes
    can be undone one kind after another, the mark's own last."""
    for control, code in reversed(t.escapes()):
        text = F.replace(text, F.lit(code), F.lit(control))
    return text


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` -> one row per conversation:

    ``conv_id, formatted, segments array<struct<start, length, loss>>`` (code
    points of ``formatted``, in order and without gaps: marker, text, marker for
    each turn), ``n_turns, valid, first_error`` (the turn at which the state
    machine first refuses, -2 for a null turn, -1 if it only ends in a state that is
    not final, null if valid).

    Rows are ordered by turn, ties by role, then text; null turns come first.
    Null role or text counts as empty; unknown roles are kept under their own
    (escaped) name and refused by the state machine.  Repeated rows are turns
    of their own.  A null conv_id is a conversation like any other.  Extra
    columns are ignored.  Only one conversation's turns meet in a row.
    """
    t = template or Template()
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = F.create_map(*[F.lit(x) for kv in t.labels.items() for x in kv])
    # a role that is no label's key must not look like a label or hold a separator
    other = F.concat(F.lit("="), F.replace(escape(role, t), F.lit(t.sep.strip()), F.lit(t.mark + "z")))
    allowed = F.array(*[F.lit(f"{a}\n{b}") for a, bs in t.follows.items() for b in bs])
    rows = turns.select(
        "conv_id", "turn", role.alias("role"), F.concat(F.lit(t.open), F.coalesce(known[role], other), F.lit(t.sep)).alias("head"),
        escape(text, t).alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    size = F.char_length("head") + F.char_length("body") + F.lit(len(t.close))
    rows = rows.withColumns({
        "start": F.coalesce(F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")),
        # the machine's state is the last role, so each step can be judged by itself
        "refused": ~F.array_contains(allowed, F.concat(F.lag("role", 1, "").over(order), F.lit("\n"), F.col("role")))})
    conv = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "head", "body", "role"))).alias("rs"),
        F.min_by(F.coalesce("turn", F.lit(-2)), F.when(F.col("refused"), F.col("start"))).alias("refused"))
    ends = F.element_at("rs", -1)["role"].isin(*t.final)

    def part(start: Column, length: Column, loss: Column) -> Column:
        return F.struct(start.alias("start"), length.cast("long").alias("length"), loss.alias("loss"))

    def parts(r: Column) -> Column:
        head, body = F.char_length(r["head"]), F.char_length(r["body"])
        return F.array(part(r["start"], head, F.lit(False)), part(r["start"] + head, body, r["role"].isin(*t.loss)),
                       part(r["start"] + head + body, F.lit(len(t.close)), F.lit(False)))

    return conv.select(
        "conv_id", F.array_join(F.transform("rs", lambda r: F.concat(r["head"], r["body"], F.lit(t.close))), "").alias("formatted"),
        F.flatten(F.transform("rs", parts)).alias("segments"), F.size("rs").cast("long").alias("n_turns"),
        (F.col("refused").isNull() & ends).alias("valid"),
        F.when(F.col("refused").isNotNull(), F.col("refused")).when(~ends, F.lit(-1)).cast("long").alias("first_error"))


def read_back(formatted: Column, template: Template | None = None) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    t = template or Template()
    roles = F.create_map(*[F.lit(x) for k, v in t.labels.items() for x in (v, k)])
    blocks = F.filter(F.split(formatted, "\\Q" + t.close + "\\E"), lambda b: b != "")
    head = lambda b: F.substring_index(F.substr(b, F.lit(len(t.open) + 1)), t.sep, 1)
    return F.transform(blocks, lambda b: F.struct(
        F.coalesce(roles[head(b)], unescape(F.replace(F.substr(head(b), F.lit(2)), F.lit(t.mark + "z"), F.lit(t.sep.strip())), t)).alias("role"),
        unescape(F.substr(b, F.char_length(head(b)) + F.lit(len(t.open) + len(t.sep) + 1)), t).alias("text")))


def loss_text(formatted: Column, segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    t = template or Template()
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")), t)), "")
