"""Chat formatting: a declarative template, a state machine over roles, loss flags by segment.

DataFrame operations only. A conversation becomes segments: for each turn what the template puts
before its text, the escaped text, and what it puts after. Only texts of roles with a loss flag are
under the loss mask. A state machine reads the roles in order and names the first turn that the
template's transitions do not allow; no conversation is dropped.

Every control string begins with ``<`` or ``[`` and has no other such character. In texts each
``<``, ``[`` and backslash is followed by an added backslash, so that no control string can occur in
them, and taking the backslash away gives the text back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MARKED = r"([<\[\\])"
_BREAK = r"(?=[<\[](?!\\))"


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Roles, what surrounds their texts, and which role may follow which state.

    A state is the role of the turn before; ``start`` is that of an empty conversation. Roles that
    the template lacks are written with the ``other`` pair, the role's name between its two parts.
    """

    roles: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("<SYS>", "</SYS>"),
            "user": Turn("[INST]", "[/INST]"),
            "assistant": Turn("<s>", "</s>", loss=True),
        }
    )
    other: tuple[str, str, str] = ("<ROLE>", "<TEXT>", "</ROLE>")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    ends: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED + r"\\", "$1")


def _by_role(role: Column, template: Template, value, other: Column) -> Column:
    out = other
    for name, turn in template.roles.items():
        out = F.when(role == name, value(turn)).otherwise(out)
    return out


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """turns(conv_id, turn, role, text, ...) -> (conv_id, n_turns, segments, formatted, valid, problem).

    A row for each conversation, its turns ordered by turn, then role and text, nulls first: ties and
    repeated rows all stay. segments: array of (text, loss). formatted: their texts, joined. Null
    texts and roles are empty strings; rows with a null conv_id form one conversation. problem: the
    first turn that breaks the order of roles (``turn 2: user after user``), an ending that the
    template does not allow (``ends with user``), or null. Other columns are ignored; an empty table
    gives an empty result. A conversation is one row by definition, so its whole text is held at once.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    open_, middle, close = template.other

    def parts(t: Column) -> Column:
        named = F.concat(F.lit(open_), escape(t.role), F.lit(middle))
        return F.array(
            F.struct(_by_role(t.role, template, lambda x: F.lit(x.before), named).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t.text).alias("text"), _by_role(t.role, template, lambda x: F.lit(x.loss), F.lit(False)).alias("loss")),
            F.struct(_by_role(t.role, template, lambda x: F.lit(x.after), F.lit(close)).alias("text"), F.lit(False).alias("loss")),
        )

    allowed = [F.concat(F.lit(a), F.lit(">"), F.lit(b)) for a, bs in template.follows.items() for b in bs]
    moves = F.array(*allowed)
    before = lambda i: F.when(i == 0, F.lit("start")).otherwise(F.get(F.col("turns.role"), i - 1))
    # the states of the machine are the roles passed, so each step is checked by its own pair of states
    broken = F.filter(
        F.transform("turns", lambda t, i: F.when(~F.array_contains(moves, F.concat(before(i), F.lit(">"), t.role)), F.concat(F.lit("turn "), i.cast("string"), F.lit(": "), t.role, F.lit(" after "), before(i)))),
        lambda x: x.isNotNull(),
    )
    last = F.element_at("turns.role", -1)
    ended = F.when(~last.isin(*template.ends), F.concat(F.lit("ends with "), last))
    out = chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.flatten(F.transform("turns", parts)).alias("segments"),
        F.coalesce(F.get(broken, F.lit(0)), ended).alias("problem"),
    )
    return out.select("conv_id", "n_turns", "segments", F.array_join("segments.text", "").alias("formatted"), F.col("problem").isNull().alias("valid"), "problem")


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """Formatted text -> array of (role, text), as they went in."""
    open_, middle, close = template.other
    tokens = F.filter(F.split(formatted, _BREAK), lambda p: p != "")
    begin = {turn.before: name for name, turn in template.roles.items()}

    def turn(p: Column) -> Column:
        out = F.lit(None).cast("struct<role:string,text:string>")
        for control, name in begin.items():
            out = F.when(p.startswith(control), F.struct(F.lit(name).alias("role"), unescape(F.substr(p, F.lit(len(control) + 1))).alias("text"))).otherwise(out)
        return out

    # a role that the template lacks takes two pieces: its name, then its text
    def piece(p: Column, i: Column) -> Column:
        after = F.get(tokens, i + 1)
        text = F.when(after.startswith(middle), unescape(F.substr(after, F.lit(len(middle) + 1)))).otherwise("")
        return F.when(p.startswith(open_), F.struct(unescape(F.substr(p, F.lit(len(open_) + 1))).alias("role"), text.alias("text"))).otherwise(turn(p))

    return F.filter(F.transform(tokens, piece), lambda t: t.isNotNull())


def digests(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Formatted conversations -> what reading their formatted text and loss mask back gives.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, problem)
    """
    back = chats.withColumn("back", read_back(F.col("formatted"), template)).withColumn(
        "under_loss", F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescape(s.text)), "")
    )
    whole = F.array_join(F.transform("back", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("under_loss").cast("long").alias("loss_chars"), F.sha2(F.col("under_loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid", "problem",
    )
