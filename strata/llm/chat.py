"""Chat formatting: turns of conversations as text segments with loss flags, from a declarative template.

DataFrame functions only. A template names the control string that opens a role's turns, the one that closes a turn, the roles
whose texts are learnt, and a finite-state machine over roles. Control strings inside texts are broken by an escape character,
so that they stand in the output only where the template puts them, and the output can be read back.

Turns are handled in parts of ``PART`` turn numbers. The machine runs over each part from every state, which gives a map from states to
states; maps are composed in the order of the parts, some parts at a time, so that a long conversation is not one group.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers of a part, and parts whose maps are composed at a time.
PART = 256
#: The part of turns without a number, behind all others.
LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Template:
    """What a turn looks like: ``heads[role]``, a line break, the escaped text, ``tail``, a line break.

    A role without a head of its own is written as ``other[0]``, the escaped role, ``other[1]``. ``moves`` maps (state, role) to
    the next state; a turn without a move is refused. A conversation is valid if no turn is refused and it ends in ``final``.
    """

    heads: dict[str, str] = field(
        default_factory=lambda: {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}
    )
    other: tuple[str, str] = ("### Role:", "</role>")
    tail: str = "</turn>"
    escape: str = "\\"
    learnt: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    final: frozenset[str] = frozenset({"assistant"})
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def __post_init__(self):
        """Refuse control strings that could arise where a text meets one, or that one escape character would not break."""
        if len(set(self.controls)) < len(self.controls):
            raise ValueError("two control strings are equal")
        for c in self.controls:
            if len(c) < 2 or self.escape in c or "\n" in c or len(self.escape) != 1:
                raise ValueError(f"control string {c!r}: two characters at least, without line break or escape character")
            for d in self.controls:
                if c != d and c in d or any(c.endswith(d[:k]) for k in range(1, min(len(c), len(d)))):
                    raise ValueError(f"control strings {c!r} and {d!r} overlap")

    @property
    def controls(self) -> list[str]:
        return [*self.heads.values(), *self.other, self.tail]

    @property
    def states(self) -> list[str]:
        """All states, the first one first."""
        named = [s for (a, _), b in self.moves.items() for s in (a, b)]
        return list(dict.fromkeys([self.start, *named, *self.final]))

    def escaped(self, text: Column) -> Column:
        """The escape character goes before each of itself, and behind the first character of each control string."""
        within = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in self.controls)
        changed = F.regexp_replace(text, F.lit(f"(?={re.escape(self.escape)})|{within}"), F.lit(re.escape(self.escape)))
        touched = "[" + "".join(re.escape(c) for c in dict.fromkeys([self.escape, *(c[0] for c in self.controls)])) + "]"
        return F.when(text.rlike(touched), changed).otherwise(text)

    def unescaped(self, text: Column) -> Column:
        plain = F.regexp_replace(text, F.lit(f"(?s){re.escape(self.escape)}(.)"), F.lit("$1"))
        return F.when(F.contains(text, F.lit(self.escape)), plain).otherwise(text)

    def segments(self, role: Column, text: Column) -> Column:
        """The (text, loss) segments of a turn: what opens it, its text, what closes it."""
        head = F.concat(F.lit(self.other[0]), self.escaped(role), F.lit(self.other[1]))
        for name, control in self.heads.items():
            head = F.when(role == name, F.lit(control)).otherwise(head)
        opens, closes = F.concat(head, F.lit("\n")), F.lit(f"{self.tail}\n")
        parts = ((opens, F.lit(False)), (self.escaped(text), role.isin(*self.learnt)), (closes, F.lit(False)))
        return F.array(*[F.struct(t.alias("text"), loss.alias("loss")) for t, loss in parts])

    def turns(self, formatted: Column) -> Column:
        """The (role, text) turns that a formatted text holds."""
        closed = F.split(formatted, re.escape(f"{self.tail}\n"))
        named = "|".join(re.escape(c) for c in self.heads.values())
        pattern = f"(?s)^(?:({named})|{re.escape(self.other[0])}(.*?){re.escape(self.other[1])})\n(.*)$"

        def read(turn: Column) -> Column:
            role = self.unescaped(F.regexp_extract(turn, pattern, 2))
            for name, control in self.heads.items():
                role = F.when(F.startswith(turn, F.lit(f"{control}\n")), F.lit(name)).otherwise(role)
            return F.struct(role.alias("role"), self.unescaped(F.regexp_extract(turn, pattern, 3)).alias("text"))

        return F.transform(F.slice(closed, 1, F.size(closed) - 1), read)

    def machine(self, roles: Column) -> Column:
        """For each state, the (state, refused) that an array of roles leads to; ``refused`` is the number of the first refused
        turn, from 0, and NULL if there is none."""
        states = self.states
        names = list(dict.fromkeys(r for _, r in self.moves))
        table = F.array(*[
            F.lit(states.index(self.moves[s, r]) if (s, r) in self.moves else -1) for s in states for r in names
        ])
        columns = F.array(*map(F.lit, names))

        def step(at: Column, role: Column) -> Column:
            known = F.array_position(columns, role).cast("int")
            next_ = F.when(known == 0, -1).otherwise(F.get(table, at["state"] * len(names) + known - 1))
            go = at["refused"].isNull() & (next_ >= 0)
            refused = F.when(at["refused"].isNull() & (next_ < 0), at["n"]).otherwise(at["refused"])
            return F.struct(
                F.when(go, next_).otherwise(at["state"]).alias("state"), refused.alias("refused"), (at["n"] + 1).alias("n")
            )

        def run(s: int) -> Column:
            begin = F.struct(F.lit(s).alias("state"), F.lit(None).cast("long").alias("refused"), F.lit(0).cast("long").alias("n"))
            return F.aggregate(roles, begin, step, lambda end: F.struct(end["state"], end["refused"]))

        return F.array(*[run(i) for i in range(len(states))])


def format_conversations(
    rows: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, part, n_turns, segments, map): the formatted turns of each conversation, ``PART`` turn numbers in a row.

    ``segments`` are (text, loss), three a turn; their texts joined are the formatted text. ``map`` is the machine's over the part.
    Turns are ordered by number, those without one last, equal numbers by role and text; each row is a turn, copies too. NULL
    roles and texts count as empty, a NULL conversation is one like any other. Other columns are not read, and an empty table
    gives an empty one. Rows of one conversation with one turn number are one group.
    """
    template = template or Template()
    number = F.col(turn).cast("long")
    named, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    part = F.coalesce(F.floor(number / PART), F.lit(LAST)).alias("part")
    rows = rows.select(F.col(conv).alias("conv"), part, number.alias("turn"), named.alias("role"), said.alias("text"))
    rows = rows.withColumn("segments", template.segments(F.col("role"), F.col("text")))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "segments")))
    grouped = rows.groupBy("conv", "part").agg(turns.alias("turns"))
    return grouped.select(
        "conv",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten("turns.segments").alias("segments"),
        template.machine(F.col("turns.role")).alias("map"),
    )


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv, part, turns, learnt, n_chars) of formatted parts: (role, text) as the formatted text alone has them, the texts
    under the loss mask one after another, and the code points of the formatted text."""
    template = template or Template()
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("whole")
    learnt = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescaped(s["text"]))
    rows = formatted.select("conv", "part", whole, F.array_join(learnt, "").alias("learnt"))
    n_chars = F.length("whole").cast("long").alias("n_chars")
    return rows.select("conv", "part", template.turns(F.col("whole")).alias("turns"), "learnt", n_chars)


def verdicts(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv, valid, refused): whether the machine accepts each conversation, and the number of the first turn that it refuses.

    ``refused`` counts the conversation's rows from 0, and is NULL where no turn is refused.
    """
    template = template or Template()
    maps = formatted.select("conv", "part", "n_turns", "map")
    least, most = (x or 0 for x in formatted.where(F.col("part") < LAST).agg(F.min("part"), F.max("part")).first())
    while most - least >= PART:
        above = F.when(F.col("part") < LAST, F.floor(F.col("part") / PART)).otherwise(F.col("part")).alias("above")
        maps = _composed(maps.withColumn("above", above), ["conv", "above"]).withColumnRenamed("above", "part")
        least, most = least // PART, most // PART
    whole = _composed(maps, ["conv"])
    end = F.col("map")[0]
    final = [i for i, s in enumerate(template.states) if s in template.final]
    return whole.select("conv", (end["refused"].isNull() & end["state"].isin(*final)).alias("valid"), end["refused"].alias("refused"))


def _composed(maps: DataFrame, by: list[str]) -> DataFrame:
    """The maps of each group, one after another by part, as one map."""
    joined = maps.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("part", "n_turns", "map"))).alias("all"))

    def step(at: Column, one: Column) -> Column:
        states = F.transform(at["map"], lambda old: F.struct(
            F.when(old["refused"].isNotNull(), old["state"]).otherwise(one["map"][old["state"]]["state"]).alias("state"),
            F.coalesce(old["refused"], at["n"] + one["map"][old["state"]]["refused"]).alias("refused"),
        ))
        return F.struct((at["n"] + one["n_turns"]).alias("n"), states.alias("map"))

    begin = F.struct(F.col("all")[0]["n_turns"].alias("n"), F.col("all")[0]["map"].alias("map"))
    rest = F.slice("all", 2, F.size("all"))
    out = joined.withColumn("done", F.aggregate(rest, begin, step))
    return out.select(*by, F.col("done.n").alias("n_turns"), F.col("done.map").alias("map"))
