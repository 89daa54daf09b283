"""Repair of conversations by generalised LR parsing.

A role grammar is turned into an automaton of LR(0) items. Every turn may be kept, deleted or given another role,
and turns may be inserted; each choice is an edit with a cost. All stacks are followed side by side as one graph:
a node is a state above another node, so stacks share what lies below, and two stacks with equal tops are one,
which goes on with the least (cost, audit), the audit being the initials of the edits so far. The grammar is
left-recursive, so the graph stays small however long a conversation is, and the rows of a conversation pass by
in order: only its audit, a running digest per stack top and the digests of its turns are held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5  # what a truncated turn costs that stays
ROLES = {"u": "user", "a": "assistant"}  # what a turn can be made, or inserted as
LEGAL = {"su", "ua", "au"}
#: symbol: right-hand sides; a letter is a turn whose role begins with it
GRAMMAR = {"Talk": ((), ("Turns",), ("s", "Turns")), "Turns": (("Pair",), ("Turns", "Pair")), "Pair": (("u", "a"),)}

_PART = 4096  # letters of an audit held in one string
_INK = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


class Node(NamedTuple):
    """A stack: its top state, a set of (symbol, right-hand side, dot), and the node below."""

    state: frozenset
    below: Node | None


class Automaton:
    """Moves of stacks under a grammar whose first symbol is the start."""

    def __init__(self, grammar: dict = GRAMMAR):
        self.grammar, self.start = grammar, next(iter(grammar))
        self.follow = self._follow()
        self.bottom = Node(self._closed({(None, (self.start,), 0)}), None)
        self.shift = cache(self.shift)
        self.accepts = cache(self.accepts)

    def _first(self, symbol: str, seen: frozenset = frozenset()) -> set[str]:
        if symbol not in self.grammar:
            return {symbol}
        rest = seen | {symbol}
        return {t for rhs in self.grammar[symbol] if rhs and rhs[0] not in rest for t in self._first(rhs[0], rest)}

    def _follow(self) -> dict[str, set[str]]:
        """Letters (or "" for the end) that may come after each symbol."""
        after = {s: set() for s in self.grammar}
        after[self.start].add("")
        while True:
            size = sum(map(len, after.values()))
            for left, sides in self.grammar.items():
                for rhs in sides:
                    for i, s in enumerate(rhs):
                        if s in self.grammar:
                            after[s] |= after[left] if i + 1 == len(rhs) else self._first(rhs[i + 1])
            if size == sum(map(len, after.values())):
                return after

    def _closed(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            _, rhs, dot = todo.pop()
            for side in self.grammar.get(rhs[dot], ()) if dot < len(rhs) else ():
                if (item := (rhs[dot], side, 0)) not in items:
                    items.add(item)
                    todo.append(item)
        return frozenset(items)

    def _push(self, node: Node, symbol: str) -> Node | None:
        moved = {(left, rhs, dot + 1) for left, rhs, dot in node.state if dot < len(rhs) and rhs[dot] == symbol}
        return Node(self._closed(moved), node) if moved else None

    def _reduced(self, node: Node, ahead: str) -> Iterator[Node]:
        """The stack itself and what it may be reduced to before ``ahead``."""
        yield node
        for left, rhs, dot in node.state:
            if left is not None and dot == len(rhs) and ahead in self.follow[left]:
                under = node
                for _ in rhs:
                    under = under.below
                if (made := self._push(under, left)) is not None:
                    yield from self._reduced(made, ahead)

    def shift(self, node: Node, letter: str) -> tuple[Node, ...]:
        """Stacks after a turn whose role begins with ``letter``."""
        return tuple(n for r in self._reduced(node, letter) if (n := self._push(r, letter)) is not None)

    def accepts(self, node: Node) -> bool:
        return any((None, (self.start,), 1) in r.state for r in self._reduced(node, ""))


class Path(NamedTuple):
    """Of all ways to a stack the least; ``audit`` is cut into strings of _PART letters and compares as one."""

    cost: int
    audit: tuple[str, ...]
    told: object  # running digest of the repaired turns

    def edited(self, letter: str, more: int = 0) -> Path:
        head, tail = self.audit[:-1], self.audit[-1] + letter
        return Path(self.cost + COST[letter] + more, (*head, tail) if len(tail) < _PART else (*head, tail, ""), self.told)


class Conversation:
    """Repair of one conversation, fed turn by turn in order."""

    def __init__(self, rules: Automaton):
        self.rules = rules
        self.tops = {rules.bottom: Path(0, ("",), None)}
        self.seen: set[bytes] = set()
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.least = self.most = self.turn = None
        self.turns = 0
        self.initial: str | None = None
        self._insert()

    @staticmethod
    def _better(tops: dict, node: Node, path: Path) -> bool:
        held = tops.get(node)
        if held is None or (path.cost, path.audit) < (held.cost, held.audit):
            tops[node] = path
            return True
        return False

    @staticmethod
    def _told(path: Path, role: str, text: str) -> Path:
        told = path.told.copy() if path.told is not None else hashlib.sha256()
        told.update(f"{'' if path.told is None else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        return path._replace(told=told)

    def _insert(self) -> None:
        todo = list(self.tops)
        while todo:
            node = todo.pop()
            path = self.tops[node]
            for letter, role in ROLES.items():
                for up in self.rules.shift(node, letter):
                    made = path.edited(INSERT)
                    if self._better(self.tops, up, made):
                        self.tops[up] = self._told(made, role, "")
                        todo.append(up)

    def _fault(self, role: str, text: str) -> str | None:
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        again = mark in self.seen
        self.seen.add(mark)
        last = _LAST.search(text)
        if last is None:
            return "blank"
        return "duplicate" if again else None if last[1] in ".!?" else "truncated"

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.least = turn if self.least is None else min(self.least, turn)
            self.most = turn if self.most is None else max(self.most, turn)
            self.turns += turn != self.turn
            self.turn = turn
        if self.initial is not None:
            self.count["illegal"] += self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        fault = self._fault(role, text)
        if fault:
            self.count[fault] += 1
        made: dict[Node, Path] = {}
        roles: dict[Node, str | None] = {}
        more = TRUNCATED if fault == "truncated" else 0
        for node, path in self.tops.items():
            if self._better(made, node, path.edited(DELETE)):
                roles[node] = None
            if fault in ("blank", "duplicate"):
                continue
            ways = [(KEEP, role[:1], role), *((REROLE, letter, name) for letter, name in ROLES.items())]
            for edit, letter, name in ways:
                for up in self.rules.shift(node, letter):
                    if self._better(made, up, path.edited(edit, more)):
                        roles[up] = name
        self.tops = {n: p if roles[n] is None else self._told(p, roles[n], text) for n, p in made.items()}
        self._insert()

    def result(self) -> tuple:
        best = min((p for n, p in self.tops.items() if self.rules.accepts(n)), key=lambda p: (p.cost, p.audit))
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        told = (best.told or hashlib.sha256()).hexdigest()
        return gaps, *self.count.values(), best.cost, "".join(best.audit), told


_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, copy, gone) with faults put in by a checksum of conversation and turn.

    Of twenty equal shares one each is dropped (``gone``), emptied, stripped of its ``.!?``, said twice, and given
    to the user. A NULL counts as one space, in the checksum too. Dropped rows stay as marks, so no conversation
    vanishes; other columns are left out.
    """
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    name = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit(" ")) for c in (role_col, text_col))
    draw = F.crc32(name.cast("binary")) % 20
    plain = rows.select(conv.alias("conv"), turn.alias("turn"), role.alias("role"), text.alias("text"), draw.alias("draw"))
    return plain.select(
        "conv",
        "turn",
        F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, F.lit(""))
        .when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (F.col("draw") == 0).alias("gone"),
    )


def repair(rows: DataFrame, conv_col: str = "conv", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """One row per conversation: its id, gaps, faults by kind, illegal neighbours, cost, audit and a digest.

    Turns are read in the order of ``turn_col`` (NULL first), equal ones by role and text. A turn without ink is
    blank, else one whose role and text came before is a duplicate, else one that does not end in ``.!?`` is
    truncated; blank and duplicate turns have to go. ``audit`` has the initials of the cheapest edits (equal costs:
    the least text) after which the roles are an optional system turn and pairs of user and assistant, or nothing.
    Rows marked in ``gone_col`` count for nothing but the conversation's name. NULL roles and texts count as one
    space, a NULL id is a conversation of its own, repeated rows are duplicates, and an empty table gives none.

    Rows are dealt by conversation and sorted, then pass through the parser one at a time.
    """
    gone = F.lit(False) if gone_col is None else F.col(f"`{gone_col}`")
    kind = rows.schema[conv_col].dataType
    order = rows.select(
        F.col(f"`{conv_col}`").cast("string").alias("conv"),
        F.col(f"`{turn_col}`").alias("at"),
        *(F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))),
        gone.alias("gone"),
    )
    order = order.repartition("conv").sortWithinPartitions("conv", F.col("at").asc_nulls_first(), "role", "text")
    order = order.withColumn("at", F.col("at").cast("string"))  # pandas would turn whole numbers with NULLs into floats

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules, now, name = Automaton(), None, None
        for batch in batches:
            done = []
            for conv, at, role, text, gone in zip(*(batch[c] for c in ("conv", "at", "role", "text", "gone"))):
                if now is None or conv != name:
                    if now is not None:
                        done.append((name, *now.result()))
                    now, name = Conversation(rules), conv
                if not gone:
                    now.add(None if at is None else int(at), role, text)
            if done:
                yield pd.DataFrame(done, columns=["conv", *_COLUMNS])
        if now is not None:
            yield pd.DataFrame([(name, *now.result())], columns=["conv", *_COLUMNS])

    numbers = ", ".join(f"{c} bigint" for c in _COLUMNS[:6])
    made = order.mapInPandas(run, f"conv string, {numbers}, audit string, repaired_sha256 string")
    return made.withColumn("conv", F.col("conv").cast(kind)).withColumnRenamed("conv", conv_col)
