"""Operator 12, repair of conversation structure by a generalised LR parse with weighted edits.

Roles are terminals s, u and a (the role's first character) of the grammar RULES, whose language is ``(s?(ua)+)?``. The SLR table is made from
the rules. The parser keeps every stack that the turns so far allow: a stack is a linked list whose
tail is shared with other stacks, and where two stacks have become equal only the one of the smaller (cost,
audit) stays. Between two turns it may insert a user or an assistant, and a turn is kept, given
another role or deleted; an edit is pushed through the table (all reductions, then the shift) like a turn. Which of several conflicting actions is
right isn't decided early: all are followed.

The audit holds an edit's initial for each edit (K, R, D, I), in order; of repairs of equal cost the least in ASCII wins. As
audits at a turn all hold as many letters other than I as turns were read and end in one of them, none is a part at the front of another. So a live audit needs only
its rank among the live ones, not its text, and what a turn does to all live stacks depends on their shape (stacks, relative costs, in
the order of audits) and on the turn's class alone: each such step is made once and then looked up.

Rows are dealt by conversation and read in order of turns as a stream: a task holds, for one conversation, a few
stacks with a running SHA-256 each and the audit (linked pieces of text, a byte a turn), never its turns. A very long
conversation still is one task's stream: a SHA-256 over its text can't be split. Earlier
occurrences of a role and text are found by a window before, not by a set in memory.

Cases: a null conv_id is a conversation of its own; a null in role or text counts as one space, and so in the text
that is hashed for the damage; rows of one turn are taken by role and text; null turns come first and count for no gap; a role that starts with another letter than s, u
or a can't be kept, nor can an empty one; an empty table gives no rows; other columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RULES = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
START, TERMINALS, END = "S", "sua", "$"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
#: A stack that costs more than this above the cheapest can't win: the cheapest comes to the same roles by two inserts at most and, once, by deleting a system turn.
LAG_MOST = 2 * INSERT + DELETE
#: After so many turns the ends of live audits become links, which stacks share.
SETTLE = 512
OUT = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles string, repaired_sha256 string"

# ---- the grammar's table


def _closure(items: frozenset) -> frozenset:
    """Items (rule, dot) with all rules of the symbols after their dots; rule -1 is the start."""
    out, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        body = START if rule < 0 else RULES[rule][1]
        for i, (head, _) in enumerate(RULES):
            if dot < len(body) and body[dot] == head and (i, 0) not in out:
                out.add((i, 0))
                todo.append((i, 0))
    return frozenset(out)


def _firsts_and_follows() -> dict[str, set[str]]:
    heads = {h for h, _ in RULES}
    first, follow = {h: set() for h in heads}, {h: set() for h in heads}
    follow[START].add(END)

    def of(body: str) -> set[str]:
        found = set()
        for x in body:
            own = first.get(x, {x})
            found |= own - {""}
            if "" not in own:
                return found
        return found | {""}

    before = None
    while before != (now := (sum(map(len, first.values())), sum(map(len, follow.values())))):
        before = now
        for head, body in RULES:
            first[head] |= of(body)
            for i, x in enumerate(body):
                if x in heads:
                    rest = of(body[i + 1 :])
                    follow[x] |= (rest - {""}) | (follow[head] if "" in rest else set())
    return follow


@lru_cache(1)
def table() -> tuple[list[dict[str, int]], list[dict[str, list[int]]], list[bool]]:
    """Of each state: where a symbol leads, the rules to reduce by before a terminal, and whether the start is complete."""
    follow = _firsts_and_follows()
    states = [_closure(frozenset({(-1, 0)}))]
    goto: list[dict[str, int]] = []
    for state in states:  # grows on the way
        moves: dict[str, set] = {}
        for rule, dot in state:
            body = START if rule < 0 else RULES[rule][1]
            if dot < len(body):
                moves.setdefault(body[dot], set()).add((rule, dot + 1))
        goto.append({})
        for symbol, items in sorted(moves.items()):
            new = _closure(frozenset(items))
            if new not in states:
                states.append(new)
            goto[-1][symbol] = states.index(new)
    reduce = [{t: [r for r, dot in sorted(state) if r >= 0 and dot == len(RULES[r][1]) and t in follow[RULES[r][0]]] for t in TERMINALS + END} for state in states]
    return goto, reduce, [(-1, 1) in state for state in states]


# ---- stacks: (state, rest), the rest shared

ROOT = (0, None)


@lru_cache(None)
def _reduced(stack: tuple, ahead: str) -> frozenset:
    """The stack and all that reductions before the terminal ``ahead`` make of it."""
    goto, reduce, _ = table()
    out, todo = {stack}, [stack]
    while todo:
        top = todo.pop()
        for rule in reduce[top[0]][ahead]:
            head, body = RULES[rule]
            under = top
            for _ in body:
                under = under[1]
            to = goto[under[0]].get(head)
            if to is not None and (new := (to, under)) not in out:
                out.add(new)
                todo.append(new)
    return frozenset(out)


@lru_cache(None)
def _shifted(stack: tuple, terminal: str) -> tuple:
    goto = table()[0]
    return tuple(sorted(((goto[x[0]][terminal], x) for x in _reduced(stack, terminal) if terminal in goto[x[0]]), key=repr))


@lru_cache(None)
def _accepts(stack: tuple) -> bool:
    return any(table()[2][x[0]] for x in _reduced(stack, END))


@lru_cache(None)
def _inserted(stack: tuple) -> tuple:
    """(stack, cost, letters, roles) reached by inserts alone, the cheapest of each stack, none of them included."""
    best, todo = {stack: (0, "", "")}, [stack]
    while todo:
        now = todo.pop(0)
        cost, letters, roles = best[now]
        for t in "ua":
            for new in _shifted(now, t):
                if new not in best or best[new][:2] > (cost + INSERT, letters + "I"):
                    best[new] = (cost + INSERT, letters + "I", roles + t)
                    todo.append(new)
    return tuple((k, *v) for k, v in best.items())


Shape = tuple  # of (stack, cost less the least cost), in the order of their audits


@lru_cache(None)
def step(shape: Shape, initial: str, must_go: bool, truncated: bool) -> tuple[Shape, int, tuple]:
    """The shape after a turn, what the least cost rose by, and for each of its stacks: the place of the one it came from, its letters, the roles inserted and the turn's own (empty: deleted)."""
    best: dict[tuple, tuple] = {}
    for place, (stack, base) in enumerate(shape):
        for ready, cost, letters, roles in _inserted(stack):
            options = [(ready, DELETE, "D", "")]
            if not must_go:
                extra = TRUNCATED if truncated else 0
                if initial and initial in TERMINALS:
                    options += [(x, KEEP + extra, "K", initial) for x in _shifted(ready, initial)]
                options += [(x, REROLE + extra, "R", t) for t in ROLES for x in _shifted(ready, t)]
            for new, price, letter, role in options:
                found = (base + cost + price, place, letters + letter, roles, role)
                if new not in best or found < best[new]:
                    best[new] = found
    ordered = sorted(best.items(), key=lambda x: x[1][1:3])
    least = min(x[0] for x in best.values())
    ordered = [(k, v) for k, v in ordered if v[0] - least <= LAG_MOST]
    return tuple((k, v[0] - least) for k, v in ordered), least, tuple((v[1], v[2], v[3], v[4]) for _, v in ordered)


@lru_cache(None)
def finish(shape: Shape) -> tuple[int, int, str, str]:
    """Cost, place, letters and roles of the cheapest way to end."""
    return min((base + cost, place, letters, roles) for place, (stack, base) in enumerate(shape) for ready, cost, letters, roles in _inserted(stack) if _accepts(ready))


# ---- one conversation


class _Live:
    """A live stack's text: the hash of what it has repaired so far, and the ends of its audit and roles, with a link to what stands before them."""

    __slots__ = ("sha", "audit", "roles", "some", "older")

    def __init__(self, sha, audit: str = "", roles: str = "", some: bool = False, older: tuple | None = None):
        self.sha, self.audit, self.roles, self.some, self.older = sha, audit, roles, some, older

    def grown(self, letters: str, inserted: str, role: str, line: bytes | None) -> _Live:
        sha, some = self.sha, self.some
        if inserted or role:
            sha = sha.copy()
            for t in inserted:
                sha.update((("\n" if some else "") + ROLES[t] + ":").encode())
                some = True
            if role:
                sha.update(b"\n" + line if some else line)
                some = True
        return _Live(sha, self.audit + letters, self.roles + inserted + role, some, self.older)


class Parse:
    """The turns of one conversation, one after another."""

    def __init__(self):
        self.shape: Shape = ((ROOT, 0),)
        self.live = [_Live(hashlib.sha256())]
        self.cost, self.read = 0, 0

    def turn(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        initial = role[:1]
        self.shape, rise, moves = step(self.shape, initial if initial in TERMINALS else "", must_go, truncated)
        self.cost += rise
        live = []
        for place, letters, inserted, own in moves:
            name = role if letters[-1] == "K" else ROLES.get(own, "")
            live.append(self.live[place].grown(letters, inserted, own, f"{name}:{text}".encode() if own else None))
        self.live = live
        self.read += 1
        if self.read % SETTLE == 0:
            for x in self.live:
                x.older, x.audit, x.roles = (x.older, x.audit, x.roles), "", ""

    def end(self) -> tuple[int, str, str, str]:
        """Cost, audit, role initials and SHA-256 of the repaired conversation."""
        cost, place, letters, roles = finish(self.shape)
        last = self.live[place].grown(letters, roles, "", None)
        parts, older = [(last.audit, last.roles)], last.older
        while older:
            older, *part = older
            parts.append(part)
        audit, initials = ("".join(x[i] for x in reversed(parts)) for i in (0, 1))
        return self.cost + cost, audit, initials, last.sha.hexdigest()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from rows that stand by conversation and turn."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles", "repaired_sha256"]
    types = [pa.string(), *[pa.int64()] * 6, *[pa.string()] * 3]
    out: list[tuple] = []
    open_, key, parse, counts, turns, last = False, None, None, None, None, None

    def closed() -> tuple:
        low, high, distinct, _ = turns
        cost, audit, roles, sha = parse.end()
        return (key, 0 if low is None else high - low + 1 - distinct, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, roles, sha)

    for batch in batches:
        for conv, turn, gone, fault, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "gone", "fault", "role", "text"))):
            if not open_ or conv != key:
                if open_:
                    out.append(closed())
                open_, key, parse = True, conv, Parse()
                counts, turns, last = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), (None, None, 0, None), None
            if gone:
                continue
            if turn is not None:
                low, high, distinct, seen = turns
                turns = (turn if low is None else low, turn, distinct + (seen != turn), turn)
            if fault:
                counts[fault] += 1
            if last is not None and last + role[:1] not in ("su", "ua", "au"):
                counts["illegal"] += 1
            last = role[:1]
            parse.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
            out = []
    if open_:
        out.append(closed())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)


# ---- tables

_BLANKS = " \t\n\x0b\x0c\r"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage, and ``gone`` on the rows that it drops."""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(none("conv_id"), F.lit(":"), none("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), none("role").alias("role"), none("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "copy")


def fault() -> Column:
    """A row's first fault: blank, duplicate (``nth`` of its role and text) or truncated."""
    plain = F.rtrim(F.col("text"), F.lit(_BLANKS))
    return F.when(F.length(plain) == 0, "blank").when(F.col("nth") > 1, "duplicate").when(~F.substring(plain, -1, 1).isin(".", "!", "?"), "truncated")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit, role initials and SHA-256 of every conversation of ``rows`` (conv_id, turn, role, text, gone)."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "gone", "role", "text").repartition("conv_id")
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    marked = dealt.withColumn("nth", nth).select("conv_id", "turn", "gone", fault().alias("fault"), "role", "text")
    return marked.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order).mapInArrow(_stream, OUT)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations, a row a turn: conv_id, place (from 0), edit (K, R or I), role and text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "held", "own")
    plain = rows.where(~F.col("gone")).select(F.col("conv_id").cast("string").alias("conv_id"), "turn", F.col("role").alias("held"), F.col("text").alias("own"))
    plain = plain.withColumn("row", F.row_number().over(order))
    edits = repair(rows).select("conv_id", "roles", F.posexplode(F.split("audit", "")).alias("at", "edit")).where("edit <> ''")
    so_far = Window.partitionBy("conv_id").orderBy("at")
    edits = edits.withColumns({"row": F.when(F.col("edit") != "I", F.count_if(F.col("edit") != "I").over(so_far)), "place": F.count_if(F.col("edit") != "D").over(so_far) - 1}).where("edit <> 'D'")
    initial = F.expr("substring(roles, int(place) + 1, 1)")
    joined = edits.alias("e").join(plain.alias("p"), F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("e.row") == F.col("p.row")), "left")
    role = F.when(F.col("edit") == "K", F.col("held")).when(initial == "u", ROLES["u"]).otherwise(ROLES["a"])
    return joined.select("e.conv_id", "place", "edit", role.alias("role"), F.coalesce("own", F.lit("")).alias("text"))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """The conversations' damage and repair; conv_id keeps its type."""
    kind = conversations.schema["conv_id"].dataType
    return repair(damaged(conversations)).drop("roles").withColumn("conv_id", F.col("conv_id").cast(kind))
