"""Cheapest repair of the turn structure of conversations by generalised LR parsing.

The grammar of roles is compiled into LR states. A conversation's rows are read in order; each row can be kept, given
another role, or deleted, and rows can be inserted between them, each edit at its cost. All ways are parsed at once on a
graph-structured stack: stacks that end in the same state share one node, which keeps the least (cost, audit) of them and
links to all the nodes below. The audit is the string of the edits' initials; among equal costs the least one wins.
A stack never ends up with two equally cheap audits of which one begins the other: they would differ by inserted rows only,
which cost. So the least prefix stays the least whatever follows, and keeping one for each top loses nothing.

Conversations of any length are parsed in pieces. Rows are sorted by conversation and turn over all tasks, without their
texts, and cut into pieces of a bounded number of rows; a piece maps each stack top before it to the tops after it, with
(cost, audit). The maps of a conversation are composed in pairs, which gives its audit and each piece's share of it.
The edits are joined back to the rows by their keys, so that the repaired rows are a distributed table again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import map_rows, stored

# Role initials `(s?(ua)+)?`, left-recursive, so that a stack stays short. The first symbol is the start.
GRAMMAR = (("C", ""), ("C", "Q"), ("Q", "P"), ("Q", "sP"), ("Q", "QP"), ("P", "ua"))
ROLES = {"u": "user", "a": "assistant"}  # roles that a row can be given
LEGAL = ("su", "ua", "au")  # initials that may follow each other
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)  # a row's first fault
PIECE = 1000  # rows
WHITE = " \t\n\x0b\x0c\r"
KEYS = ("conv", "turn", "role", "text_key")
Best = tuple[int, str]


class Automaton:
    """LR(0) states of a grammar whose symbols are single letters, non-terminals in upper case."""

    def __init__(self, grammar: tuple[tuple[str, str], ...]):
        self.grammar, self.start = grammar, grammar[0][0]
        self.letters = sorted({c for _, right in grammar for c in right if c.islower()})
        self.states = [self._closed({(k, 0) for k, (left, _) in enumerate(grammar) if left == self.start})]
        self.goto: list[dict[str, int]] = []
        for state in self.states:  # grows while it is read
            moves = {}
            for c in sorted({grammar[k][1][at] for k, at in state if at < len(grammar[k][1])}):
                following = self._closed({(k, at + 1) for k, at in state if grammar[k][1][at:at + 1] == c})
                if following not in self.states:
                    self.states.append(following)
                moves[c] = self.states.index(following)
            self.goto.append(moves)
        complete = [[grammar[k] for k, at in sorted(state) if at == len(grammar[k][1])] for state in self.states]
        self.accepting = [any(left == self.start for left, _ in rules) for rules in complete]
        self.reduces = [[rule for rule in rules if rule[0] != self.start] for rules in complete]

    def _closed(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        items, todo = set(items), list(items)
        while todo:
            k, at = todo.pop()
            wanted = self.grammar[k][1][at:at + 1]
            for n, (left, _) in enumerate(self.grammar):
                if left == wanted and (n, 0) not in items:
                    items.add((n, 0))
                    todo.append((n, 0))
        return frozenset(items)


@dataclass(frozen=True)
class Node:
    """A node of the stack: an LR state and the nodes that may lie below."""

    state: int
    below: frozenset[Node] = frozenset()


class Repair:
    """Weighted parsing on a graph-structured stack."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = GRAMMAR):
        self.lr = Automaton(grammar)
        self.moves: dict[tuple[Node, str], tuple[Node, ...]] = {}
        self.tops = {0: Node(0)}  # every state a stack can rest on, with all that may lie below
        before = None
        while before != self.tops:
            before = dict(self.tops)
            for node in before.values():
                for c in self.lr.letters:
                    for other in self.shifted(node, c):
                        self.tops[other.state] = self._merged(self.tops.get(other.state, other), other)
        for node in self.tops.values():
            alone = [Node(node.state, frozenset([x])) for x in node.below]
            if any({y.state for y in self.shifted(x, c)} != {y.state for y in self.shifted(node, c)} for x in alone for c in self.lr.letters):
                raise ValueError("what may follow a stack's top depends on what lies below it; such tops cannot be merged")

    @staticmethod
    def _merged(a: Node, b: Node) -> Node:
        return a if a is b else Node(a.state, a.below | b.below)

    def shifted(self, node: Node, letter: str) -> tuple[Node, ...]:
        """The tops after a letter has been shifted and all that is complete has been reduced."""
        known = self.moves.get((node, letter))
        if known is None:
            state = self.lr.goto[node.state].get(letter)
            todo, resting = [] if state is None else [Node(state, frozenset([node]))], {}
            while todo:
                top = todo.pop()
                for left, right in self.lr.reduces[top.state]:
                    bases = {top}
                    for _ in right:
                        bases = {x for n in bases for x in n.below}
                    todo += [Node(self.lr.goto[base.state][left], frozenset([base])) for base in bases]
                if not self.lr.reduces[top.state]:
                    resting[top.state] = self._merged(resting.get(top.state, top), top)
            known = self.moves[(node, letter)] = tuple(resting.values())
        return known

    def _add(self, level: dict[int, tuple[int, str, Node]], cost: int, audit: str, node: Node) -> bool:
        """Merge a stack into a level; whether it is the best of its top."""
        old = level.get(node.state)
        if old is None:
            level[node.state] = (cost, audit, node)
            return True
        better = (cost, audit) < old[:2]
        level[node.state] = (*((cost, audit) if better else old[:2]), self._merged(old[2], node))
        return better

    def _inserted(self, level: dict[int, tuple[int, str, Node]]) -> dict[int, tuple[int, str, Node]]:
        """The level with any number of rows inserted."""
        todo = [*level]
        while todo:
            cost, audit, node = level[todo.pop()]
            for c in ROLES:
                for other in self.shifted(node, c):
                    if self._add(level, cost + INSERT, audit + "I", other):
                        todo.append(other.state)
        return level

    def parsed(self, rows: list[tuple[str, int]], top: int = 0) -> dict[int, Best]:
        """(cost, audit) by the top after rows (initial, fault), begun on a top. Rows are inserted before rows, not behind the last."""
        level = {top: (0, "", self.tops[top])}
        for initial, fault in rows:
            following: dict[int, tuple[int, str, Node]] = {}
            again = TRUNCATED if fault == CUT_OFF else 0
            for cost, audit, node in self._inserted(level).values():
                self._add(following, cost + DELETE, audit + "D", node)
                if fault in (BLANK, DUPLICATE):
                    continue
                for other in self.shifted(node, initial):
                    self._add(following, cost + again, audit + "K", other)
                for c in ROLES:
                    for other in self.shifted(node, c):
                        self._add(following, cost + again + REROLE, audit + "R", other)
            level = following
        return {state: (cost, audit) for state, (cost, audit, _) in level.items()}

    def finished(self, found: dict[int, Best]) -> Best:
        """The best (cost, audit) that ends in an accepted conversation, with rows inserted behind the last."""
        level = self._inserted({state: (cost, audit, self.tops[state]) for state, (cost, audit) in found.items()})
        return min((cost, audit) for state, (cost, audit, _) in level.items() if self.lr.accepting[state])


@lru_cache(maxsize=1)
def repairer() -> Repair:
    return Repair()


Map = dict[int, dict[int, Best]]


def composed(first: Map, second: Map) -> Map:
    out: Map = {}
    for entry, through in first.items():
        ends = out[entry] = {}
        for middle, (cost, audit) in through.items():
            for end, (more, rest) in second[middle].items():
                ends[end] = min(ends.get(end, (cost + more + 1, "")), (cost + more, audit + rest))
    return out


def composed_all(maps: list[Map]) -> Map:
    """The maps of adjacent pieces, composed in pairs until one is left."""
    while len(maps) > 1:
        maps = [composed(*maps[k:k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
    return maps[0]


@dataclass
class Piece:
    """Consecutive rows of one conversation."""

    number: int
    conv: object
    first: bool  # certainly the conversation's first piece
    rows: list[tuple] = field(default_factory=list)  # (turn, role, text key, copies)
    read: list[tuple[str, int]] = field(default_factory=list)
    turns: list = field(default_factory=list)  # distinct ones, ascending, without null

    def add(self, turn, role: str, text_key: bytes, copies: int, faults: list[int]) -> None:
        self.rows.append((turn, role, text_key, copies))
        self.read += [(role[:1], f) for f in faults]
        if turn is not None and self.turns[-1:] != [turn]:
            self.turns.append(turn)

    def row(self) -> tuple:
        parse, faults = repairer(), [f for _, f in self.read]
        entries = [0] if self.first else [*parse.tops]
        maps = [(e, end, cost, audit) for e in entries for end, (cost, audit) in parse.parsed(self.read, e).items()]
        initials = [i for i, _ in self.read]
        return (
            self.number, self.conv, self.rows, maps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT_OFF),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), initials[0], initials[-1],
            self.turns[0] if self.turns else None, self.turns[-1] if self.turns else None, len(self.turns), len(self.read),
        )


def marked(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv, turn, role, text_key) with their copies and the fault of the first of them; texts stay behind."""
    ends = F.rtrim("text", F.lit(WHITE))
    fault = F.when(ends == "", BLANK).when(~F.substring(ends, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(SOUND)
    counted = rows.withColumn("fault", fault).groupBy(*KEYS, "fault").agg(F.count("*").alias("copies"))
    when = F.struct(F.col("turn").isNotNull(), "turn")
    said = counted.where(F.col("fault") != BLANK)
    firsts = said.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text_key").alias("k")).agg(F.min(when).alias("when"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_key") == F.col("k"))
    seen = said.join(firsts, same).withColumn("fault", F.when(when.eqNullSafe(F.col("when")), F.col("fault")).otherwise(DUPLICATE))
    columns = [*KEYS, "copies", "fault"]
    return seen.select(*columns).unionByName(counted.where(F.col("fault") == BLANK).select(*columns))


def pieces(rows: DataFrame, size: int) -> DataFrame:
    """The marked rows in order, cut into pieces with their maps."""
    order = [F.asc_nulls_first(c) for c in KEYS]
    ordered = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))

    def cut(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        from pyspark import TaskContext

        number, piece = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            out = []
            for key, at, role, text_key, copies, fault in zip(*(batch[c] for c in (*KEYS, "copies", "fault"))):
                while copies:
                    if piece is None or piece.conv != key or len(piece.read) >= size:
                        if piece is not None:
                            out.append(piece.row())
                            number += 1
                        # A task cannot know whether its first conversation began in the task before it.
                        piece = Piece(number, key, piece is not None and piece.conv != key)
                    some = min(copies, size - len(piece.read))
                    later = BLANK if fault == BLANK else DUPLICATE
                    piece.add(at, role, text_key, some, [fault] + [later] * (some - 1))
                    copies, fault = copies - some, later
            yield out
        if piece is not None:
            yield [piece.row()]

    return map_rows(ordered, cut, f"""number long, conv {conv},
        rows array<struct<turn: {turn}, role: string, text_key: binary, copies: long>>,
        maps array<struct<entry: int, top: int, cost: long, audit: string>>, blank long, duplicate long, truncated long, illegal long,
        first_initial string, last_initial string, first_turn {turn}, last_turn {turn}, turns long, size long""")


def shares(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut into the edits of the pieces; rows that are inserted between two pieces go to the second."""
    out, at = [], 0
    for size in sizes[:-1]:
        start = at
        while size:
            size -= audit[at] != "I"
            at += 1
        out.append(audit[start:at])
    return [*out, audit[at:]]


def totals(found: DataFrame) -> DataFrame:
    """One row per conversation that has rows: its counts, cost, audit, and each piece's edits and first place."""
    kept = [c for c in found.columns if c not in ("conv", "rows")]
    whole = found.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*kept))).alias("pieces"))
    conv = found.schema["conv"].dataType.simpleString()

    def total(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        parse = repairer()
        for batch in batches:
            out = []
            for key, parts in zip(batch["conv"], batch["pieces"]):
                maps: list[Map] = []
                for p in parts:
                    maps.append({})
                    for m in p["maps"]:
                        maps[-1].setdefault(m["entry"], {})[m["top"]] = (m["cost"], m["audit"])
                maps[0] = {0: maps[0][0]}
                cost, audit = parse.finished(composed_all(maps)[0])
                blank, duplicate, truncated, illegal = (sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal"))
                illegal += sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in zip(parts, parts[1:]))
                dated = [p for p in parts if p["turns"]]
                turns = sum(p["turns"] for p in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
                gaps = int(dated[-1]["last_turn"]) - int(dated[0]["first_turn"]) + 1 - turns if dated else 0
                length = len(audit) - audit.count("D")
                edits, place = [], 0
                for p, share in zip(parts, shares(audit, [p["size"] for p in parts])):
                    edits.append((p["number"], share, place))
                    place += len(share) - share.count("D")
                out.append((key, gaps, blank, duplicate, truncated, illegal, cost, audit, length, edits))
            yield out

    return map_rows(whole, total, f"""conv {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,
        audit string, length long, edits array<struct<number: long, audit: string, place: long>>""")


def edits_of(found: DataFrame, total: DataFrame) -> DataFrame:
    """The rows of the repaired conversations without their texts: place, new role, and the keys of the row (null: inserted)."""
    each = total.select("length", F.explode("edits").alias("e")).select("length", "e.number", "e.audit", "e.place")
    joined = found.select("number", "conv", "rows").join(each, "number")
    conv, turn = found.schema["conv"].dataType.simpleString(), found.schema["first_turn"].dataType.simpleString()

    def edit(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        for batch in batches:
            out = []
            for key, rows, audit, place, length in zip(*(batch[c] for c in ("conv", "rows", "audit", "place", "length"))):
                old = iter([r for row in rows for r in [row] + [None] * (row["copies"] - 1)])  # only a row's first copy can stay
                for letter in audit:
                    row = None if letter == "I" else next(old)
                    if letter == "D":
                        continue
                    role = row["role"] if letter == "K" else "user" if (place - length) % 2 == 0 else "assistant"
                    out.append((key, place, role, *((row["turn"], row["role"], row["text_key"]) if row else (None,) * 3)))
                    place += 1
            yield out

    return map_rows(joined, edit, f"conv {conv}, place long, new_role string, turn {turn}, role string, text_key binary")


def _rows(df: DataFrame, id_column: str) -> DataFrame:
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(" "))
    return df.select(F.col(f"`{id_column}`").alias("conv"), F.col("`turn`").alias("turn"),
                     F.coalesce(F.col("`role`"), F.lit(" ")).alias("role"), text.alias("text"),
                     F.unhex(F.sha2(text, 256)).alias("text_key"))


def repair(df: DataFrame, id_column: str = "conv_id", piece_rows: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Repair the conversations in rows (id, turn, role, text); other columns are not read.

    Two tables. One row per conversation: the id, gaps, blank, duplicate, truncated, illegal, cost, audit. One row per row of
    the repaired conversations: the id, place, role, text. Rows follow by turn, nulls first, those of one turn by role and
    then by the hash of their text; repeated rows are duplicates. A null role or text is one space, whose initial no
    conversation may have. An empty role has no initial, so such a row is given a role or deleted. A null id is one
    conversation. An empty table has no conversations.
    """
    rows = _rows(df, id_column)
    found = stored(pieces(rows, piece_rows))
    total = stored(totals(found))
    kept = edits_of(found, total)
    texts = rows.dropDuplicates([*KEYS]).select(*[F.col(c).alias(f"old_{c}") for c in KEYS], "text")
    same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in KEYS]
    old = kept.where("text_key IS NOT NULL").join(texts, same).select("conv", "place", F.col("new_role").alias("role"), "text")
    new = kept.where("text_key IS NULL").select("conv", "place", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return total.drop("length", "edits").withColumnRenamed("conv", id_column), old.unionAll(new).withColumnRenamed("conv", id_column)


def digests(repaired: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """sha256 of each repaired conversation's `role:text`, newline-joined; its rows stream through one task, none is held."""
    kind = repaired.schema[id_column].dataType.simpleString()
    ordered = repaired.repartition(F.col(f"`{id_column}`")).sortWithinPartitions(f"`{id_column}`", "place")

    def read(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        key, state = None, None
        for batch in batches:
            out = []
            for conv, place, role, text in zip(batch[id_column], batch["place"], batch["role"], batch["text"]):
                if place == 0:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = conv, hashlib.sha256()
                state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield out
        if state is not None:
            yield [(key, state.hexdigest())]

    return map_rows(ordered, read, f"`{id_column}` {kind}, repaired_sha256 string")


def damaged(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, chosen by the checksum of `conv_id:turn`; nulls are one space."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind: Column = F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20
    rows = df.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.expr("array_repeat(0, IF(kind = 3, 2, 1))")).alias("copy"))
    return rows.drop("copy")


def repaired_after_damage(df: DataFrame) -> DataFrame:
    """One row per conversation in `df`: what damage does to it, its cheapest repair, and the digest of the result."""
    total, rows = repair(damaged(df))
    ids = df.select("conv_id").distinct()
    for part in (total, digests(rows)):
        renamed = part.withColumnRenamed("conv_id", "key")
        ids = ids.join(renamed, F.col("conv_id").eqNullSafe(F.col("key")), "left").drop("key")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
