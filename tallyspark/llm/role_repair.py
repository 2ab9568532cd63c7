"""Chat formatting: conversations repaired at least cost to a legal order of
roles, then rendered.

A legal conversation is an optional system turn, then user and assistant turns
in alternation, ending with the assistant. Every given turn is kept: it is
emitted under its own role, relabelled, or merged into the turn before it; and
empty turns may be inserted anywhere. Each of these has a cost; a dynamic
program over the automaton of legal orders finds a repair of least total cost
(the state is the role of the last turn; ties go to the lower state, and to
emitting before merging).

A run of turns is a 4 x 4 matrix of least costs between states, and matrices
combine by (min, +) products. So a conversation of any length is cut into
leaves of 256 rows; leaf matrices are multiplied up a tree of fan-out 256, and
the states at the cuts are found on the way down. Rows are numbered where they
are sorted: in ranges of conversation and order, so that rows of one turn number
are dealt to several tasks too. A task holds one leaf or one tree node's
children, never a conversation. Conversations of one leaf, nearly all, skip the
tree.

The result has a row per turn with its fragment of the rendered text; the
fragments of a conversation, in order, are the rendered conversation. Control
markers inside a text are broken by a space.

Order: by turn, then role, then text (its first 64 characters, then a hash);
null turns come last, in the order of a hash. Rows that repeat another in all
four columns are one turn (``copies`` counts them). A row with a null
``conv_id`` is a conversation of its own. Roles are matched without regard to
case and outer spaces; a null or unknown role can take any label at a small
cost. A null text is empty. Extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, stored

LEAF_BITS = 8  # a leaf is 2^8 rows, a tree node 2^8 children
FAN_BITS = 8
PART_BITS = 24  # 2^24 leaf numbers for each range of rows
ROLES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

RESULT_SCHEMA = ("conv_id long, turn long, role string, repaired_role string, action string, "
                 "inserted_before array<string>, inserted_after array<string>, cost double, "
                 "copies long, fragment string")


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 3.0
    relabel_unknown: float = 1.0
    insert: float = 2.0


class Automaton:
    """Least costs and moves for one set of costs."""

    def __init__(self, costs: Costs) -> None:
        self.costs = costs
        self.paths = {s: self._insertions(s) for s in range(4)}  # state -> (state -> inserted roles)
        self.moves = {role: self._moves(role) for role in (None, SYSTEM, USER, ASSISTANT)}
        self.matrix = {role: np.array([[moves[s, t][0] if (s, t) in moves else np.inf
                                        for t in range(4)] for s in range(4)])
                       for role, moves in self.moves.items()}
        #: cost, and inserted roles, from a state to a legal end
        self.end = {s: (len(p) * costs.insert, p) for s in range(4)
                    for p in [self.paths[s][ASSISTANT]]}

    @staticmethod
    def _insertions(state: int) -> dict[int, list[int]]:
        """Shortest runs of empty turns from a state to each that it can reach."""
        found, open_states = {state: []}, [state]
        for s in open_states:
            for t in LEGAL[s]:
                if t not in found:
                    found[t] = [*found[s], t]
                    open_states.append(t)
        return found

    def _moves(self, role: int | None) -> dict[tuple[int, int], tuple[float, list[int], str]]:
        """(state, next state) -> (cost, roles inserted before, action) for a turn of a role."""
        def label(q: int) -> float:
            if role is None:
                return self.costs.relabel_unknown
            return 0.0 if q == role else self.costs.relabel

        best: dict[tuple[int, int], tuple[float, list[int], str]] = {}
        for s in range(4):
            for p, inserted in self.paths[s].items():
                paid = len(inserted) * self.costs.insert
                options = [(q, paid + label(q), "keep" if q == role else "relabel") for q in LEGAL[p]]
                if p != START:
                    options.append((p, paid + self.costs.merge + label(p),
                                    "merge" if p == role else "relabel and merge"))
                for q, cost, action in options:
                    if (s, q) not in best or cost < best[s, q][0]:
                        best[s, q] = (cost, inserted, action)
        return best

    def total(self, roles: list[int | None]) -> np.ndarray:
        """The matrix of a run of turns."""
        out = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
        for role in roles:
            out = (out[:, :, None] + self.matrix[role][None]).min(axis=1)
        return out

    def path(self, matrices: list[np.ndarray], entry: int, exit_state: int | None) -> list[int]:
        """States before the first and after each of a run of matrices, of least
        cost from entry to the exit state (None: to the cheapest legal end)."""
        cost = np.full(4, np.inf)
        cost[entry] = 0
        back = []
        for m in matrices:
            through = cost[:, None] + m
            back.append(through.argmin(axis=0))
            cost = through.min(axis=0)
        if exit_state is None:
            exit_state = int((cost + [self.end[s][0] for s in range(4)]).argmin())
        states = [exit_state]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def role_number(role: str | None) -> int | None:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else None


def _header(role: int) -> str:
    return f"{OPEN}{ROLES[role]}\n"


def _quoted(text: str | None) -> str:
    return (text or "").replace("<|", "< |")


def repair_leaf(automaton: Automaton, turns: list[tuple], entry: int, exit_state: int | None
                ) -> Iterator[tuple]:
    """turns: (role, text); gives (repaired role, action, inserted before, inserted
    after, cost, fragment) of each. An exit state of None ends the conversation."""
    roles = [role_number(r) for r, _ in turns]
    states = automaton.path([automaton.matrix[r] for r in roles], entry, exit_state)
    for k, ((before, after), role, (_, text)) in enumerate(zip(pairwise(states), roles, turns, strict=True)):
        cost, inserted, action = automaton.moves[role][before, after]
        appended: list[int] = []
        parts = [] if before == START or ("merge" in action and not inserted) else [f"{CLOSE}\n"]
        parts += [_header(r) + f"{CLOSE}\n" for r in inserted[:len(inserted) - ("merge" in action)]]
        if "merge" not in action or inserted:
            parts.append(_header(after))
        else:
            parts.append("\n")
        parts.append(_quoted(text))
        if exit_state is None and k == len(turns) - 1:
            end_cost, appended = automaton.end[after]
            cost += end_cost
            parts += [f"{CLOSE}\n", *[_header(r) + f"{CLOSE}\n" for r in appended]]
        yield (ROLES[after], action, [ROLES[r] for r in inserted], [ROLES[r] for r in appended],
               float(cost), "".join(parts))


_KEYS = ["conv_id", "solo", "leaf"]
_MATRICES = pa.schema([("conv_id", pa.int64()), ("solo", pa.int64()), ("node", pa.int64()),
                       ("m", pa.list_(pa.float64()))])
_PLACED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ("solo", pa.int64()), ("mark", pa.int64()), ("leaf", pa.int64()), ("place", pa.int64()),
    ("copies", pa.int64())])
_RESULT = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("repaired_role", pa.string()),
    ("action", pa.string()), ("inserted_before", pa.list_(pa.string())),
    ("inserted_after", pa.list_(pa.string())), ("cost", pa.float64()), ("copies", pa.int64()),
    ("fragment", pa.string())])


def _placed(conversations: DataFrame, leaf_bits: int) -> DataFrame:
    """Every distinct row with its number of copies, its leaf and its place there."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                F.col("role").cast("string"), F.col("text").cast("string"))
    schema = "conv_id long, turn long, role string, text string, solo long, mark long"
    mark = F.xxhash64("turn", "role", "text")
    order = ["conv_id", "solo", F.col("turn").asc_nulls_last(), "mark", "role",
             F.substring("text", 1, 64), F.xxhash64("text")]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << PART_BITS
        conversation, at, last = None, 0, None
        for batch in batches:
            out = []
            for *row, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last and last[:6] == row:
                    last[8] += copies
                    continue
                if last:
                    out.append(last)
                if conversation != (row[0], row[4]):
                    conversation, at = (row[0], row[4]), 0
                last = [*row, first + (at >> leaf_bits), at & ((1 << leaf_bits) - 1), copies]
                at += 1
            yield _batch(out, _PLACED)
        yield _batch([last] if last else [], _PLACED)

    return stored(rows.withColumn("solo", F.when(F.col("conv_id").isNull(), mark).otherwise(F.lit(0)))
                  .withColumn("mark", F.when(F.col("turn").isNull(), mark).otherwise(F.lit(0)))
                  .transform(map_arrow, _combined, f"{schema}, copies long")
                  .repartitionByRange(*order).sortWithinPartitions(*order, "text")
                  .transform(map_arrow, numbered, f"{schema}, leaf long, place long, copies long"), "placed")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that repeat within a batch as one, with their number: so that a row
    repeated without end does not arrive at its range as often."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        grouped = table.group_by(table.column_names).aggregate([([], "count_all")])
        yield from grouped.rename_columns([*table.column_names, "copies"]).combine_chunks().to_batches()


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "place")


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows of a leaf: (key, rows), across batches."""
    key, rows = None, []
    for batch in batches:
        data = batch.to_pydict()
        for at, row in zip(zip(*(data[k] for k in _KEYS), strict=True),
                           zip(*(data[c] for c in columns), strict=True), strict=True):
            if at != key:
                if rows:
                    yield key, rows
                key, rows = at, []
            rows.append(row)
    if rows:
        yield key, rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _product(automaton: Automaton, flat: list) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for m in flat:
        out = (out[:, :, None] + np.array(m).reshape(4, 4)[None]).min(axis=1)
    return out


def _cuts(rows: DataFrame, automaton: Automaton, fan_bits: int) -> DataFrame:
    """(conv_id, solo, leaf, entry, exit): states at the ends of the leaves of
    conversations that have several; exit is -1 at the end of one."""
    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _batch([(*key, automaton.total([role_number(r) for r, in turns]).ravel().tolist())
                      for key, turns in _runs(batches, ["role"])], _MATRICES)

    schema = "conv_id long, solo long, node long, m array<double>"
    long = (rows.where("conv_id IS NOT NULL").groupBy("conv_id")
            .agg(F.min("leaf").alias("a"), F.max("leaf").alias("b")).where("a < b").select("conv_id"))
    leaves = rows.select("conv_id", "role", "solo", "leaf", "place").join(long, "conv_id", "left_semi")
    levels = [stored(_sorted(leaves).transform(map_arrow, matrices, schema), "leaf-costs")]

    def parents(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        return pd.DataFrame([(pdf.conv_id.iloc[0], 0, pdf.node.iloc[0] >> fan_bits,
                              _product(automaton, pdf.m.tolist()).ravel().tolist())],
                            columns=["conv_id", "solo", "node", "m"])

    while levels[-1].groupBy("conv_id").count().where("count > 1").limit(1).count():
        levels.append(stored(levels[-1].groupBy("conv_id", F.shiftright("node", fan_bits))
                             .applyInPandas(parents, schema), "node-costs"))

    cut_schema = "conv_id long, node long, entry int, exit int"
    cuts = levels[-1].select("conv_id", "node", F.lit(START).alias("entry"), F.lit(-1).alias("exit"))

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        matrices = [np.array(m).reshape(4, 4) for m in pdf.m]
        whole = int(pdf.exit.iloc[0])
        states = automaton.path(matrices, int(pdf.entry.iloc[0]), None if whole < 0 else whole)
        exits = states[1:-1] + [whole]
        return pd.DataFrame({"conv_id": pdf.conv_id, "node": pdf.node, "entry": states[:-1], "exit": exits})

    for level in reversed(levels[:-1]):
        above = cuts.withColumnRenamed("node", "parent")
        cuts = stored(level.withColumn("parent", F.shiftright("node", fan_bits)).join(above, ["conv_id", "parent"])
                      .groupBy("conv_id", "parent").applyInPandas(split, cut_schema), "cuts")
    return cuts.select("conv_id", F.col("node").alias("leaf"), "entry", "exit")


def repair(conversations: DataFrame, costs: Costs | None = None, leaf_bits: int = LEAF_BITS,
           fan_bits: int = FAN_BITS) -> DataFrame:
    """One row per distinct turn: its repaired role, what was done, the empty
    turns around it, the cost, and its fragment of the rendered conversation.
    ``leaf_bits`` is at least 2, ``fan_bits`` at least 1."""
    automaton = Automaton(costs or Costs())
    placed = _placed(conversations, leaf_bits)
    # the states at a leaf's ends travel as a row of it, which sorts first
    cuts = _cuts(placed, automaton, fan_bits).withColumns({
        "solo": F.lit(0).cast("long"), "place": F.lit(-1).cast("long")})
    cut = placed.drop("mark").unionByName(cuts, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv_id, _, _), turns in _runs(
                batches, ["place", "entry", "exit", "turn", "role", "text", "copies"]):
            entry, exit_state = START, -1
            if turns[0][0] < 0:
                entry, exit_state = turns.pop(0)[1:3]
            repaired = repair_leaf(automaton, [t[4:6] for t in turns], entry,
                                   None if exit_state < 0 else exit_state)
            out += [(conv_id, turn, role, *fixed[:5], copies, fixed[5])
                    for (*_, turn, role, _, copies), fixed in zip(turns, repaired, strict=True)]
            if len(out) >= 10_000:
                yield _batch(out, _RESULT)
                out = []
        yield _batch(out, _RESULT)

    return _sorted(cut).transform(map_arrow, run, RESULT_SCHEMA)

