"""Chat formatting with minimum-cost role repair.

A legal conversation is a path of an automaton: an optional system message, then user and assistant in
turn. Dynamic programming over its states finds the cheapest way to make a sequence of turns legal by
merging a turn into the message before it, giving it another role, or inserting empty messages.

The step of one turn is a small matrix of costs between states, and matrices multiply (by minimum and
sum) in any grouping. So turns are sorted over all tasks, each task multiplies its own stretch of a
conversation, the few products of a conversation settle the states between stretches, and each stretch
is then traced back by itself. A conversation of any length is spread over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import discard, filled, stored

ROLES = ("system", "user", "assistant")
# States: 0 before any message, k after a message of ROLES[k - 1]. What may follow:
FOLLOWS = ((0, 1), (1,), (2,), (1,))
UNKNOWN = len(ROLES)
NAMES = {
    "system": ("system", "developer"),
    "user": ("user", "human", "customer", "prompter"),
    "assistant": ("assistant", "bot", "gpt", "model", "ai"),
}
MERGE, GUESS, INSERT, RELABEL = 1, 1, 2, 3  # costs; GUESS gives an unknown role one
FAR = 1 << 40
SEPARATOR = "\n\n"  # between merged turns


def _steps() -> dict[tuple[int, int], dict[int, tuple[int, str, tuple[int, ...]]]]:
    """(state, role of the turn) -> state after it -> (cost, action, inserted roles), the cheapest each."""
    paths = {(s, ()): s for s in range(4)}  # empty messages of user or assistant inserted one after another
    for _ in range(2):
        paths |= {(s, (*p, r)): r + 1 for (s, p), at in paths.items() for r in FOLLOWS[at] if r}
    steps = {}
    for state, role in product(range(4), range(UNKNOWN + 1)):
        options = []
        change = lambda to: 0 if to == role else GUESS if role == UNKNOWN else RELABEL  # noqa: B023, E731
        if state:
            options.append((MERGE + change(state - 1), 1, "merge", (), state))
        for (start, path), at in paths.items():
            for to in FOLLOWS[at] if start == state else ():
                kind = "keep" if to == role else "relabel"
                options.append((INSERT * len(path) + change(to), 0 if kind == "keep" else 2, kind, path, to + 1))
        best: dict[int, tuple[int, str, tuple[int, ...]]] = {}
        for cost, _, kind, path, after in sorted(options):
            best.setdefault(after, (cost, kind, path))
        steps[state, role] = best
    return steps


STEPS = _steps()
# Ending after a system message alone appends an empty user message.
ENDING = (0, INSERT, 0, 0)


def forward(entry: int, roles: list[int]) -> list[list[tuple[int, int]]]:
    """Per turn and state after it: the least cost from ``entry``, and the state before the turn."""
    rows, costs = [], [FAR] * 4
    costs[entry] = 0
    for role in roles:
        row = [(FAR, 0)] * 4
        for state, cost in enumerate(costs):
            if cost < FAR:
                for after, (more, _, _) in STEPS[state, role].items():
                    if cost + more < row[after][0]:
                        row[after] = (cost + more, state)
        rows.append(row)
        costs = [c for c, _ in row]
    return rows


def matrix(roles: list[int]) -> list[int]:
    """Least costs from every state to every state over a stretch, row by row."""
    return [c for entry in range(4) for c, _ in forward(entry, roles)[-1]]


def settle(matrices: list[list[int]]) -> tuple[int, list[int]]:
    """The least cost of a conversation, and the states before, between and after its stretches."""
    costs, back = [0, FAR, FAR, FAR], []
    for flat in matrices:
        options = np.asarray(costs)[:, None] + np.asarray(flat).reshape(4, 4)
        back.append(options.argmin(axis=0).tolist())
        costs = np.minimum(options.min(axis=0), FAR).tolist()
    final = [c + e for c, e in zip(costs, ENDING, strict=True)]
    state = int(np.argmin(final))
    states = [state]
    for came in reversed(back):
        states.append(came[states[-1]])
    return final[state], states[::-1]


def trace(entry: int, leave: int, roles: list[int]) -> list[tuple[str, str, list[str]]]:
    """(role, action, roles inserted before it) of every turn on a cheapest way from entry to leave."""
    rows, states = forward(entry, roles), [leave]
    for row in reversed(rows):
        states.append(row[states[-1]][1])
    states.reverse()
    found = []
    for role, before, after in zip(roles, states, states[1:], strict=False):
        _, action, inserted = STEPS[before, role][after]
        found.append((ROLES[after - 1], action, [ROLES[r] for r in inserted]))
    return found


# -- Spark --------------------------------------------------------------------------------


def role_number(role: str | Column) -> Column:
    """The number of a role in ROLES by any of its names, UNKNOWN for others and NULL."""
    name = F.lower(F.trim(F.col(role) if isinstance(role, str) else role))
    found = F.lit(UNKNOWN)
    for k, r in enumerate(ROLES):
        found = F.when(name.isin(*NAMES[r]), k).otherwise(found)
    return found.cast("int")


def _matrices(roles: pa.Array) -> pa.Array:
    return pa.array([matrix(r.as_py()) for r in roles], pa.list_(pa.int64()))


def _settled(stretches: pa.Array) -> pa.Array:
    kind = pa.struct([("cost", pa.int64()), ("states", pa.list_(pa.int32()))])
    found = (settle([s["m"] for s in own.as_py()]) for own in stretches)
    return pa.array([{"cost": c, "states": s} for c, s in found], kind)


def _traced(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    names = ("role", "action", "inserted")
    kind = pa.list_(pa.struct([("role", pa.string()), ("action", pa.string()), ("inserted", pa.list_(pa.string()))]))
    for entries, leaves, roles in batches:
        rows = zip(entries.to_pylist(), leaves.to_pylist(), roles.to_pylist(), strict=True)
        yield pa.array([[dict(zip(names, t, strict=True)) for t in trace(*row)] for row in rows], kind)


def repaired(
    turns: DataFrame, key: str, order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per input turn: ``key``, ``order``, ``role``, ``new_role``, ``action`` (keep, relabel or merge),
    ``inserted`` (roles of empty messages before it), ``cost`` of the whole conversation, and ``rendered``.

    The ``rendered`` parts of a conversation, in order, are its text: every message as ``<|role|>``, a line
    break, its content, ``<|end|>`` and a line break; the mark ``<|`` within contents is written ``<\\|``.
    Turns are ordered by ``order``, NULL last, then by role and text; equal turns are turns of their own.
    NULL texts are empty, NULL and unknown roles are given one. A NULL key is a conversation like any
    other. Other columns are dropped. An empty table gives no rows.
    """
    named = turns.select(
        F.col(key).alias("key"), F.col(order).alias("order"), F.col(role).alias("role"), filled(text).alias("text"),
        role_number(role).alias("r"),
    )
    places = [F.col("key"), F.col("order").asc_nulls_last(), F.col("role"), F.col("text")]
    sorted_ = named.repartitionByRange(*places).sortWithinPartitions(*places)
    part, place = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    rows = stored(sorted_.select("*", part, place))  # storing fixes both numbers
    # a stretch is what one partition holds of a conversation
    own = F.array_sort(F.collect_list(F.struct("place", "r")))
    stretches = stored(rows.groupBy("key", "part").agg(own.alias("own")))
    matrices = F.arrow_udf(_matrices, "array<bigint>")
    summed = stretches.select("key", "part", matrices(F.col("own.r")).alias("m"))
    # as many stretches as partitions at most
    met = summed.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("part", "m"))).alias("all"))
    settled = F.arrow_udf(_settled, "struct<cost: bigint, states: array<int>>")
    states = met.select("key", "all.part", settled("all").alias("s")).select(
        "key", "s.cost", F.posexplode("part").alias("n", "part"), F.col("s.states").alias("states")
    )
    states = stored(states.select(
        F.col("key").alias("k"), F.col("part").alias("p"), "cost", F.get("states", F.col("n")).alias("entry"),
        F.get("states", F.col("n") + 1).alias("leave"), (F.col("n") + 2 == F.size("states")).alias("last"),
    ))
    joined = stretches.join(states, F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("p")))
    traced = F.arrow_udf(_traced, "array<struct<role: string, action: string, inserted: array<string>>>")
    steps = joined.select("own", "cost", "last", "leave", traced("entry", "leave", F.col("own.r")).alias("steps"))
    steps = steps.select("cost", "last", "leave", F.size("own").alias("size"), F.posexplode(F.arrays_zip("own.place", "steps")).alias("n", "z"))
    ends = F.col("last") & (F.col("n") + 1 == F.col("size"))
    steps = stored(steps.select(F.col("z.place").alias("place"), "cost", "z.steps.*", ends.alias("ends"), "leave").withColumnRenamed("role", "new_role"))
    discard(stretches, states)
    found = rows.join(steps, "place")
    first = F.col("action") != "merge"
    opened = lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n"))
    closed = "<|end|>\n"
    # the message before is closed by the turn that starts the next one, and by the last turn
    content = F.replace("text", F.lit("<|"), F.lit("<\\|"))
    empties = F.array_join(F.transform("inserted", lambda r: F.concat(opened(r), F.lit(closed))), "")
    head = F.when(first, F.concat(empties, opened(F.col("new_role")))).otherwise(F.lit(SEPARATOR))
    tail = F.when(F.col("ends"), F.when(F.col("leave") == 1, closed + "<|user|>\n" + closed).otherwise(closed)).otherwise("")
    before = F.when(first & F.col("opened"), F.lit(closed)).otherwise("")
    # only the very first turn of a conversation has nothing to close: it starts from state 0
    begun = found.groupBy("key").agg(F.min("place").alias("first_place")).withColumnRenamed("key", "k")
    found = found.join(begun, F.col("key").eqNullSafe(F.col("k"))).withColumn("opened", F.col("place") != F.col("first_place"))
    return found.select(
        F.col("key").alias(key), F.col("order").alias(order), F.col("role").alias(role), "new_role", "action", "inserted", "cost",
        F.concat(before, head, content, tail).alias("rendered"),
    )
