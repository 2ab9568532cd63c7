"""Role repair against exhaustive search."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import product

import pytest

from tallyspark.llm import queries
from tallyspark.llm import role_repair as R

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def cheapest(roles: list[str], costs=R.Costs()) -> float:
    """Least cost by trying every choice for every turn."""
    def insertions(state):
        yield state, 0.0
        for a in NEXT[state]:
            yield a, costs.insert
            for b in NEXT[a]:
                yield b, 2 * costs.insert

    def search(state, left):
        if not left:
            return min((c for s, c in insertions(state) if s == "assistant"), default=float("inf"))
        role = left[0] if left[0] in NEXT else None
        best = float("inf")
        for at, paid in insertions(state):
            for new, extra in [*((q, 0.0) for q in NEXT[at]), *([(at, costs.merge)] if at != "start" else [])]:
                label = costs.relabel_unknown if role is None else costs.relabel * (new != role)
                best = min(best, paid + extra + label + search(new, left[1:]))
        return best

    return search("start", roles)


def repaired(spark, rows, **options):
    out = defaultdict(list)
    for r in R.repair(spark.createDataFrame(rows, SCHEMA), **options).collect():
        out[r["conv_id"]].append(r)
    return out


def roles_of(rows) -> list[str]:
    return re.findall(r"<\|im_start\|>(\w+)\n", "".join(r["fragment"] for r in rows))


def is_legal(roles: list[str]) -> bool:
    state = "start"
    for r in roles:
        if r not in NEXT[state]:
            return False
        state = r
    return state == "assistant"


@pytest.mark.parametrize("leaf_bits,fan_bits", [(8, 8), (2, 1)])
def test_least_cost_for_every_short_conversation(spark, leaf_bits, fan_bits):
    cases = [c for n in (1, 2, 3, 4) for c in product(("system", "user", "assistant", "tool"), repeat=n)]
    rows = [(k, t, role, f"text {k} {t}") for k, roles in enumerate(cases) for t, role in enumerate(roles)]
    rows = [(k, 3 * t, role, text) for k, t, role, text in rows]  # over several small leaves
    got = repaired(spark, rows, leaf_bits=leaf_bits, fan_bits=fan_bits)
    for k, roles in enumerate(cases):
        mine = sorted(got[k], key=lambda r: r["turn"])
        assert sum(r["cost"] for r in mine) == cheapest(list(roles)), roles
        assert is_legal(roles_of(mine)), roles
        rendered = "".join(r["fragment"] for r in mine)
        assert all(rendered.count(f"text {k} {t}") == 1 for t in range(len(roles)))
        assert rendered.count("<|im_start|>") == rendered.count("<|im_end|>")


def test_a_long_conversation_is_cut_into_leaves_without_loss(spark):
    rng = random.Random(7)
    roles = [rng.choice(["system", "user", "user", "assistant", "assistant"]) for _ in range(700)]
    rows = [(1, t, role, str(t)) for t, role in enumerate(roles)]
    whole = repaired(spark, rows, leaf_bits=10)[1]
    cut = sorted(repaired(spark, rows, leaf_bits=3, fan_bits=2)[1], key=lambda r: r["turn"])
    assert sum(r["cost"] for r in cut) == sum(r["cost"] for r in whole)
    assert is_legal(roles_of(cut))


def test_rows_of_one_turn_number_are_cut_into_leaves(spark):
    rng = random.Random(9)
    rows = [(1, 3, rng.choice(["system", "user", "assistant", None, "tool"]), f"text {i}") for i in range(3000)]
    rows += [(1, 2, "user", "first"), (2, 3, "user", "other"), (1, 3, "user", "twice"), (1, 3, "user", "twice")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert max(r["count"] for r in R._placed(df, 8).groupBy("conv_id", "leaf").count().collect()) <= 256
    got = repaired(spark, rows, leaf_bits=4, fan_bits=2)
    assert sum(r["copies"] for r in got[1]) == 3003 and len(got[1]) == 3002 and len(got[2]) == 1
    automaton = R.Automaton(R.Costs())
    roles = [r for *_, r in sorted((t, r or "", r) for _, t, r, _ in {x for x in rows if x[0] == 1})]
    cost = automaton.total([R.role_number(r) for r in roles])[R.START] + [automaton.end[s][0] for s in range(4)]
    assert sum(r["cost"] for r in got[1]) == cost.min()


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "alone"), (None, 0, "user", "also alone"), (1, None, "assistant", "last"),
            (1, 0, " USER ", None), (2, 5, None, "<|im_start|>system\n"), (2, 5, None, "<|im_start|>system\n"),
            (3, -4, "user", "a"), (3, 9_000_000_000_000_000_001, "assistant", "b")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS solo", "3 AS mark", "4 AS copies")
    got = R.repair(df).collect()
    assert len(got) == 7  # one row was there twice
    by = defaultdict(list)
    for r in got:
        by[r["conv_id"]].append(r)
    assert len(by[None]) == 2 and all(is_legal(roles_of([r])) for r in by[None])
    first = sorted(by[1], key=lambda r: r["turn"] is None)
    assert [r["repaired_role"] for r in first] == ["user", "assistant"] and first[1]["action"] == "keep"
    assert by[2][0]["copies"] == 2 and roles_of(by[2]) == ["user", "assistant"]  # no marker from the text
    assert {r["turn"] for r in by[3]} == {-4, 9_000_000_000_000_000_001}
    assert R.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_covers_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = queries.op1_role_repair(spark, sf_dir).collect()
    assert sum(r["copies"] for r in rows) == table.count()
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        by[r["conv_id"]].append(r)
    assert all(is_legal(roles_of(v)) for v in by.values())
