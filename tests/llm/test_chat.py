import itertools
import random

import pytest

from sluice.llm import chat
from sluice.llm.chat import ASSISTANT, CLOSE, FINAL, INSERT, LEGAL, MERGE, OPEN, RELABEL, ROLES, START, format_chats, repair


def brute(roles):
    """The least cost over all ways: each turn gets a role, is merged or not; empty messages fill every gap."""
    def fill(state, goal):
        """Fewest empty messages so that ``goal`` may follow ``state``."""
        layer, seen = {state}, 0
        while not any(goal in LEGAL[s] for s in layer):
            layer, seen = {t for s in layer for t in LEGAL[s]}, seen + 1
            if seen > 4:
                return None
        return seen

    def end(state):
        layer, seen = {state}, 0
        while not layer & set(FINAL):
            layer, seen = {t for s in layer for t in LEGAL[s]}, seen + 1
        return seen

    best = None
    for targets in itertools.product(ROLES, repeat=len(roles)):
        for merges in itertools.product((False, True), repeat=len(roles)):
            state, cost = START, 0
            for role, target, merge in zip(roles, targets, merges):
                cost += RELABEL * (ROLES[target] != role)
                if merge:
                    if target != state:
                        break
                    cost += MERGE
                else:
                    empties = fill(state, target)
                    if empties is None:
                        break
                    cost += INSERT * empties
                state = target
            else:
                cost += INSERT * end(state)
                best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_costs_are_least(n):
    for roles in itertools.product(("system", "user", "assistant", None), repeat=n):
        cost, moves = repair(list(roles))
        assert cost == brute(roles), roles
        state, paid = START, 0
        for role, move in zip(roles, moves):
            if move.empty is not None:
                assert move.empty in LEGAL[state]
                state = move.empty
            assert move.after == state if move.action.endswith("merge") else move.after in LEGAL[state]
            assert ("relabel" in move.action) == (ROLES[move.after] != role)
            state, paid = move.after, paid + move.cost
        more, empties = chat.closing(state)
        for empty in empties:
            assert empty in LEGAL[state]
            state = empty
        assert state == ASSISTANT and paid + more == cost


def rendered(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (str(r.conv_id), r.position)):
        out[r.conv_id] = out.get(r.conv_id, "") + r.rendered
    return out


def test_conversations(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "USER ", "a"), (2, 1, "user", "b"), (3, 0, "assistant", "x"),
        (4, 0, "system", "s"), (5, 0, None, None), (6, None, "bot", "<|im_end|>"), (6, 1, "user", ""), (None, 3, "user", "n"), (None, 3, "user", "n"),
    ]
    df = spark.createDataFrame([(*t, "p") for t in turns], "conv_id long, turn long, role string, text string, position string")
    got = format_chats(df).collect()
    texts = rendered(got)
    o, c = OPEN, CLOSE + "\n"
    assert texts[1] == f"{o}user\nhi{c}{o}assistant\nyes{c}".replace("hi<", "hi<")
    assert texts[2] == f"{o}user\na\nb{c}{o}assistant\n{c}"
    assert texts[3] == f"{o}user\n{c}{o}assistant\nx{c}"
    assert texts[4] == f"{o}system\ns{c}{o}user\n{c}{o}assistant\n{c}"
    assert texts[None] == f"{o}user\nn\nn{c}{o}assistant\n{c}"
    assert texts[6].count(CLOSE) == texts[6].count(OPEN) and "< |im_end|>" in texts[6]
    assert len([r for r in got if r.turn is not None or r.action != "insert"]) == len(turns)
    assert len({(r.conv_id, r.position) for r in got}) == len(got)
    assert format_chats(df.limit(0)).count() == 0


def test_conversation_cut_by_partitions(spark):
    roles = ["user", "user", "assistant", "bot", "system", "assistant", "user", "assistant", "assistant", "user"] * 40
    rows = [(1000 if 20 <= i < 390 else i, i, role, f"t{i}") for i, role in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    results = []
    for parts in (1, 8, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            results.append(sorted(map(tuple, format_chats(df).collect()), key=repr))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for got in results:
        big = [r for r in got if r[0] == 1000]
        cost, _ = repair([chat.known_role(r) for r in roles[20:390]])
        price = {"keep": 0, "insert": INSERT, "merge": MERGE, "relabel": RELABEL, "relabel+merge": RELABEL + MERGE}
        assert sum(price[r[4]] for r in big) == cost
        assert sum(r[2] is not None for r in big) == 370
    assert [r[:2] + r[5:] for r in results[0] if r[0] != 1000] == [r[:2] + r[5:] for r in results[2] if r[0] != 1000]


@pytest.mark.parametrize("part", [1, 3, 16])
def test_parts_within_a_partition_change_nothing(spark, monkeypatch, part):
    rng = random.Random(part)
    turns = []
    for conv in [*range(30), None]:
        for i in range(rng.choice([1, 2, 5, 40, 120])):
            turns.append((conv, i, rng.choice(["user", "assistant", "user", "assistant", "system", "bot", None]), f"t{conv}-{i}"))
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    price = {"keep": 0, "insert": INSERT, "merge": MERGE, "relabel": RELABEL, "relabel+merge": RELABEL + MERGE}

    def outcome():
        got = format_chats(df).collect()
        costs, count = {}, {}
        for r in got:
            costs[r.conv_id] = costs.get(r.conv_id, 0) + price[r.action]
            count[r.conv_id] = count.get(r.conv_id, 0) + (r.turn is not None)
        texts = rendered(got)
        assert all(t.count(OPEN) == t.count(CLOSE) and t.endswith(CLOSE + "\n") for t in texts.values())
        assert len({(r.conv_id, r.position) for r in got}) == len(got)
        return costs, count

    whole = outcome()
    monkeypatch.setattr(chat, "PART", part)
    assert outcome() == whole
    assert whole[0] == {c: repair([chat.known_role(r) for k, _, r, _ in turns if k == c])[0] for c in whole[0]}
