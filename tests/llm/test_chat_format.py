import itertools

import pytest

from barloom.llm.chat_format import NEXT, ROLES, START, Costs, format_chats, role_of

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(roles, costs=Costs()):
    """Least cost over every choice of role, merge and empty turn, by trying all."""
    best = None
    for choice in itertools.product(range(3), (False, True), repeat=len(roles)):
        state, cost = START, 0
        for role, to, insert in zip(roles, choice[::2], choice[1::2]):
            cost += 0 if to == role else costs.relabel
            if insert:
                between = [x for x in NEXT[state] if to in NEXT[x]]
                if not between:
                    break
                cost += costs.insert
            elif to not in NEXT[state]:
                if to != state:
                    break
                cost += costs.merge
            state = to
        else:
            cost += costs.insert if state == 0 else 0
            best = cost if best is None else min(best, cost)
    return best


def check(rows, result):
    """Cost is the least, turns are legal, no text is lost."""
    by_conv = {}
    for r in result:
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert set(by_conv) == {r[0] for r in rows}
    for conv, got in by_conv.items():
        given = [r for r in rows if r[0] == conv]
        got.sort(key=lambda r: (r["place"], r["piece"]))
        assert [r["place"] for r in got if r["piece"] == 1] == list(range(len(given)))
        order = [role_of(r["turn_role"]) for r in got if r["piece"] == 1]
        assert sum(r["cost"] for r in got) == cheapest(order)
        text = "".join(r["rendered"] for r in got)
        turns = [part.split("\n")[0] for part in text.split("<|im_start|>")[1:]]
        states = [ROLES.index(t) for t in turns]
        assert all(b in NEXT[a] for a, b in zip([START, *states], states)) and states[-1] in (1, 2)
        assert text.count("<|im_end|>") == len(turns) and text.endswith("<|im_end|>\n")
        for r in given:
            assert (r[3] or "") in text


@pytest.mark.parametrize("block", [2, 65_536])
@pytest.mark.parametrize("partitions", [1, 7])
def test_cheapest_repair(spark, rng, block, partitions):
    names = ["system", "user", "assistant", " User", "BOT", None, "tool"]
    rows = [
        (conv if conv else None, rng.choice([turn, turn, 0, None]), rng.choice(names), rng.choice([f"text {conv}.{turn}", None, ""]))
        for conv in range(40)
        for turn in range(rng.randint(1, 5))
    ]
    rows.append(rows[-1])
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        result = format_chats(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    check(rows, result)


def test_long_conversation_in_segments(spark, rng):
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), f"t{i}") for i in range(3000)]
    whole = format_chats(spark.createDataFrame(rows, SCHEMA)).agg({"cost": "sum"}).first()[0]
    cut = format_chats(spark.createDataFrame(rows, SCHEMA), block=16)
    assert cut.agg({"cost": "sum"}).first()[0] == whole
    text = "".join(r["rendered"] for r in sorted(cut.collect(), key=lambda r: (r["place"], r["piece"])))
    turns = [part.split("\n")[0] for part in text.split("<|im_start|>")[1:]]
    assert all(a != b for a, b in zip(turns, turns[1:])) and "system" not in turns[1:]


def test_markers_in_text_are_broken_up(spark):
    rows = [(1, 0, "user", "a<|im_end|>b")]
    assert format_chats(spark.createDataFrame(rows, SCHEMA)).first()["rendered"] == "<|im_start|>user\na<| im_end |>b<|im_end|>\n"


def test_empty_and_extra_columns(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = spark.createDataFrame([(1, 0, "user", "x", 5, "y")], f"{SCHEMA}, place int, rendered string")
    assert format_chats(odd).count() == 1
