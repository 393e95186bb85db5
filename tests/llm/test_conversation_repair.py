import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tierline.llm.conversation_repair import Costs, Trails, repair_conversations

SCHEMA = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
                     StructField("text", StringType()), StructField("gone", BooleanType())])
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def ordered(rows):
    def key(r):
        role, text = r[2], r[3]
        return r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()

    return sorted(rows, key=key)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text, _ in rows:
        shown = text.strip(SPACE)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else
                   "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_script(rows, found, costs, inserts):
    """All edit scripts with at most ``inserts`` insertions in a gap: (cost, audit, rows left)."""
    gaps = [g for n in range(inserts + 1) for g in itertools.product(("user", "assistant"), repeat=n)]
    per_row = []
    for (_, _, role, text, _), fault in zip(rows, found):
        more = costs.truncated if fault == "truncated" else 0
        edits = [(costs.delete, "D", [])]
        if fault not in ("blank", "duplicate"):
            edits += [(more, "K", [(role, text)]), (costs.rerole + more, "R", [("user", text)]),
                      (costs.rerole + more, "R", [("assistant", text)])]
        per_row.append(edits)
    before = [(len(g) * costs.insert, "I" * len(g), [(r, "") for r in g]) for g in gaps]
    for parts in itertools.product(*[x for edits in per_row for x in (before, edits)], before):
        left = [row for part in parts for row in part[2]]
        if all(r for r, _ in left) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in left)):
            yield sum(p[0] for p in parts), "".join(p[1] for p in parts), left


def plain_dp(rows, found, costs):
    """The same by states that hold whole strings and outputs."""
    def after(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def closed(states):
        for _ in range(2):
            for s, (c, a, left) in list(states.items()):
                to = "a" if s == "u" else "u"
                cand = (c + costs.insert, a + "I", left + [("assistant" if to == "a" else "user", "")])
                if to not in states or cand[:2] < states[to][:2]:
                    states[to] = cand
        return states

    states = closed({"": (0, "", [])})
    for (_, _, role, text, _), fault in zip(rows, found):
        new = {}

        def offer(to, cand):
            if to is not None and (to not in new or cand[:2] < new[to][:2]):
                new[to] = cand

        for s, (c, a, left) in states.items():
            offer(s, (c + costs.delete, a + "D", left))
            if fault in ("blank", "duplicate"):
                continue
            more = costs.truncated if fault == "truncated" else 0
            offer(after(s, role[:1]), (c + more, a + "K", left + [(role, text)]))
            to = "a" if s == "u" else "u"
            offer(to, (c + more + costs.rerole, a + "R", left + [("assistant" if to == "a" else "user", text)]))
        states = closed(new)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def expected(rows, costs=Costs()):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append((r[0], r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3], r[4]))
    out = {}
    for conv, held in groups.items():
        here = ordered([r for r in held if not r[4]])
        found = faults(here)
        cost, audit, left = plain_dp(here, found, costs)
        turns = {r[1] for r in here if r[1] is not None}
        initials = [r[2][:1] for r in here]
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     *[found.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def check(spark, rows, costs=Costs(), parts=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = [tuple(r) for r in repair_conversations(spark, df, costs, absent=F.col("gone"), **more).collect()]
    want = expected(rows, costs)
    assert len(got) == len(want) and {r[0]: r for r in got} == want


def some_row(rng, conv, turn):
    return (conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
            rng.choice(["Yes.", "No!", "Why?", "cut", "", " \t", None, f"Words {rng.randrange(30)}.", "end. \n"]),
            rng.random() < 0.1)


def some_rows(rng, convs, longest):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(longest + 1)):
            rows.append(some_row(rng, conv, rng.choice([turn, turn, turn + rng.randrange(3), None])))
            if rng.random() < 0.15:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 3, 1, 2), Costs(4, 5, 2, 1), Costs(2, 2, 2, 0)])
def test_plain_program_finds_the_best_of_all_scripts(costs):
    rng = random.Random(str(costs))
    for _ in range(40):
        rows = [r[:2] + (r[2] or " ", r[3] or " ", False) for r in (some_row(rng, 0, t) for t in range(rng.randrange(4)))]
        found = faults(rows)
        best = min(every_script(rows, found, costs, 1 if len(rows) > 2 else 2), key=lambda x: x[:2])
        got = plain_dp(rows, found, costs)
        assert got[:2] == best[:2] and got[2] == best[2]


@pytest.mark.parametrize("costs", [Costs(), Costs(3, 4, 1, 2)])
def test_random_conversations(spark, costs):
    rng = random.Random(5)
    check(spark, some_rows(rng, 120, 9), costs)
    check(spark, some_rows(rng, 40, 30), costs, parts=5, block_rows=4)


def test_one_conversation_over_many_tasks_and_blocks(spark):
    rng = random.Random(8)
    rows = [some_row(rng, 1, t) for t in range(900)] + [some_row(rng, 2, t) for t in range(6)]
    rows += [(3, t, "user", "Same words.", False) for t in range(300)] + [(4, 7, "user", "Same row.", False)] * 200
    check(spark, rows, parts=7, block_rows=16)
    check(spark, rows, Costs(3, 4, 1, 2), parts=2)


def test_edges(spark):
    long = "word " * 200_000 + "."
    rows = [(None, 1, "user", "A.", False), (None, 2, "assistant", "B.", False), (5, 1, "user", "x.", True),
            (6, None, None, None, False), (7, 1, "system", "s.", False), (8, 3, "user", long, False),
            (8, 9, "assistant", long, False), (9, 1, "superuser", "Hi.", False), (9, 2, "user", "Hi.", False),
            (9, 3, "aide", "Yes.", False), (10, -4, "user", "Ü.", False), (10, None, "user", "…!", False)]
    check(spark, rows)
    empty = repair_conversations(spark, spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    nulls = spark.createDataFrame([(None,) * 5] * 3, SCHEMA)
    assert [tuple(r)[:8] for r in repair_conversations(spark, nulls).collect()] == [(None, 0, 3, 0, 0, 2, 6, "DDD")]


def test_other_columns_may_have_the_operators_names(spark):
    rows = some_rows(random.Random(3), 20, 6)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in (
        "uid", "digest", "kind", "here", "blank", "cut", "cost", "audit", "facts", "paths", "gaps")})
    got = {r[0]: tuple(r) for r in repair_conversations(spark, df, absent=F.col("gone")).collect()}
    assert got == expected(rows)


def test_audits_compare_by_longest_common_prefix(monkeypatch):
    def trails_of(texts):
        trails, nodes = Trails(), []
        for t in texts:
            node = 0
            for piece in t:
                node = trails.add(node, piece)
            nodes.append(node)
        return trails, nodes

    rng = random.Random(4)
    texts = ["".join(rng.choice("DK") for _ in range(9)) for _ in range(40)] + ["DDKKDDKKD"] * 2
    for modulus in ((1 << 61) - 1, 3):      # with three hash values nearly everything collides
        monkeypatch.setattr("tierline.llm.conversation_repair._MODULUS", modulus)
        trails, nodes = trails_of(texts)
        for (s, a), (t, b) in itertools.product(zip(texts, nodes), repeat=2):
            assert trails.less(a, b) == (None if s == t else s < t)
