import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierline.llm.queries import ORACLE
from tierline.llm.quotes import parse_lines, reply_ordered

SCHEMA = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()),
                     StructField("role", StringType()), StructField("text", StringType())])

THREAD = [
    (1, 0, "user", "How do I sort a list?\nIt has many rows."),
    (1, 1, "assistant", "Alice wrote:\n> How do I sort a list?\nCall sorted on it."),
    (1, 2, "user", "> > how do I   sort a LIST?\n> Call sorted on it.\nThanks, and in reverse?"),
    (1, 3, "assistant", "> It has many rows.\nThen use an index."),
    (1, 4, "user", ">> Call sorted on it.\n> Thanks, and in reverse?\n> unknown line\nAnyone?"),
    (1, 5, "user", "No quotes here, a > b though."),
]


def rows_of(spark, rows):
    out = reply_ordered(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    return {(r.conv_id, r.turn): r for r in out}


def test_links_order_and_own_text(spark):
    got = rows_of(spark, THREAD)
    assert {t: r.parent_turn for (_, t), r in got.items()} == {0: None, 1: 0, 2: 1, 3: 0, 4: 2, 5: None}
    assert {t: (r.root_turn, r.depth) for (_, t), r in got.items()} == {
        0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (0, 1), 4: (0, 3), 5: (5, 0)}
    assert {t: (r.n_quoted, r.n_linked) for (_, t), r in got.items()} == {
        0: (0, 0), 1: (1, 1), 2: (2, 2), 3: (1, 1), 4: (3, 2), 5: (0, 0)}
    assert got[1, 1].own_text == "Call sorted on it."
    assert got[1, 4].own_text == "Anyone?"
    assert got[1, 5].own_text == "No quotes here, a > b though."
    order = sorted(got.values(), key=lambda r: (r.root_turn, r.depth, r.turn))
    assert [r.turn for r in order] == [0, 1, 3, 2, 4, 5]
    for r in got.values():
        assert r.own_sha256 == hashlib.sha256(r.own_text.encode()).hexdigest()


def test_levels(spark):
    df = spark.createDataFrame([(1, 0, "u", "a\n> b\n>> c\n > > > d\nBob wrote:\n> e\nBob wrote:\nf")], SCHEMA)
    got = [(r.level, r.norm) for r in parse_lines(df).orderBy("line_no").collect()]
    assert got == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (-1, "bob wrote:"), (1, "e"), (0, "bob wrote:"), (0, "f")]


def test_long_reply_chain(spark):
    rows = [(7, 0, "u", "line 0")] + [(7, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    got = rows_of(spark, rows)
    assert all((got[7, i].root_turn, got[7, i].depth) == (0, i) for i in range(40))


def test_edges(spark):
    rows = [(1, 0, None, None), (1, 1, "u", ""), (1, 2, "u", ">"), (1, 3, "u", "> \n>>\n"), (None, 0, "u", "> x"),
            (2, None, "u", "x"), (2, 0, "u", "> later"), (2, 1, "u", "later"), (3, 0, "u", "same"), (3, 1, "u", "same"),
            (3, 2, "u", "> same"), (3, 2, "u", "> same"), (4, 0, "u", "y" * 200_000), (4, 1, "u", "> " + "y" * 200_000)]
    out = reply_ordered(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    got = {(r.conv_id, r.turn): r for r in out}
    assert got[2, 0].parent_turn is None and got[2, 0].n_linked == 0     # the original comes later
    assert got[3, 2].parent_turn == 1 and got[3, 2].n_quoted == 1       # the latest that has it
    assert got[4, 1].parent_turn == 0
    assert got[1, 2].own_text == "" and got[1, 3].own_text == ""
    assert reply_ordered(spark, spark.createDataFrame([], SCHEMA)).collect() == []


MARK = re.compile(r"^((?:[ \t]*>)+)")
WROTE = re.compile(r"^[^>]*\b(wrote|writes|schrieb|escribió|écrit)[ \t]*:[ \t]*$")


def pieces(text):
    """(own texts, quoted lines as (level, the line's, its paragraph's and its passage's text))."""
    lines, parsed = re.split("\r\n|\r|\n", text or ""), []
    for i, line in enumerate(lines):
        m = MARK.match(line)
        level = m[1].count(">") if m else 0
        if WROTE.match(line) and i + 1 < len(lines) and MARK.match(lines[i + 1]):
            level = -1
        parsed.append((level, " ".join(MARK.sub("", line).split()).lower()))
    runs, before = [], None
    for level, norm in parsed:          # passages of paragraphs of lines
        if level != before:
            runs.append((level, [[]]))
        elif not norm:
            runs[-1][1].append([])
        if norm:
            runs[-1][1][-1].append(norm)
        before = level
    own, quoted = set(), []
    for level, paragraphs in runs:
        whole = " ".join(x for p in paragraphs for x in p)
        for p in paragraphs:
            if level == 0 and p:
                own |= {*p, " ".join(p)}
            if level > 0:
                quoted += [(level, {x, " ".join(p), whole}) for x in p]
    everything = " ".join(x for level, ps in runs if level == 0 for p in ps for x in p)
    return own | ({everything} if everything else set()), quoted


def brute_links(rows):
    """(conv_id, turn) -> (parent_turn, n_quoted, n_linked), message by message."""
    out, texts = {}, {}
    for conv, turn, _, text in rows:
        texts.setdefault((conv, turn), set()).add(text or "")
    own = {k: set().union(*[pieces(t)[0] for t in ts]) for k, ts in texts.items()}
    for (conv, turn), ts in texts.items():
        quoted = [q for t in ts for q in pieces(t)[1]]
        earlier = sorted(t for c, t in texts if c == conv and t < turn)
        candidates = {max(t for t in earlier if u in own[conv, t]) for level, us in quoted if level == 1 for u in us
                      if any(u in own[conv, t] for t in earlier)}
        score = {o: sum(level == 1 and bool(us & own[conv, o]) for level, us in quoted) for o in candidates}
        parent = max(score, key=lambda o: (score[o], o)) if score else None
        out[conv, turn] = (parent, len(quoted), sum(any(us & own[conv, t] for t in earlier) for _, us in quoted))
    return out


def some_thread(rng, conv, turns):
    """Messages that quote earlier ones: nested, wrapped anew, in part, with greetings."""
    rows, said = [], []
    for turn in range(turns):
        lines = []
        for _ in range(rng.randrange(3)):
            if said:
                old = rng.choice(said).split("\n")
                at = rng.randrange(len(old))
                part = old[at:at + rng.randrange(1, 6)] if rng.random() < 0.6 else old
                if rng.random() < 0.4:
                    words, part = " ".join(part).replace(">", " ").split(), []
                    while words:
                        n = rng.randrange(1, 7)
                        part.append(" ".join(words[:n]))
                        words = words[n:]
                if rng.random() < 0.3:
                    lines.append("Ann wrote:")
                lines += [f">{' ' * rng.randrange(2)}{x}" for x in part]
        if rng.random() < 0.4:
            lines.append("Hi Bob,")
        for _ in range(rng.randrange(4)):
            lines.append(" ".join(rng.choice("the list is sorted then why not a row of them".split()) for _ in range(rng.randrange(1, 6))))
            if rng.random() < 0.3:
                lines.append("")
        lines += ["Thanks,"] * (rng.random() < 0.4)
        said.append("\n".join(lines))
        rows.append((conv, turn, rng.choice(["user", "assistant"]), said[-1]))
    return rows


def by_sql(rows):
    names = ["conv_id", "turn", "parent_turn", "root_turn", "depth", "n_quoted", "n_linked", "own_sha256"]
    want = duckdb.connect()
    want.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    want.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return names, sorted(want.sql(f"SELECT {', '.join(names)} FROM ({ORACLE['op2_quote_threads']})").fetchall(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_threads(spark, seed):
    rng = random.Random(seed)
    rows = [r for conv in range(25) for r in some_thread(rng, conv, rng.randrange(1, 9))] + some_thread(rng, 99, 120)
    got = rows_of(spark, rows)
    assert {k: (r.parent_turn, r.n_quoted, r.n_linked) for k, r in got.items()} == brute_links(rows)
    assert sum(r.parent_turn is not None for r in got.values()) > 60
    names, sql = by_sql(rows)
    assert sorted((tuple(r[n] for n in names) for r in got.values()), key=repr) == sql


def test_greetings_pull_no_reply(spark):
    rows = [(1, 0, "u", "Hi Bob,\nThanks,"), (1, 4, "u", "Hi Bob,\nThe list is sorted.\nThanks,"),
            (1, 5, "u", "> Hi Bob,\n> The list is sorted.\n> Thanks,\nFine."),
            (2, 0, "u", "The list is sorted and has many rows. All of them are new."),
            (2, 1, "u", "> The list is sorted and has\n> many rows. All of them are new.\nGood.")]
    got = rows_of(spark, rows)
    assert got[1, 5].parent_turn == 4 and got[1, 5].n_linked == 3
    assert got[2, 1].parent_turn == 0 and got[2, 1].n_linked == 2


def test_other_columns_may_have_the_operators_names(spark):
    df = spark.createDataFrame(THREAD, SCHEMA)
    clash = df.withColumns({c: F.lit("x") for c in ("digest", "level", "print", "at", "origin", "lines", "own_text", "depth")})
    key = lambda r: (r.conv_id, r.turn)
    assert sorted(reply_ordered(spark, clash).collect(), key=key) == sorted(reply_ordered(spark, df).collect(), key=key)


def test_sql_agrees_on_quoting_messages(spark):
    names, sql = by_sql(THREAD)
    got = rows_of(spark, THREAD).values()
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == sql
