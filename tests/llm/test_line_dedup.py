import hashlib
import random

from tierline.llm.line_dedup import align, common_blocks, drop_repeated_lines, line_dedup

LEAST = 4


def lines_of(text):
    return [x.encode().strip() for x in (text or "").split("\n")]


def brute(rows, rare_df):
    """Nearest earlier holder of a rare line, first holder of any other, then alignment."""
    texts = dict(rows)
    held = {}
    for i in sorted(texts):
        for x in {x for x in lines_of(texts[i]) if len(x.split()) >= LEAST}:
            held.setdefault(x, []).append(i)
    pairs = set()
    for ids in held.values():
        pairs |= {(a if len(ids) <= rare_df else ids[0], b) for a, b in zip(ids, ids[1:])}
    gone = {i: set() for i in texts}
    for a, b in pairs:
        x, y = lines_of(texts[a]), lines_of(texts[b])
        code = {v: n + 1 for n, v in enumerate(dict.fromkeys(v for v in x + y if v))}
        matched = align([code.get(v, 0) for v in x], [code.get(v, 0) for v in y])
        block = []
        for i, j in [*matched, (-9, -9)]:
            if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
                if sum(len(y[q].split()) for _, q in block) >= LEAST:
                    gone[b] |= {q for _, q in block}
                block = []
            block.append((i, j))
    out = {}
    for i, t in texts.items():
        ls = (t or "").split("\n")
        kept = "\n".join(v for n, v in enumerate(ls) if n not in gone[i])
        out[i] = (len(ls), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(spark, df, rows, rare_df=64):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256)
           for r in line_dedup(spark, df, rare_df=rare_df).collect()}
    assert got == brute(rows, rare_df)
    return got


def test_shared_blocks(spark, docs_of):
    rng = random.Random(3)
    pool = [f"shared line number {i} of the pool" for i in range(30)] + ["Of.", "Short one."]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.5:
                k = rng.randrange(28)
                text += pool[k:k + rng.randrange(1, 5)]
            else:
                text.append(f"only here {i} {rng.random()} words")
        rows.append((i, "\n".join(text)))
    check(spark, docs_of(rows), rows)
    check(spark, docs_of(rows), rows, rare_df=3)      # most lines count as stock lines


def test_group_of_copies_beyond_the_rare_bound(spark, docs_of):
    text = "first line of the copy\nOf.\n\nsecond line of the copy\nthe end of it all"
    rows = [(i, text) for i in range(90)] + [(200, "a clean text of its own\n" + text + "\nand one more line here")]
    got = check(spark, docs_of(rows), rows)
    assert got[0][1] == 0 and all(got[i][1] == 5 for i in range(1, 90)) and got[200][:2] == (7, 5)


def test_alignment_by_hand():
    assert align([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 0 + 1), (2, 2)]
    assert align([1, 2, 3], [3, 1, 2]) == [(0, 1), (1, 2)]              # the longer order wins
    assert align([1, 5, 5, 2], [1, 5, 5, 2]) == [(0, 0), (1, 1), (2, 2), (3, 3)]   # grown over repeats
    assert align([7, 7], [7, 7]) == []                                  # nothing unique
    assert align([1, 7, 7, 2], [1, 3, 7, 7, 2]) == [(0, 0), (1, 2), (2, 3), (3, 4)]
    assert align([], [1]) == []


def test_edges(spark, docs_of, with_clashes):
    a = "one two three four"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, a), (5, "  " + a + "\t"), (6, a + "\n" + a), (7, "x\r\n" + a + "\r\ny"),
            (8, a.upper()), (9, "w " * 100_000), (10, "w " * 100_000 + "\nz"), (11, "\n".join(f"l {i} of mine" for i in range(5000))),
            (12, "\n".join(f"l {i} of mine" for i in range(2500, 7000)))]
    check(spark, with_clashes(docs_of(rows)), rows)


def test_repeated_rows_and_null_ids(spark, docs_of):
    a = "one two three four"
    out = sorted((r.doc_id if r.doc_id is not None else -1, r.n_removed)
                 for r in line_dedup(spark, docs_of([(2, a), (2, a), (None, a), (3, a)])).collect())
    assert out == [(-1, 0), (2, 0), (2, 0), (3, 1)]
    assert line_dedup(spark, docs_of([])).collect() == []


def test_dropping_keeps_columns_and_emptied_rows_go(spark, docs_of, with_clashes):
    a = "one two three four"
    df = with_clashes(docs_of([(1, a), (2, a), (3, a + "\nrest"), (4, ""), (5, None)]))
    out = drop_repeated_lines(spark, df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, a), (3, "rest"), (4, ""), (5, None)]


def test_repeated_lines_align():
    assert common_blocks([7, 7], [7, 7], [4, 4], LEAST) == [(0, 2)]                     # equal documents
    assert common_blocks([5, 6, 5, 6], [5, 6, 5, 6], [2] * 4, LEAST) == [(0, 4)]
    assert align([7], [7, 7]) == [(0, 0)] and align([7, 7], [7]) == [(0, 0)]
    assert align([5, 6, 5, 6], [6, 5, 6, 5]) == [(0, 1), (1, 2), (2, 3)]                # k-th with k-th, then grown
    assert align([1, 8, 7, 7, 9, 2], [1, 3, 7, 7, 4, 2]) == [(0, 0), (2, 2), (3, 3), (5, 5)]   # in a gap
    assert align([7, 7, 8, 8, 7], [7, 8, 8, 7]) == [(1, 0), (2, 1), (3, 2), (4, 3)]     # the longer end first


def test_copies_of_repeated_lines_go(spark, docs_of):
    spam = "\n".join(["buy this one thing now"] * 6)
    verse = "a line of the verse\nand the refrain of it\n" * 2
    got = {r.doc_id: r.n_removed for r in line_dedup(spark, docs_of(
        [(1, spam), (2, spam), (3, verse), (4, verse), (5, "own words of this one\n" + spam)])).collect()}
    assert got == {1: 0, 2: 6, 3: 0, 4: 5, 5: 6}


def test_blocks_of_short_lines_nominate(spark, docs_of):
    verse = "roses\nare red\n\nviolets\nare blue"
    rows = [(1, verse), (2, verse), (3, "my own\nroses\nare red\n\nviolets\nend"), (4, "roses\nare red\nviolets\nnot"),
            (5, "x\n" * 300), (6, "x\n" * 300), (7, "violets\nare blue")]
    got = {r.doc_id: r.n_removed for r in line_dedup(spark, docs_of(rows)).collect()}
    assert got == {1: 0, 2: 5, 3: 4, 4: 0, 5: 0, 6: 301, 7: 0}    # 4: the blank line parts its block; 7: three words


def all_sharers(rows):
    """Lines that go when each document is aligned with every earlier one."""
    seqs = {i: lines_of(t) for i, t in rows}
    code = {v: n + 1 for n, v in enumerate({v for s in seqs.values() for v in s if v})}
    out = {}
    for b in seqs:
        y, words = [code.get(v, 0) for v in seqs[b]], [len(v.split()) for v in seqs[b]]
        out[b] = {q for a in seqs if a < b for s, e in common_blocks([code.get(v, 0) for v in seqs[a]], y, words, LEAST)
                  for q in range(s, e)}
    return {b: len(gone) for b, gone in out.items()}


def test_every_earlier_holder_counts(spark, docs_of):
    m, stock = "this is the line m", "this is the stock line"
    for rows in (
            [(1, m + "\n" + stock)] + [(i, stock + "\n" + m) for i in range(2, 67)],               # crossing order
            [(1, stock)] + [(i, f"own words {i}\n{stock}\nmore own words {i}\n{stock}") for i in range(2, 90)],
            [(i, m) for i in range(80)] + [(80, "Of.\n" + m)] + [(i, m) for i in range(81, 700)] + [(900, "Of.\n" + m)]):
        got = {r.doc_id: r.n_removed for r in line_dedup(spark, docs_of(rows)).collect()}
        assert got == all_sharers(rows)


def test_random_documents_against_all_sharers(spark, docs_of):
    rng = random.Random(5)
    pool = [f"stock line number {i} here" for i in range(12)] + ["Of.", "Short one.", "two words", "", "three of them"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"only here {i} {rng.random()} words"
                          for _ in range(rng.randrange(1, 9)))) for i in range(300)]
    got = {r.doc_id: r.n_removed for r in line_dedup(spark, docs_of(rows)).collect()}
    assert got == all_sharers(rows)
