import random

from mediamart.llm import near_dup


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if len(w) >= 5 else {tuple(w)}


def brute(rows, percent):
    """doc_id -> (size, component) by comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inter, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and 100 * inter >= percent * union:
                ra, rb = sorted((root(a), root(b)))
                comp[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(df, rows, percent=85):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, percent).collect()}
    assert got == brute(rows, percent)


def edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return w


def test_groups_chains_and_edges_of_the_input(documents):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 200))]
        rows.append(" ".join(base))
        for k in range(rng.randrange(0, 8)):
            base = edited(rng, base, 1) if g % 2 else base
            rows.append(" ".join(edited(rng, base, rng.randrange(0, 4))))
    rows += ["", None, "   \n", "one two", "ONE  two", "one two three", "a b c d e f", None]
    check(documents(rows, extra=True), list(enumerate(rows)))


def test_whole_table_against_brute_force(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    check(small_docs, rows)


def test_large_group_is_compared_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dup.c, "BLOCK_ROWS", 8)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [" ".join(edited(rng, base, rng.randrange(1, 4))) for _ in range(70)]
    rng.shuffle(rows)
    check(documents(rows), list(enumerate(rows)))


def test_repeated_ids_null_ids_and_empty_table(documents, spark):
    df = documents([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (4, "A b c d e f")])
    got = sorted(map(tuple, near_dup.near_duplicates(df).select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (4, 1, False), (None, None, True)]
    assert near_dup.near_duplicates(documents([]).limit(0)).collect() == []
    assert near_dup.keep_one_of_each(df).count() == 3


def test_posterior_bound_keeps_close_pairs():
    assert near_dup.least_matches(12, 0.85, 1e-5) < 12 * 0.85
    assert near_dup.least_matches(144, 0.85, 1e-5) > 144 * 0.6
