import collections

from quayside.llm import neardup as N


def sets_of(rows, size):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    return out


def brute(rows, size, percent):
    """doc_id -> (set size, component)."""
    sets, parent = sets_of(rows, size), {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = collections.defaultdict(list)
    for i in sorted(sets):
        both = collections.Counter(j for s in sets[i] for j in seen[s])
        for s in sets[i]:
            seen[s].append(i)
        for j, n in both.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def result(spark, rows, size, percent):
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, percent).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def test_small_table(spark, small_rows):
    assert result(spark, small_rows, 3, 85) == brute(small_rows, 3, 85)


def test_families_and_chains(spark, rng):
    """Copies, a family of near copies of each other, and a chain whose ends
    are not alike."""
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n, " ".join(words)))
        n += 1

    for _ in range(40):
        add(rng.choices(vocabulary, k=rng.randint(1, 80)))
    base = rng.choices(vocabulary, k=120)
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        add(w)
    for _ in range(30):
        add(base)
    chain = rng.choices(vocabulary, k=150)
    for _ in range(25):
        add(chain)
        at = rng.randrange(140)
        chain = chain[:at] + rng.choices(vocabulary, k=4) + chain[at + 4:]
    assert result(spark, rows, 3, 85) == brute(rows, 3, 85)
    assert result(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_sparse_links_in_a_template_family(spark, rng):
    """A thousand texts on one template, below the threshold to each other,
    and a few pairs of them just above it."""
    template = [f"t{k}" for k in range(602)]
    rows = []
    for k in range(1000):
        rows.append((k, " ".join(template + [f"d{k}x{j}" for j in range(60)])))
    for k in range(20):
        own = [f"e{k}x{j}" for j in range(8)]
        for side in range(2):
            rows.append((1000 + 7 * k + 3 * side, " ".join(template + own + [f"f{k}y{side}x{j}" for j in range(52)])))
    # 600 common shingles of 720 in all (83%); 608 of 712 in a pair (85.4%)
    want = {i: (660, i) for i, _ in rows} | {1003 + 7 * k: (660, 1000 + 7 * k) for k in range(20)}
    assert result(spark, rows, 3, 85) == want


def test_odd_documents(spark, odd_docs):
    got = N.near_duplicates(odd_docs, 5, 80).collect()
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by_id[0] == {(0, 0, True)} and by_id[1] == {(0, 1, True)}  # null, empty: no links
    assert {c for _, c, _ in by_id[16] | by_id[17]} == {16} and by_id[None] == {(by_id[16].copy().pop()[0], None, True), (0, None, True)}
    kept = N.deduplicated(odd_docs).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 16 in ids and 17 not in ids
