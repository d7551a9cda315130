import numpy as np

from quayside.llm import passages as P


def brute(rows):
    """Ids of documents that share a window of LEAST words with another."""
    where = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        for k in range(len(w) - P.LEAST + 1):
            where.setdefault(tuple(w[k:k + P.LEAST]), set()).add(i)
    return {i for ids in where.values() if len(ids) > 1 for i in ids if i is not None}


def found(spark, rows):
    return P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def test_gear_equals_its_definition():
    data = np.random.default_rng(1).integers(0, 256, 300, dtype=np.uint8)
    h = 0
    want = []
    for b in data.tolist():
        h = (h * 2 + int(P._GEAR[b])) & 0xFFFFFFFF
        want.append(h & int(P.CUT_BITS))
    assert [int(x) & int(P.CUT_BITS) for x in P.gear(data)] == want


def chunks(words):
    return list(zip(*(x.tolist() for x in P.chunk_arrays(words))))


def test_chunks_cover_the_text_and_resist_insertions(rng):
    words = [f"w{rng.randrange(900)}".encode() for _ in range(3000)]
    c = chunks(words)
    assert [x[1] for x in c] == list(np.cumsum([0, *(x[2] for x in c)][:-1])) and sum(x[2] for x in c) == 3000
    moved = chunks(words[:1000] + [b"inserted"] + words[1000:])
    assert len({x[0] for x in c} - {x[0] for x in moved}) <= 4
    assert chunks([]) == [] and max(x[2] for x in chunks([b"a"] * 1000)) <= P.LONGEST
    assert all((x[3] == 0) == (x[1] + P.LEAST > 3000) for x in c)


def test_planted_passages(spark, rng):
    def prose(n):
        return [f"w{rng.randrange(20000)}" for _ in range(n)]

    rows, n = [], 0
    for length in [49, 50, 51, 52, 55, 60, 80, 200] * 6:
        passage = prose(length)
        for _ in range(rng.choice([2, 3])):
            rows.append((n, " ".join(prose(rng.randrange(100)) + passage + prose(rng.randrange(100)))))
            n += 1
    line = prose(12)
    for _ in range(40):
        rows.append((n, " ".join(prose(60) + line + prose(60))))
        n += 1
    copy = " ".join(prose(90))
    rows += [(n + k, copy) for k in range(20)]
    # a long run shared by some, a part of it by a document that has only that
    base = prose(300)
    rows += [(n + 100, " ".join(base)), (n + 101, " ".join(base)), (n + 102, " ".join(prose(50) + base[100:153] + prose(50)))]
    got = found(spark, rows)
    assert {r.doc_id for r in got} == brute(rows)
    assert all(r.n_words >= P.LEAST and r.first_doc_id <= r.doc_id for r in got)


def test_small_table(spark, small_rows):
    assert {r.doc_id for r in found(spark, small_rows)} == brute(small_rows)


def test_odd_documents(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None]
    assert {r.doc_id for r in P.repeated_passages(odd_docs).collect()} == brute(rows)


def test_removal(spark, rng):
    passage = [f"p{k}" for k in range(80)]
    rows = [(1, " ".join(["a"] * 3 + passage + ["b"])), (2, " ".join(["c"] + passage)), (3, "x y"), (4, None)]
    got = {r.doc_id: r.text for r in P.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[3] == "x y" and got[4] is None and len(got[2].split()) < 30


def brute_passages(rows):
    """doc_id -> [(start, words, smallest doc_id that shares a window)]."""
    first, where = {}, {}
    for i, t in rows:
        w = t.encode().lower().split()
        for k in range(len(w) - P.LEAST + 1):
            where.setdefault(tuple(w[k:k + P.LEAST]), []).append((i, k))
    for at in where.values():
        if len({i for i, _ in at}) > 1:
            for i, k in at:
                first.setdefault(i, {})[k] = min(j for j, _ in at)
    out = set()
    for i, starts in first.items():
        runs = []
        for k in sorted(starts):
            if runs and k <= runs[-1][1]:
                runs[-1] = (runs[-1][0], k + P.LEAST, min(runs[-1][2], starts[k]))
            else:
                runs.append((k, k + P.LEAST, starts[k]))
        out |= {(i, a, b - a, f) for a, b, f in runs}
    return out


def test_several_passages_in_a_document(spark, rng):
    """Long boilerplate with shorter passages beside it: start, length and
    first document of each."""
    def prose(n):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(n)]

    plate, base = prose(200), prose(400)
    rows, n = [], 0
    for length in [51, 52, 53, 55, 58, 60, 65, 70] * 6:
        passage = prose(length)
        for _ in range(2):
            parts = [plate, passage]
            rng.shuffle(parts)
            rows.append((n, " ".join(prose(30) + parts[0] + prose(40) + parts[1] + prose(30))))
            n += 1
    rows += [(n + k, " ".join(base)) for k in range(3)]
    # two families of long copies with a short passage in common
    for _ in range(6):
        short = prose(rng.randint(51, 56))
        for _ in range(2):
            family = " ".join(prose(90) + short + prose(90))
            rows += [(n + 10, family), (n + 11, family)]
            n += 10
    for k in range(8):
        rows.append((n + 20 + k, " ".join(prose(20) + base[30 * k:30 * k + 53] + prose(20))))
    got = found(spark, rows)
    assert {(r.doc_id, r.start_word, r.n_words, r.first_doc_id) for r in got} == brute_passages(rows)


def test_removal_keeps_one_copy_of_each_passage(spark):
    """A document holds a passage of a smaller one directly followed by one
    that only a larger document has too."""
    p1, p2 = [f"p{k}" for k in range(80)], [f"q{k}" for k in range(80)]
    rows = [(1, " ".join(["a"] * 3 + p1 + ["b"])), (10, " ".join(["c"] + p1 + p2 + ["d"])), (50, " ".join(["e"] + p2 + ["f"]))]
    got = {r.doc_id: r.text for r in P.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 10: " ".join(["c"] + p2 + ["d"]), 50: "e f"}
