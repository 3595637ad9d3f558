import random

import numpy as np

from cadenza.llm import near_copies, simhash


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def sets(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1)))


def kept(rows):
    """Brute force: the first (doc_id, text) of each component, found pair by pair."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    all_sets = [sets(r[1]) for r in rows]
    for i, a in enumerate(all_sets):
        for j, b in enumerate(all_sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                root[find(i)] = find(j)
    groups: dict = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return list(groups.values())


def changed(rng, words, n):
    out = list(words)
    for p in rng.sample(range(len(words)), n):
        out[p] = f"x{rng.randrange(10**9)}"
    return " ".join(out)


def test_near_copies_by_brute_force(spark):
    rng = random.Random(3)
    rows, levels = [], []
    for _ in range(25):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        base = " ".join(words)
        rows.append((len(rows), base, "s"))
        for n in (1, 2, 3, 4, 6, 8):
            rows.append((len(rows), changed(rng, words, n), "s"))
            a, b = sets(base), sets(rows[-1][1])
            levels.append(len(a & b) / len(a | b))
    rows += [(900, "few words", "s"), (901, "few words", "s"), (902, None, "s"), (903, " ", "s")]
    assert sum(0.8 <= x < 0.95 for x in levels) > 50 and sum(x < 0.75 for x in levels) > 20
    got = sorted(r.doc_id for r in near_copies.keep_one(rows_of(spark, rows)).collect())
    groups = kept([r for r in rows if r[1] and r[1].strip()])
    assert got == sorted([min(r[0] for r in g) for g in groups] + [902])


def test_null_and_repeated_ids(spark):
    own = [f"text number {i} tells a story of its own {'abcdefgh'[i] * 9}" for i in range(6)]
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, t, "s") for t in own[:3]] + [(7, own[3], "s"), (7, own[4], "s"), (8, own[5], "s"), (None, own[5], "s"), (7, own[3], "s")]
    rows += [(1, long, "s"), (9, long + " end", "s"), (9, "a different text with the id of a copy", "s")]
    got = sorted((r.text, r.doc_id) for r in near_copies.keep_one(rows_of(spark, rows)).collect())
    first = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in kept(rows)]
    assert got == sorted((r[1], r[0]) for r in first)
    assert len([1 for _, i in got if i is None]) == 3 and ("a different text with the id of a copy", 9) in got


def laid_out(sets):
    n = np.array([len(x) for x in sets])
    return near_copies.counts(np.concatenate(sets), np.cumsum(n) - n, n, near_copies.TABLES * near_copies.WORDS * near_copies.LENGTH)


def test_simhash_counts_add_up_over_long_and_short_sets():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 64, k, np.uint64) for k in (1, 3, 255, 256, 511, 700)]
    alone = [np.sum([laid_out([x[i : i + 1]])[0] for i in range(len(x))], axis=0) for x in sets]
    assert (laid_out(sets) == np.array(alone)).all() and set(np.unique(alone[0])) == {-1, 1}


def test_golay_keys_are_the_nearest_codewords():
    words = simhash.codewords()
    signs = 2 * (words[:, None] >> np.arange(23) & 1) - 1
    assert len(set(words.tolist())) == 4096 and min(int(w).bit_count() for w in words[1:]) == 7
    c = np.random.default_rng(2).integers(-40, 41, (200, 23))
    index, _ = near_copies.nearest_codewords(c)
    agree = c @ signs.T
    assert (np.sort(np.take_along_axis(agree, index, 1), 1) == np.sort(agree, 1)[:, -near_copies.LIST :]).all()


def test_sets_of_similarity_four_fifths_share_a_key():
    rng = np.random.default_rng(3)
    for both, a, b in ((4, 1, 0), (8, 1, 1), (16, 2, 2), (80, 10, 10), (80, 20, 0)):
        s = rng.integers(0, 1 << 64, (400, both + a + b), np.uint64)
        x, y = laid_out(list(s[:, : both + a])), laid_out(list(np.concatenate([s[:, :both], s[:, both + a :]], axis=1)))
        shared = [len(np.intersect1d(k, m)) for k, m in zip(near_copies.golay_keys(x), near_copies.golay_keys(y), strict=True)]
        assert sum(k == 0 for k in shared) <= 1
        assert (((x > 0) != (y > 0))[:, :128].sum(axis=1) <= near_copies.FAR).all()


def test_links_beside_the_least_of_a_bucket(spark):
    """Versions that are linked to each other but not to their bucket's least."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    far = [changed(rng, words, 14) for _ in range(30)]
    rows = [(i, t, "s") for i, t in enumerate([*far, *(changed(rng, t.split(), 2) for t in far)])]
    got = sorted(r.doc_id for r in near_copies.keep_one(rows_of(spark, rows)).collect())
    groups = kept(rows)
    assert len(groups) > 5 and got == sorted(min(r[0] for r in g) for g in groups)


def test_unlike_sets_hardly_meet():
    """The pairs that meet by chance grow with the square of the sets."""
    rng = np.random.default_rng(5)
    keys = near_copies.golay_keys(laid_out(list(rng.integers(0, 1 << 64, (4000, 60), np.uint64))))
    assert keys.size - len(np.unique(keys)) <= 20
