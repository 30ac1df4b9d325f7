"""Near-duplicate operators against brute force, on fixtures with every odd case."""

import numpy as np
import pytest

from arborpay.llm import embedding_dedup
from arborpay.llm.common import Workspace, connected_components
from arborpay.llm.embedding_dedup import embedding_duplicates
from arborpay.llm.minhash_forest import near_duplicates
from arborpay.llm.text import canonical, shingles


def components(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def brute_sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def varied(rng, words, share):
    return " ".join(w if rng.random() > share else f"x{rng.integers(1000)}" for w in words)


def corpus():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [None, "", " \t\n", "one two", "ONE  two", "one two three four five", "no break space here now then", "long " * 30_000]
    base = list(rng.choice(vocabulary, 120))
    texts += [varied(rng, base, s) for s in (0.01, 0.02, 0.03, 0.05) for _ in range(25)]  # a crowded family with strays
    for _ in range(25):
        own = list(rng.choice(vocabulary, int(rng.integers(20, 200))))
        texts += [" ".join(own), varied(rng, own, 0.02), " ".join(own).upper()]
    return list(enumerate(texts))


def test_minhash_forest_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", 1.5) for i, t in rows], "doc_id long, text string, rep string, component_id double").repartition(5)
    got = near_duplicates(docs).collect()
    sets = {i: brute_sets(t) for i, t in rows}
    ids = list(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = components(ids, links)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def test_crowded_regions_are_deepened_without_losing_a_link(spark, monkeypatch):
    """Many documents share a long passage; with room for few pairs a region, the exact way has to find their links."""
    from arborpay.llm import minhash_forest

    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    shared = list(rng.choice(vocabulary, 120))
    texts = []
    for _ in range(150):
        own = list(rng.choice(vocabulary, 60))
        texts.append(" ".join(shared + own))
        if rng.random() < 0.2:
            texts.append(" ".join(shared + own[:-8] + list(rng.choice(vocabulary, 8))))
    rows = [*enumerate(texts), (3, "another text of the same document " + " ".join(rng.choice(vocabulary, 40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    depths = []
    prefix = minhash_forest._prefix
    monkeypatch.setattr(minhash_forest, "CROWD", 20)
    monkeypatch.setattr(minhash_forest, "_prefix", lambda d: depths.append(d) or prefix(d))
    got = near_duplicates(docs).collect()
    sets = [(i, brute_sets(t)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if 100 * len(x & y) >= 75 * len(x | y)]
    root = components({i for i, _ in sets}, [x for x in links if x[0] != x[1]])
    assert len(depths) > 1 and len(set(root.values())) > 50
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((i, len(x), root[i]) for i, x in sets)


def test_a_group_of_near_copies_gives_out_few_pairs(spark, monkeypatch):
    """Forests join a family first; with none of them, the pairs that are given out grow with its square."""
    from arborpay.llm import minhash_forest

    rng = np.random.default_rng(6)
    base = list(rng.choice([f"w{i}" for i in range(5000)], 150))
    rows = [(i, varied(rng, base, 0.022)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keep, given = Workspace.table, []

    def table(self, df, name="t", **more):
        out = keep(self, df, name, **more)
        if name == "across":
            given.append(out.count())
        return out

    monkeypatch.setattr(Workspace, "table", table)
    got, sums = [], []
    for trees in (0, minhash_forest.FOREST_TREES):
        monkeypatch.setattr(minhash_forest, "FOREST_TREES", trees)
        given.clear()
        got.append(sorted((r["doc_id"], r["component_id"]) for r in near_duplicates(docs).collect()))
        sums.append(sum(given))
    sets = {i: brute_sets(t) for i, t in rows}
    root = components(sets, [(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    assert got[0] == got[1] == sorted(root.items())
    assert sums[1] < min(8 * len(rows), 0.7 * sums[0])


def test_a_pair_comes_from_one_tree():
    """Two unlinked texts share regions of many trees; the first of them gives the pair out, the others don't."""
    import pyarrow as pa

    from arborpay.llm import minhash_forest as m

    sets = [np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(61, 461, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)]
    sigs = [m.signature(x) for x in sets]
    heads = np.array([np.frombuffer(x, "<u2").reshape(m.TREES, m.ORDER)[:, : m.DEPTHS[0]] for x in sigs])
    shared = np.flatnonzero((heads[0] == heads[1]).all(axis=1)).tolist()
    block = lambda tree: pa.table({"tree": [tree] * 2, "i": [0] * 2, "j": [0] * 2, "block": [0] * 2, "doc": [5, 9], "comp": [5, 9], "n_shingles": [400] * 2, "sig": pa.array(sigs, pa.binary())})
    assert len(shared) > 3 and all(m._across(block(t)).num_rows == 1 for t in shared)
    assert [m._once(block(t)).to_pylist() for t in shared] == [[{"a": 5, "b": 9}]] + [[]] * (len(shared) - 1)


def test_minhash_forest_odd_rows(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    twice = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")]
    got = sorted(near_duplicates(spark.createDataFrame(twice, schema)).collect(), key=str)
    assert len(got) == 4 and [r["component_id"] for r in got if r["doc_id"]] == [1, 1, 1]
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]


def test_shingles_agree_with_words():
    for text in ("A b c d e f", "x y", "", "é b c d e f g h", "a\x0bb\x1cc d e f"):
        assert len(shingles(canonical(text))) == len(brute_sets(text))
    assert np.array_equal(shingles(canonical("A b c d e f")), shingles(canonical("a B\nc d  e F")))


def test_embedding_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 16)).astype(np.float32)
    v[100:400] = v[0] + 0.12 * rng.normal(size=(300, 16))  # crowded
    v[500:520] = v[499]
    labels = [None if i % 97 == 5 else int(i % 3 == 0) for i in range(700)]
    rows = [(i, [float(x) for x in v[i]], labels[i]) for i in range(700)]
    rows += [(700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] + [1.0] * 15, 1), (703, [None] + [1.0] * 15, 1), (704, [], 1), (705, [1.0, 2.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, part string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_duplicates(df).collect()}
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    cos = u @ u.T
    links = [(a, b) for a in range(700) for b in range(a) if labels[a] is not None and labels[a] == labels[b] and cos[a, b] >= 0.93]
    n = np.zeros(706, int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = components(range(706), links)
    assert got == {i: (n[i], root[i], root[i] == i) for i in range(706)}


def test_embedding_copies_are_one_vector_of_the_join(spark, monkeypatch):
    """4,000 equal vectors give a row of links to each neighbour, not to each other; norms may be out of range of doubles."""
    from arborpay.llm import embedding_dedup

    tables = {}
    keep = Workspace.table

    def table(self, df, name="t", **more):
        tables[name] = keep(self, df, name, **more)
        return tables[name]

    monkeypatch.setattr(Workspace, "table", table)
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(4000)] + [(4000, [1.0, 2.0, 3.1], 1), (4001, [1.0, 2.0, 3.0], 2), (4002, [1e-250, 2e-250, 3e-250], 1), (4003, [1e250, 2e250, 3e250], 1), (4003, [-1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.embedding_duplicates(df).collect()}
    assert got == {(i, 4002, 0) for i in range(4001)} | {(4001, 0, 4001), (4002, 4002, 0), (4003, 4002, 0)}
    assert tables["links"].count() <= 8


def test_directions_of_a_bounded_draw(spark, monkeypatch):
    """Directions come from as many vectors as are drawn, a repeated row counts once, and any draw gives a rotation."""
    monkeypatch.setattr(embedding_dedup, "DRAWN", 50)
    rng = np.random.default_rng(8)
    rows = [(i, "a", [float(v) for v in rng.normal(size=8) * [9, 1, 1, 1, 1, 1, 1, 1]]) for i in range(3000)]
    rows += [rows[0]] * 2000 + [(9000 + i, "b", [1.0, float(i)]) for i in range(3)]
    valid = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>").select("vec_id", "label", "embedding").mapInArrow(embedding_dedup._valid, embedding_dedup._VALID)
    got = embedding_dedup.principal_directions(valid)
    assert {d: t.shape for d, t in got.items()} == {8: (8, 6), 2: (2, 6)}
    assert np.allclose(got[8].T @ got[8], np.eye(6)) and abs(got[8][0, 0]) > 0.9
    assert np.allclose(got[2][:, :2].T @ got[2][:, :2], np.eye(2)) and not got[2][:, 2:].any()


def test_embedding_duplicates_of_nothing(spark):
    assert embedding_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 3), (3, 9), (7, 8)]])
def test_connected_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["v"]: r["root"] for r in connected_components(Workspace(spark, "cc"), df).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == components({x for e in real for x in e}, real)
