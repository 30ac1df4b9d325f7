"""The language model, the toxicity model, search, mixing, rollups and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arborpay.llm import mixing, quality_lm, toxicity_pu
from arborpay.llm.ann_tree import nearest_neighbours
from arborpay.llm.common import Workspace
from arborpay.llm.quality_lm import classify
from arborpay.llm.token_rollup import TokenRollup, deleted, inserted, revised
from arborpay.llm.toxicity_pu import features, fit, score_documents

DATA = "/root/testdata/sf0.01"


class BruteKneserNey:
    """Interpolated modified Kneser-Ney over words, straight from its definition."""

    def __init__(self, texts, order=3):
        self.order = order
        self.counts = {order: Counter()}
        for words in texts:
            u = ("",) * (order - 1) + tuple(words)
            self.counts[order].update(u[i : i + order] for i in range(len(u) - order + 1))
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut, self.after = {}, {}
        for n, c in self.counts.items():
            k = Counter(c.values())
            y = k[1] / max(k[1] + 2 * k[2], 1)
            self.cut[n] = [max(0.05, min(j - 0.05, j - (j + 1) * y * k[j + 1] / max(k[j], 1))) for j in (1, 2, 3)]
            for g, m in c.items():
                own = self.after.setdefault(g[:-1], [0, 0.0])
                own[0] += m
                own[1] += self.cut[n][min(m, 3) - 1]

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / (len(self.counts[1]) + 1)
        total, held = self.after.get(gram[:-1], (0, 0))
        if not total:
            return self.p(gram[1:])
        own = self.counts[n].get(gram, 0)
        return (own - self.cut[n][min(own, 3) - 1] if own else 0) / total + held / total * self.p(gram[1:])

    def entropy(self, words):
        u = ("",) * (self.order - 1) + tuple(words)
        return -sum(math.log(self.p(u[i : i + self.order])) for i in range(len(words))) / len(words)


def test_quality_keeps_clean_and_drops_junk(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = classify(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").toPandas()
    assert got["kept"][got["quality"] == 1].mean() > 0.98
    assert got["kept"][got["quality"] == 0].mean() < 0.5


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", 1), (2, "", None, 1), (None, "abc", "en", 1), (3, "good text here", "en", 1), (3, "good text here", "en", 1), (4, "word", "xx", 1), (5, "é" * 200_000, "en", 1)], "doc_id long, text string, lang string, kept int")
    trusted = spark.createDataFrame([(i, f"good text here, line {i}", "en", 1) for i in range(10, 50)], docs.schema)
    docs = docs.union(trusted)
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, None), (9, None, None), *[(i, 1, 0) for i in range(10, 50)]], "doc_id long, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == 47
    kept = {(r["doc_id"], r["lang"]): r["kept"] for r in got}
    assert kept[(1, "en")] and kept[(2, None)] and kept[(4, "xx")] and kept[(3, "en")] and not kept[(5, "en")]
    assert classify(docs.limit(0), labels).count() == 0
    assert classify(docs, labels.limit(0)).where("kept").count() == 47


def test_toxicity_on_held_out_documents(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    got = score_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    y, rank = got["toxic"].to_numpy(), got["score"].rank().to_numpy()
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc > 0.95
    ids = got["doc_id"]
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.1), (None, "x", 0.1), (3, "bad " * 50_000, 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    got = score_documents(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in got)
    assert score_documents(docs.limit(0), labels).count() == 0


def test_pu_model_learns_without_negatives():
    rng = np.random.default_rng(6)
    word = lambda toxic: " ".join([f"w{i}" for i in rng.integers(0, 500, 60)] + (["idiot"] * toxic))
    positives = [features(word(True)) for _ in range(300)]
    unlabelled = [features(word(i % 10 == 0)) for i in range(1500)]
    model = fit(positives, unlabelled, prior=0.1)
    assert np.mean([model.score(features(word(True))) for _ in range(50)]) > 0.9
    assert np.mean([model.score(features(word(False))) for _ in range(50)]) < 0.2


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        at = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(d[i])) for i in at]
    return out


def test_search_recall_and_scores(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(3000, 24)).astype(np.float32)
    v[2000:2020] = v[100]
    rows = [(i, [float(a) for a in v[i]]) for i in range(3000)]
    bad = [(5000, None), (5001, [0.0] * 24), (5002, [float("inf")] * 24), (5100, [])]
    df = spark.createDataFrame([(*r, 0) for r in rows + bad], "vec_id long, embedding array<float>, rank int")
    got = nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect()
    want = exact(rows, range(0, 3000, 100), 10)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(want) and all(len(f) == 10 for f in found.values())
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    assert [i for i, _ in found[100]] == list(range(2000, 2010))  # ties go to smaller ids
    assert nearest_neighbours(df.limit(0), df).count() == 0
    assert got[0]["trial_recall"] >= 0.97 and got[0]["visits"] >= 1
    few = df.where("vec_id in (0, 1, 2)")
    assert nearest_neighbours(few, few.where("vec_id = 0")).count() == 2


def test_search_widens_until_enough_candidates(spark):
    """Queries in leaves of one row, beside a large group of copies, still get all their neighbours."""
    rng = np.random.default_rng(9)
    v = np.concatenate([np.ones((900, 8)), 50 * rng.normal(size=(60, 8))])
    df = spark.createDataFrame([(i, [float(a) for a in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = nearest_neighbours(df, df.where("vec_id >= 900")).groupBy("query_id").count().collect()
    assert len(got) == 60 and all(r["count"] == 10 for r in got)


def test_neighbours_among_copies(spark, monkeypatch):
    """A third of all rows is one vector, an id repeats more often than k, leaves are cut into blocks and queries into parts: still exact."""
    monkeypatch.setattr("arborpay.llm.ann_tree.BLOCK", 16)
    monkeypatch.setattr("arborpay.llm.ann_tree.ASKED", 8)
    rng = np.random.default_rng(5)
    hot = rng.normal(size=4)
    rows = [(i, [float(v) for v in (hot if i % 3 == 0 else rng.normal(size=4))]) for i in range(600)]
    rows += [rows[0]] * 9 + [(7, rows[7][1])] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    asked = [i for i in range(600) if i % 6 in (0, 1)]
    got = {}
    for r in nearest_neighbours(df, df.where("vec_id % 6 in (0, 1)"), k=3, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    vectors = dict(rows)
    exact = 0
    for i in asked:
        want = sorted((float(np.sqrt(((np.array(vectors[i]) - np.array(v)) ** 2).sum())), j) for j, v in rows if j != i)[:3]
        same = [j for _, j in got[i]] == [j for _, j in want]
        exact += same
        if i % 3 == 0:  # copies of one vector: the smallest ids but one's own, as often as they are there
            assert same, (i, got[i], want)
    assert exact >= 0.9 * len(asked)


def water(budget, caps, weights):
    """Shares by filling one unit of the level at a time."""
    share = dict.fromkeys(caps, 0.0)
    left = min(budget, sum(caps.values()))
    while left > 1e-9:
        open_ = [k for k in caps if caps[k] - share[k] > 1e-9 and weights[k]]
        if not open_:
            break
        total = sum(weights[k] for k in open_)
        step = min([left / total] + [(caps[k] - share[k]) / weights[k] for k in open_])
        for k in open_:
            share[k] += step * weights[k]
        left -= step * total
    return share


def test_mixing_budgets_and_prefixes(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 30))), str(rng.choice(["en", "de"])), f"s{int(rng.integers(0, 9))}", 5) for i in range(600)]
    rows += [(1000, None, None, None, 5), (1001, "", "en", "s1", 5), (3, "w w", "en", "s1", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int").repartition(4)
    weights = {"domain": {"web": 7, "books": 2, "code": 1}}
    got = mixing.mix(docs, weights, share=0.9, epochs=2).collect()
    domain = lambda s: "none" if s is None else "web" if s[-1] in "0123" else "books" if s[-1] in "456" else "code"
    words, leaves = {}, Counter()
    for i, t, l, s, _ in rows:
        words[i] = words.get(i, 0) + len((t or "").split())
        leaves[(domain(s), l or "none", s or "none")] += len((t or "").split())
    total = sum(leaves.values())
    used = Counter()
    for r in got:
        used[(r["domain"], r["lang"] or "none", r["source"] or "none")] += len((r["text"] or "").split())
    caps = Counter()
    for (d, *_), n in leaves.items():
        caps[d] += 2 * n
    shares = water(int(total * 0.9), caps, {"web": 7, "books": 2, "code": 1, "none": 1})
    for d in caps:
        filled = sum(n for (x, *_), n in used.items() if x == d)
        assert filled <= shares[d] + 1 and filled >= shares[d] - 30 * sum(1 for x in leaves if x[0] == d)
    seen = Counter((r["doc_id"], r["epoch"]) for r in got)
    assert all(n == 1 for (i, _), n in seen.items() if i != 3)
    again = mixing.mix(docs.repartition(7), weights, share=0.9, epochs=2).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(docs.limit(0), weights, share=0.9).count() == 0
    clash = docs.withColumnsRenamed({"n_tokens": "full"}).withColumns({c: F.lit(c) for c in ("h_max", "leaf", "doc", "id", "_full", "_l", "domain")})
    out = mixing.mix(clash, weights, share=0.9, epochs=2)
    assert out.columns == [*[c for c in clash.columns if c != "domain"], "domain", "epoch"]
    assert sorted((str(r["doc_id"]), r["epoch"]) for r in out.collect()) == sorted((str(r["doc_id"]), r["epoch"]) for r in got) and out.where("_l = '_l' and h_max = 'h_max'").count() == out.count()


def test_mixing_keeps_null_apart_from_names_and_deals_rows_without_id(spark):
    rows = [(i, "w " * 10, "none", "s1") for i in range(100)] + [(1000 + i, "w " * 10, None, "s1") for i in range(100)] + [(None, f"text {i} " * 5, "en", "s1") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter(r["lang"] for r in mixing.mix(docs, {"lang": {"none": 1, "en": 4}}, share=0.5).select("lang").collect())
    assert got["none"] == 25 and got[None] == 25 and got["en"] == 100


@pytest.mark.parametrize("weights", [{"domain": {"web": 0, "books": 1, "code": 1}}, {"lang": {"en": 0}}, {"source": {"s1": 0, "s4": 0}}, {"domain": {"web": 0, "books": 0, "code": 0}}, {"domain": {"web": 3}, "lang": {"de": 0}, "source": {"s1": 0}}])
def test_what_weighs_nothing_is_switched_off_and_its_share_goes_to_others(spark, weights):
    rows = [(i, "w " * 10, ("en", "de")[i % 2], ("s1", "s2", "s4", "s7")[i // 2 % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, weights, share=0.2).collect()
    on = lambda d, l, s: all(weights.get(k, {}).get(v, 1) for k, v in (("domain", d), ("lang", l), ("source", s)))
    assert all(on(r["domain"], r["lang"], r["source"]) for r in got)
    some = any(on(d, l, s) for d, s in (("web", "s1"), ("web", "s2"), ("books", "s4"), ("code", "s7")) for l in ("en", "de"))
    assert len(got) == 0 if not some else 70 <= len(got) <= 80  # a fifth of 400, but for the cut of each leaf


def test_rollups_are_idempotent(spark, tmp_path):
    rollup = TokenRollup(spark, f"file://{tmp_path}")
    schema = "source string, lang string, tokenizer_version string, n_tokens long, old_tokens long, n_docs string"
    first = spark.createDataFrame([("a", "en", "v1", 10, None, "x"), ("a", "en", "v1", 5, None, "x"), (None, None, "v1", None, None, "x")], schema)
    assert rollup.apply("one", inserted(first))
    assert not rollup.apply("one", inserted(first))
    rollup.apply("two", revised(spark.createDataFrame([("a", "en", "v1", 7, 10, "x")], schema)), deleted(spark.createDataFrame([("a", "en", "v1", 5, None, "x")], schema)))
    want = {("a", "en", "v1", 1, 7), (None, None, "v1", 1, 0)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert not rollup.apply("two", inserted(first))
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.apply("three", inserted(first.where("source is not null")))
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v1", 3, 22), (None, None, "v1", 1, 0)}
    with pytest.raises(ValueError):
        rollup.apply("../x", inserted(first))


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(300).withColumn("score", F.lit(1)).withColumn("kept", F.lit("k"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
        docs = Workspace(spark, "pipe").table(out, name)
        assert docs.count() > 50, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_rollup_query_equals_brute_force(spark):
    import base64
    import re

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    from arborpay.llm.queries import op10_delta_rollups

    data = "/root/testdata/sf0.001"
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    units = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    count = {"word_bpe_49k": lambda t: len(words.encode(t, add_special_tokens=False).ids), "byte_bpe_50k": lambda t: len(units.encode_ordinary(t))}
    labels = spark.read.parquet(f"{data}/labels.parquet").collect()
    poor, toxic = {r["doc_id"] for r in labels if r["quality"] == 0}, {r["doc_id"] for r in labels if r["toxic"] == 1}
    want = {}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        if r["doc_id"] not in toxic:
            text = re.sub("[ \\t-\\r]+", " ", r["text"] or "") if r["doc_id"] in poor else r["text"] or ""
            for version, of in count.items():
                own = want.setdefault((r["source"], r["lang"], version), [0, 0])
                own[0] += 1
                own[1] += of(text)
    got = {tuple(r)[:3]: [r["n_docs"], r["n_tokens"]] for r in op10_delta_rollups(spark, data).select("source", "lang", "tokenizer_version", "n_docs", "n_tokens").collect()}
    assert got == want


def test_rollups_survive_a_torn_marker_and_commits_during_a_compaction(spark, tmp_path, monkeypatch):
    rollup = TokenRollup(spark, f"file://{tmp_path}")
    one = spark.createDataFrame([("a", "en", "v1", 10)], "source string, lang string, tokenizer_version string, n_tokens long")
    (tmp_path / "commits").mkdir()
    (tmp_path / "commits" / "batch-first.json").touch()  # what a driver leaves that is lost while it writes in place
    assert rollup.apply("first", inserted(one)) and not rollup.apply("first", inserted(one))
    rollup.apply("second", inserted(one))
    other, sums = TokenRollup(spark, f"file://{tmp_path}"), rollup._sums

    def meanwhile(tables):
        other.apply("third", inserted(one))
        other.compact()
        return sums(tables)

    monkeypatch.setattr(rollup, "_sums", meanwhile)
    rollup.compact()
    monkeypatch.undo()
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 3, 30)]
    assert rollup.committed() == {"first", "second", "third"}
    rollup.compact()
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 3, 30)]


def test_word_model_equals_definition_and_sees_word_order(spark):
    n_folds = quality_lm.FOLDS
    texts = [(f % n_folds, t) for f, t in enumerate(["the cat sat on the mat .", "the dog sat on the cat", "a cat", "on the mat", "the cat ran", "dog"])]
    asked = ["the cat sat on the mat .", "mat the on sat cat the .", "unseen words", "the cat unseen sat"]
    docs = [(i, "en", "en", f, t) for i, (f, t) in enumerate(texts)] + [(100 + i, "en", "en", n_folds, t) for i, t in enumerate(asked)] + [(200, "xx", "xx", n_folds, "the cat")]
    df = spark.createDataFrame(docs, "doc_id long, lang string, lang_was string, model int, text string")
    got = {r["doc_id"]: r["entropy"] for r in quality_lm.perplexities(Workspace(spark, "words"), df).collect()}
    for i, lang, _, model, text in docs:
        if lang == "en":  # a trusted text is judged without its fold
            brute = BruteKneserNey([t.split() for f, t in texts if f != model], quality_lm.WORDS)
            assert got[i] == pytest.approx(brute.entropy(text.split()))
    assert got[200] is None  # its language has no trusted text
    assert got[101] > got[100] + 0.5  # the same words in a wrong order
    whole = BruteKneserNey([t.split() for _, t in texts])
    assert sum(whole.p(("sat", "on", w)) for (w,) in whole.counts[1]) + whole.p(("sat", "on", "?")) == pytest.approx(1)


def test_keys_are_sparks(spark):
    rows = np.random.default_rng(3).integers(0, 2**40, (20, quality_lm.WORDS)).astype(np.uint64)
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(rows)], "i int, w1 long, w2 long, w3 long").orderBy("i")
    for n in range(1, quality_lm.WORDS + 1):
        assert [r[0] for r in df.select(F.xxhash64(*[f"w{k}" for k in range(1, n + 1)])).collect()] == quality_lm.keys(rows[:, :n]).tolist()


def test_risks_follow_their_definition():
    """Both risks against a direct sum over texts, their gradients against differences, and no step where the corrected risk is negative."""
    rng = np.random.default_rng(10)
    dense = {"p": rng.random((12, 5)) < 0.5, "u": rng.random((30, 5)) < 0.4}
    rows = {k: toxicity_pu.Rows(*np.nonzero(x), len(x)) for k, x in dense.items()}
    w, b, prior = rng.normal(size=5), 0.3, 0.2

    def direct(w, b):
        zp, zu = dense["p"] @ w + b, dense["u"] @ w + b
        return prior * np.mean(np.log1p(np.exp(-zp))), np.mean(np.log1p(np.exp(zu))) - prior * np.mean(np.log1p(np.exp(zp)))

    of_positive, of_negative, down, up = toxicity_pu.risks(rows["p"], rows["u"], w, b, prior)
    assert (of_positive, of_negative) == pytest.approx(direct(w, b))
    for k in range(6):
        step = np.eye(6)[k] * 1e-6
        more, less = direct(w + step[:5], b + step[5]), direct(w - step[:5], b - step[5])
        assert [down[k], up[k]] == pytest.approx([(m - x) / 2e-6 for m, x in zip(more, less, strict=True)], abs=1e-6)


def integer_water(budget, caps, weights):
    """Whole shares: smallest caps per weight first, each full if the level passes it; the others by weight of what is left."""
    order = sorted(caps, key=lambda k: (caps[k] / weights[k], k))
    left, shares = budget, {}
    while order:
        total = sum(weights[k] for k in order)
        if caps[order[0]] * total > left * weights[order[0]]:
            break
        left -= caps[order[0]]
        shares[order[0]] = caps[order[0]]
        order.pop(0)
    return shares | {k: max(0, left * weights[k] // sum(weights[x] for x in order)) for k in order}


def test_pipeline_equals_brute_force_stage_by_stage(spark, tmp_path):
    import hashlib
    import struct
    import zlib as z

    import public_tokenizers
    from tokenizers import Tokenizer

    data = "/root/testdata/sf0.001"
    read = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    labels = [r.asDict() for r in spark.read.parquet(f"{data}/labels.parquet").collect()]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        if name != "packing":
            docs = Workspace(spark, "brute").table(out, name)
            kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}

    # Toxicity: everything fits the bounds of the samples here, so the model follows from all rows.
    learning = {i: r for i, r in read.items() if z.crc32(str(i).encode()) % 5}
    toxic = {r["doc_id"]: r["toxic"] for r in labels if r["toxic"] is not None and r["doc_id"] in learning}
    sets = {i: features(r["text"]) for i, r in read.items()}
    own = sorted((sets[i].tobytes() for i in learning if toxic.get(i) == 1))
    other = sorted((sets[i].tobytes() for i in learning))
    model = fit([np.frombuffer(x, np.int32) for x in own], [np.frombuffer(x, np.int32) for x in other], sum(toxic.values()) / len(toxic))
    want = {i for i in read if model.score(sets[i]) < 0.5}
    assert kept["toxicity"] == want

    # Quality: entropies by the definition, thresholds by sorting.
    words = {i: quality_lm.tokens(read[i]["text"] or "") for i in want}
    good = {r["doc_id"] for r in labels if r["quality"] == 1} - {r["doc_id"] for r in labels if r["quality"] == 0 or r["toxic"] == 1}
    fold = {r["doc_id"]: r["f"] for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", F.pmod(F.xxhash64("text"), F.lit(quality_lm.FOLDS)).alias("f")).collect()}
    entropy, judged = {}, {}
    for lang in {r["lang"] for r in read.values()}:
        ids = [i for i in want if read[i]["lang"] == lang and words[i]]
        trusted = [i for i in ids if i in good]
        for f in [*range(quality_lm.FOLDS), None]:
            base = [words[i] for i in trusted if fold[i] != f]
            brute = BruteKneserNey(base, quality_lm.WORDS) if base else None
            for i in ids:
                if (fold[i] if i in trusted else None) == f and brute:
                    entropy[i] = brute.entropy(words[i])
        judged[lang] = [entropy[i] for i in trusted if i in entropy]
    size = lambda i: sum(len(read[i]["text"]) >= c for c in quality_lm.LENGTHS)
    classes = {}
    for la, x in judged.items():
        for i in want:
            if i in entropy and read[i]["lang"] == la and i in good:
                classes.setdefault((la, size(i)), []).append(entropy[i])
    top = lambda x: sorted(x)[math.ceil(len(x) * quality_lm.QUANTILE) - 1]
    apart = {k: top([e - np.mean(x) for (_, s), x in classes.items() if s == k for e in x]) for k in {s for _, s in classes}}
    apart_all = top([e - np.mean(x) for x in classes.values() for e in x])

    def limit(i):
        la, k = read[i]["lang"], size(i)
        if (la, k) not in classes:
            return np.mean(judged[la]) + apart.get(k, apart_all)
        x = classes[la, k]
        return (top(x) * len(x) + (np.mean(x) + apart[k]) * quality_lm.DRAW) / (len(x) + quality_lm.DRAW)

    bad = {i for i, e in entropy.items() if judged[read[i]["lang"]] and e > limit(i) + 2 * quality_lm.BIN}
    near = {i for i, e in entropy.items() if judged[read[i]["lang"]] and abs(e - limit(i)) <= 2 * quality_lm.BIN}
    assert kept["quality"] | near == (want - bad) | near
    want = kept["quality"]

    # Near-duplicates: all pairs of sets, the smallest id of each component stays.
    shingles = {}
    for i in want:
        w = (read[i]["text"] or "").encode().lower().split()
        shingles[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in want}
    links = [(a, b) for a in want for b in want if a < b and shingles[a] and shingles[b] and 100 * len(shingles[a] & shingles[b]) >= 75 * len(shingles[a] | shingles[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(root[a], root[b])
            moved |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert kept["near_dedup"] == {i for i in want if root[i] == i}
    want = kept["near_dedup"]

    # Mixing: whole-number water filling down the tree, then the prefix of each leaf's seeded order.
    domain = lambda s: "none" if s is None else "web" if s[-1] in "0123" else "books" if s[-1] in "456" else "code"
    leaves = {}
    for i in want:
        leaves.setdefault((domain(read[i]["source"]), read[i]["lang"], read[i]["source"]), []).append(i)
    size = {i: len((read[i]["text"] or "").encode().split()) for i in want}
    cap = {leaf: sum(size[i] for i in ids) for leaf, ids in leaves.items()}
    weight = lambda level, name: corpus_pipeline.WEIGHTS.get(level, {}).get(name, 1)
    domains = {d: sum(c for x, c in cap.items() if x[0] == d) for d in {x[0] for x in cap}}
    top = integer_water(math.floor(sum(cap.values()) * 0.9), domains, {d: weight("domain", d) for d in domains})
    taken = set()
    for d, budget in top.items():
        langs = {l: sum(c for x, c in cap.items() if x[:2] == (d, l)) for l in {x[1] for x in cap if x[0] == d}}
        for l, inner in integer_water(budget, langs, {x: weight("lang", x) for x in langs}).items():
            sources = {x[2]: c for x, c in cap.items() if x[:2] == (d, l)}
            for s, share in integer_water(inner, sources, {x: weight("source", x) for x in sources}).items():
                ids = leaves[(d, l, s)]
                if cap[(d, l, s)] and share >= cap[(d, l, s)]:
                    taken |= set(ids)
                    continue
                run = 0
                for i in sorted(ids, key=lambda i: hashlib.md5(f"9-1-{i}".encode()).hexdigest()):
                    run += size[i]
                    if share <= 0 or run > share:
                        break
                    taken.add(i)
    assert kept["mixing"] == taken

    # Packing: every id of every document once, sequences within their limit.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = out.collect()
    ids = {i: tokenizer.encode(read[i]["text"] or "", add_special_tokens=False).ids + [1] for i in taken}
    assert {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in rows} == {(r["doc_id"], r["start"]): (r["length"], z.crc32(struct.pack(f"<{r['length']}I", *ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]))) for r in rows}
    assert Counter({i: len(x) for i, x in ids.items()}) == sum((Counter({r["doc_id"]: r["length"]}) for r in rows), Counter())
    assert max(sum((Counter({r["sequence_id"]: r["length"]}) for r in rows), Counter()).values()) <= 2048


def test_pipeline_takes_odd_rows(spark, tmp_path):
    """Null and empty texts, null ids, languages and sources, repeated rows, clashing columns, no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, _score double, leaf string, doc string, id string"
    more = (1.0, 2.0, "l", "d", "i")
    rows = [(1, None, "en", "s1", 0, *more), (2, "", None, None, 0, *more), (None, "a null id", "en", "s1", 1, *more), (None, "another null id", "en", "s1", 1, *more), (3, "x " * 30_000, "en", "s4", 1, *more), (4, "good words here", "en", "s1", 1, *more), (4, "good words here", "en", "s1", 1, *more)]
    for i, rows in enumerate((rows, [])):
        docs = spark.createDataFrame(rows, schema)
        for name in ("documents", "labels"):
            df = docs if name == "documents" else spark.createDataFrame([(4, 1, 0), (None, 1, 1)][: len(rows)], "doc_id long, quality int, toxic int")
            df.write.parquet(f"file://{tmp_path}/{i}/{name}.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = Workspace(spark, "odd").table(stage(spark, docs, f"file://{tmp_path}/{i}"), name)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, f"file://{tmp_path}/{i}").count() >= (1 if rows else 0)


def test_quality_threshold_has_no_term_in_size(spark, monkeypatch):
    """Every trusted document sets the threshold, and a language of few is drawn to what all say; short texts don't loosen the limit of long ones."""
    rng = np.random.default_rng(11)
    en = [(i, "en", float(e)) for i, e in enumerate(rng.normal(5, 0.3, 600))]
    es = [(1000 + i, "es", 7 + 0.01 * i) for i in range(4)]
    rows = [(i, la, 10, True, e) for i, la, e in en + es] + [(2000, "es", 10, False, 9.5), (2001, "es", 10, False, 7.2), (2002, "xx", 10, False, 30.0)]
    rows += [(3000 + i, "en", 5000, True, 5 + 0.001 * i) for i in range(100)] + [(4000, "en", 5000, False, 5.5), (4001, "es", 5000, False, 7.1), (4002, "es", 5000, False, 8.0)]
    fake = spark.createDataFrame(rows, "doc_id long, lang string, n_chars long, trusted boolean, entropy double")
    monkeypatch.setattr(quality_lm, "perplexities", lambda *a: fake)
    docs = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in classify(docs, labels).collect()}
    values = sorted(e for _, _, e in en)
    top = lambda x: sorted(x)[math.ceil(len(x) * 0.998) - 1]
    apart = top([e - np.mean(values) for e in values] + [0.01 * i - 0.015 for i in range(4)])
    assert math.log(got[0]["threshold"]) == pytest.approx((600 * top(values) + 500 * (np.mean(values) + apart)) / 1100, abs=3e-4)
    assert math.log(got[1000]["threshold"]) == pytest.approx((4 * 7.03 + 500 * (7.015 + apart)) / 504, abs=3e-4)
    assert math.log(got[3000]["threshold"]) == pytest.approx(5.099, abs=3e-4) and not got[4000]["kept"]
    assert math.log(got[4001]["threshold"]) == pytest.approx(7.015 + 0.0495, abs=3e-4) and not got[4001]["kept"] and not got[4002]["kept"]
    assert not got[2000]["kept"] and got[2001]["kept"] and not got[2002]["kept"]


def test_scoring_a_block_holds_few_bytes_a_word():
    import tracemalloc

    import pyarrow as pa
    import zstandard

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 400)) for _ in range(500)]
    own = quality_lm.Texts(texts, "en")
    asked = np.concatenate([quality_lm.keys(own.distinct(n)[0]) for n in (1, 2, 3)])
    found = pa.table({"block": pa.array(np.zeros(len(asked), np.int64)), "key": pa.array(asked), **{c: pa.array(rng.integers(1, 9, len(asked)).astype(np.int32)) for c in "ctxyz"}})
    packed = pa.array([zstandard.ZstdCompressor().compress(t.encode()) for t in texts], pa.binary())
    cuts = [5e3, 0.5, 0.8, 1.2, 0.6, 0.9, 1.3, 0.7, 1.0, 1.4, 9e5, 2e4, 9e3, 3e4]
    rows = {"doc_id": pa.array(range(500), pa.int64()), "lang": ["en"] * 500, "lang_was": ["en"] * 500, "model": pa.array([4] * 500, pa.int32()), "packed": packed, "cuts": [cuts] * 500}
    tracemalloc.start()
    scored = quality_lm._score(pa.table(rows), found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert None not in scored.column("entropy").to_pylist()
    assert peak < 250 * own.sizes.sum()


def test_quality_shuffles_packed_blocks_not_grams(spark):
    """A row goes out for a block and shard, not for each gram; entropies of several blocks stay those of the definition."""
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 300) if k < 4000) for _ in range(60)]
    rows = [(i, "en", "en", i % 6 if i % 6 < quality_lm.FOLDS else quality_lm.FOLDS, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, lang_was string, model int, text string").repartition(3)

    def stages():
        sc = spark.sparkContext
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return {s.stageId(): s.shuffleWriteRecords() for s in sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()))}

    before = stages()
    got = {r["doc_id"]: r["entropy"] for r in quality_lm.perplexities(Workspace(spark, "packed"), df).collect()}
    shuffled = sum(n for i, n in stages().items() if i not in before)
    brute = {m: BruteKneserNey([t.split() for *_, f, t in rows if f not in (m, quality_lm.FOLDS)], quality_lm.WORDS) for m in range(quality_lm.FOLDS + 1)}
    for i, *_, m, text in rows:
        assert got[i] == pytest.approx(brute[m].entropy(text.split()))
    assert shuffled < sum(len(t.split()) for t in texts) / 4


@pytest.mark.parametrize("array", [[], [0, 0, 0], [1, 255, 256, 2**40], [-1, 5, -(2**62)], [True, False, True]])
def test_packed_arrays_come_back(array):
    a = np.array(array, bool if array and array[0] is True else np.int64)
    (got,) = quality_lm.unpack(quality_lm.pack([a]))
    assert got.tolist() == a.tolist()
