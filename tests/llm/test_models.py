import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from irspark.llm import quality, suffix_tree, text
from irspark.llm.langid import LanguageModel, class_counts, language_mixtures, train_languages
from irspark.llm.pieces import Pieces, decode_pieces, encode_pieces
from irspark.llm.sharding import allowed_moves, quotas, shard_documents
from irspark.llm.toxicity import ToxicityModel, toxicity_scores, train_toxicity

EN, DE = "the of and to in that was for".split(), "der die und das von zu mit für".split()


def documents(spark, rows):
    return spark.createDataFrame([(i, t, x, "s") for i, t, x in rows], "doc_id long, text string, lang string, score string")


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_split(texts):
    data = [t.encode() for t in texts]
    rows, hashes = text.hashed_words(data)
    want = [(i, w) for i, t in enumerate(data) for w in t.lower().split()]
    assert rows.tolist() == [i for i, _ in want]
    names = {}
    for (_, w), h in zip(want, hashes.tolist()):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    where, _ = text.shingle_hashes(rows, hashes, 3)
    n = Counter(rows.tolist())
    assert Counter(where.tolist()) == {i: max(1, c - 2) for i, c in n.items()}


def brute_best(text_, vocabulary, floor):
    best = [0.0] + [-math.inf] * len(text_)
    for i in range(1, len(text_) + 1):
        best[i] = best[i - 1] + floor
        for p, s, _ in vocabulary:
            if p and text_[:i].endswith(p):
                best[i] = max(best[i], best[i - len(p)] + s)
    return best[-1]


VOCABULARY = [("", 0.0, -1)] + [(f"<{b}>", 0.0, b) for b in range(256)] + [
    (p, -float(n % 7) - 1.5, -1) for n, p in enumerate([" ", "a", "b", "c", "ab", "bc", "abc", " a", " ab", "  ", "ca", "aa", "aaa", "bca"])]
VOCABULARY = [(p if b < 0 else "", s, b) for p, s, b in VOCABULARY]


@given(st.text(alphabet="abc \n▁é😀", max_size=90))
@settings(max_examples=150, deadline=None)
def test_pieces_are_optimal_and_round_trip(value):
    pieces = Pieces(VOCABULARY)
    score, ids = pieces.encode([value])[0]
    assert pieces.decode(ids).decode() == value
    assert score == pytest.approx(brute_best(" " + value, VOCABULARY, pieces.floor) if value else 0.0)


def test_pieces_in_spark(spark):
    values = ["ab abc\nca", None, "", "  lead", "x" * 70_000, "▁ mark"]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(values)])
    out = encode_pieces(docs, VOCABULARY)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) for r in rows.values())
    back = {r["doc_id"]: r["text"] for r in decode_pieces(out, VOCABULARY).collect()}
    assert back == {i: t or "" for i, t in enumerate(values)}
    assert encode_pieces(docs.limit(0), VOCABULARY).count() == 0


def test_shards_are_even_and_keep_groups(spark):
    rng = random.Random(4)
    values = ["big"] * 70 + [f"pair {i // 2}" for i in range(60)] + [f"alone {i}" for i in range(66)] + [None, "", "x " * 50_000]
    rows = [(i, t, None) for i, t in enumerate(values)] + [(None, "n", None), (5, "five", None), (5, "five", None)]
    rng.shuffle(rows)
    got = shard_documents(documents(spark, rows), 5).collect()
    load = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and max(load.values()) - min(load.values()) <= 1 and set(load) == set(range(5))
    for s in range(5):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(load[s]))
    by = {r["doc_id"]: r for r in got}
    assert all(by[70 + 2 * i]["shard"] == by[71 + 2 * i]["shard"] for i in range(30))
    assert max(Counter(by[i]["shard"] for i in range(70) if i != 5).values()) >= 35    # its quota is 40
    for i, t in enumerate(values):
        if i != 5:
            assert by[i]["text_crc32"] == zlib.crc32((t or "").encode()) and by[i]["size"] == len((t or "").encode()) + 1
    assert shard_documents(documents(spark, []), 5).count() == 0


def test_groups_that_fit_a_shard_stay_whole(spark):
    sizes = [5000, 3000, 2000, 1000, 700, 500, 500, *[3] * 2000]
    rows = [t for g, n in enumerate(sizes) for t in [f"group {g}"] * n] + [f"single {i}" for i in range(96_000 - sum(sizes))]
    random.Random(5).shuffle(rows)
    got = shard_documents(documents(spark, [(i, t, "en") for i, t in enumerate(rows)]), 16).select("doc_id", "shard").collect()
    assert len(got) == len(rows) and set(Counter(r["shard"] for r in got).values()) == {6000}
    shards = {}
    for r in got:
        shards.setdefault(rows[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_crowded_groups_are_split_only_at_the_ends(spark):
    rows = [f"group {g}" for g in range(8000) for _ in range(4)]
    random.Random(6).shuffle(rows)                                  # no single row to fill a gap
    got = shard_documents(documents(spark, [(i, t, "en") for i, t in enumerate(rows)]), 3).select("doc_id", "shard").collect()
    assert sorted(Counter(r["shard"] for r in got).values()) == [10666, 10667, 10667]
    shards = {}
    for r in got:
        shards.setdefault(rows[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 2


def test_moves_respect_quotas():
    rng = random.Random(8)
    for _ in range(200):
        s = rng.randint(2, 5)
        load = [rng.randint(0, 9) for _ in range(s)]
        quota = [x + rng.randint(0, 3) for x in load]
        wanted = {(a, b): rng.randint(1, 9) for a in range(s) for b in range(s) if a != b and rng.random() < 0.6 and load[a]}
        grant = allowed_moves(wanted, load, quota)
        after = [load[k] + sum(n for (_, b), n in grant.items() if b == k) - sum(n for (a, _), n in grant.items() if a == k) for k in range(s)]
        assert all(0 <= grant[k] <= wanted[k] for k in wanted) and all(x <= q for x, q in zip(after, quota))
    assert quotas(7, 3) == [3, 2, 2]


def test_mixtures_find_both_languages(spark):
    rng = random.Random(1)
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, say(EN if i % 2 else DE, 40), "en" if i % 2 else "de") for i in range(60)] + [(60, "nothing", None), (61, None, "en")]
    docs = documents(spark, rows)
    model = train_languages(docs)
    assert model.languages == ["de", "en"]
    tests = [(0, say(EN, 200), None), (1, say(DE, 200) + " " + say(EN, 100), None), (2, None, None), (3, "12 -- 😀", None), (4, "", None),
             (None, say(DE, 30), None), (5, say(EN, 30_000), None)]
    got = {r["doc_id"]: r for r in language_mixtures(documents(spark, tests), model).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 3, 4, None, 5)] == ["en", "de", "und", "und", "und", "de", "en"]
    assert got[0]["languages"] == ["en"] and got[1]["languages"] == ["de", "en"] and 0.5 < got[1]["score"] < 0.8
    assert language_mixtures(docs.limit(0), model).count() == 0
    assert language_mixtures(docs, LanguageModel([], model.probability[:, :0])).select("lang_pred").distinct().collect()[0][0] == "und"
    with pytest.raises(ValueError):
        train_languages(docs, max_languages=1)
    assert class_counts(b"ab " * 700_000).sum() == 1_400_000


def test_rare_languages_are_learned_from_many_rows(spark):
    rare = [f"r{i:02}" for i in range(20)]                             # one labelled row each among 60,000
    word = lambda x: " ".join([chr(0x430 + int(x[1:])) * 3 + "ж"] * 20)
    rows = [(i, "the of and", "en") for i in range(60_000)] + [(60_000 + i, word(x), x) for i, x in enumerate(rare)]
    model = train_languages(documents(spark, rows))
    assert model.languages == ["en", *rare]
    got = {r["doc_id"]: r["lang_pred"] for r in language_mixtures(documents(spark, rows[60_000:]), model).collect()}
    assert got == {60_000 + i: x for i, x in enumerate(rare)}


def test_mixture_is_the_best_of_a_fine_grid():
    rng = np.random.default_rng(2)
    p = rng.dirichlet(np.ones(4096) * 0.05, 2).T.astype(np.float32) + 1e-7
    model = LanguageModel(["a", "b"], p / p.sum(axis=0))
    counts = rng.multinomial(500, (0.7 * model.probability[:, 0] + 0.3 * model.probability[:, 1]).astype(float) / 1.0001, 1)
    share = model.mixtures(counts, rounds=100)[0]
    grid = np.linspace(0.01, 0.99, 99)
    like = [(counts[0] * np.log(g * model.probability[:, 0] + (1 - g) * model.probability[:, 1])).sum() for g in grid]
    assert abs(share[0] - grid[int(np.argmax(like))]) < 0.02


def test_suffix_tree_gathers_only_retained_contexts(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 40}" for j in range(60)), None) for i in range(120)]
    gathered = []
    whole = type(documents(spark, rows[:1])).toArrow
    monkeypatch.setattr(type(documents(spark, rows[:1])), "toArrow",
                        lambda df: gathered.append((df.columns, whole(df))) or gathered[-1][1])
    monkeypatch.setattr(type(documents(spark, rows[:1])), "toPandas", lambda df: pytest.fail("counts went to the driver"))
    model, _ = suffix_tree.train_suffix_tree(documents(spark, rows), least_word=1e-4, least_symbol=1e-3, least_context=1e-3)
    trees = [t for names, t in gathered if "log_p" in names]
    assert [len(t) for t in trees] == [len(c) for c in model.tree.contexts[1:]] and len(model.tree.contexts[1]) > 5
    for k in (1, 2):
        assert (np.diff(model.tree.contexts[k]) > 0).all() and (np.diff(model.tree.keys[k]) > 0).all()
        assert len(model.tree.keys[k]) == len(model.tree.log_p[k])


def test_suffix_tree_against_brute_force(spark):
    rng = random.Random(6)
    values = [" ".join(rng.choice(EN if rng.random() < 0.9 else DE) for _ in range(30)) for _ in range(80)]
    values = [v.replace("the of", "The and") for v in values] + [None, "", "rare word the of", "the " * 20_000]
    rows = [(i, t, None) for i, t in enumerate(values)] + [(None, "the", None), (2, values[2], None)]
    model, words = suffix_tree.train_suffix_tree(documents(spark, rows[:60]), least_word=0.05, least_symbol=0.02)
    assert len(model.words) < len({w for v in values[:60] for w in v.lower().split()})        # so the join has work
    count = Counter(w for v in values[:60] for w in v.encode().lower().split())
    total, distinct = sum(count.values()) + 60, len(count) + 1
    log = lambda n: math.log10((n + 1) / (total + distinct + 1))
    got = suffix_tree.suffix_tree_scores(documents(spark, rows), model, words).collect()
    assert len(got) == len(rows)
    for r in got:
        own = ("the" if r["doc_id"] is None else values[r["doc_id"]] or "").encode().lower().split()
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own) + 1, sum(w in count for w in own) + 1, total)
        assert r["base_score"] == pytest.approx(sum(log(count[w]) for w in own) + log(60))
    held = [r for r in got if r["doc_id"] is not None and 60 <= r["doc_id"] < 80]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    tree, size = model.tree, model.tree.alphabet.size
    assert sum(map(len, tree.contexts[1:])) > 0
    for k in (1, 2):
        for code in tree.contexts[k]:                                 # every distribution sums to one
            ctx = [np.full(size, code % size ** j if j else 0) for j in range(k + 1)]
            assert (10 ** tree.log_next(ctx, np.arange(size), k)).sum() == pytest.approx(1)
    empty, none = suffix_tree.train_suffix_tree(documents(spark, []))
    assert suffix_tree.suffix_tree_scores(documents(spark, rows[:3]), empty, none).count() == 3


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(7)
    def make(i):
        words = [f"n{rng.randrange(400)}x" for _ in range(rng.randint(5, 60))]
        words = [w.replace(str(i), "") for w in words]
        toxic = i % 3 == 0
        return i, " ".join(words + (["scum", "Idiot!"] if toxic else [])), "en", int(toxic)
    made = [make(i) for i in range(400)]
    docs = documents(spark, [r[:3] for r in made] + [(900, None, None), (901, "", None), (None, "scum idiot", None), (902, "word " * 90_000, None)])
    labels = spark.createDataFrame([(r[0], r[3]) for r in made[:300]] + [(None, 1), (900, None)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity_scores(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 404
    assert np.mean([(got[r[0]] >= 0.5) == r[3] for r in made[300:]]) > 0.95
    assert got[None] >= 0.5 > got[902] and got[900] == got[901] < 0.5
    assert toxicity_scores(docs, train_toxicity(docs, labels.limit(0))).selectExpr("max(score)").first()[0] == 0
    assert toxicity_scores(docs.limit(0), ToxicityModel()).count() == 0


def test_quality_fit_equals_direct_ridge_and_isotonic(spark):
    rng = random.Random(3)
    rows = [(i, (" ".join(f"w{rng.randrange(500)}" for _ in range(50)) if i % 4 else "same same " * 20 + "*** | |"), None) for i in range(200)]
    rows += [(300, None, None), (301, "", None), (None, "w1 w2", None), (302, "a b " * 70_000, None)]
    stats = quality.document_statistics(documents(spark, rows).repartition(40)).checkpoint()
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(150)] + [(None, 1), (300, None)], "doc_id long, quality int")
    model = quality.train_quality(stats, labels)
    by = {r["doc_id"]: np.array(r["x"]) for r in stats.collect()}
    x, y = np.array([by[i] for i in range(150)]), np.array([i % 4 > 0 for i in range(150)], float)
    f = model.features(x)
    direct = np.linalg.solve(f.T @ f + 1e-4 * 150 * np.diag([1.0] * quality.FEATURES + [1e-9]), f.T @ y)
    assert np.allclose(f @ direct, f @ model.weights, atol=1e-6)
    assert (np.diff(model.values) >= 0).all()
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(stats, model).collect()}
    assert len(got) == 204 and all(0 <= s <= 1 for s in got.values()) and got[300] == got[301]
    assert np.mean([(got[i] >= 0.3) == (i % 4 > 0) for i in range(150, 200)]) > 0.95
    assert quality.quality_scores(stats, quality.train_quality(stats, labels.limit(0))).selectExpr("max(score)").first()[0] == 0
    assert quality.isotonic(np.array([1, 1, 2.0]), np.array([0.2, 0.9, 0.3])).tolist() == pytest.approx([0.2, 0.5, 0.5])
