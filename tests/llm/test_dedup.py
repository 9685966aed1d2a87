import hashlib
import itertools
import random

import numpy as np
import xxhash

from irspark.llm.decontam import contaminated
from irspark.llm.exact_dedup import exact_dedup
from irspark.llm.graph import connected_components
from irspark.llm.simhash import near_fingerprints, simhash_dedup

WORDS = [f"w{i}" for i in range(40)]


def texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fp string, keep_id string")


def test_exact_dedup_brute_force_with_digest_clashes(spark):
    base = texts(1, 12)
    rows = list(enumerate(base + [t.upper() for t in base[:6]] + [base[0]] * 30 + [None, "", "É", "é", "word " * 30_000]))
    rows += [(None, "only null"), (None, base[1]), (3, base[3])]
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    want = []
    for i, t in rows:
        norm = (t or "").encode().lower()
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids) if ids else None
        want.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm).hexdigest()))
    key = lambda r: tuple(str(x) for x in r)
    for size in (32, 1, 0):                                            # 0: every text has the same digest
        got = [tuple(r) for r in exact_dedup(documents(spark, rows), salts=3, digest_bytes=size).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    assert exact_dedup(documents(spark, rows).limit(0)).count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(points, linked):
    root = {p: p for p in points}
    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a, b in itertools.combinations(points, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in points}


def test_simhash_brute_force(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(400))
    near = [long + " tail" * k for k in range(6)]
    rows = list(enumerate(texts(2, 30) + near + [None, "", "one", "two words", long.upper(), "x y " * 60_000]))
    got = {r["doc_id"]: r for r in simhash_dedup(documents(spark, rows)).collect()}
    fps = {i: fingerprint(t) for i, t in rows}
    comp = components([i for i, _ in rows], lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {i: (f"{fps[i]:016x}", comp[i]) for i in fps} == {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()}
    assert len(set(comp.values())) < len(comp) - 5
    assert simhash_dedup(documents(spark, rows).limit(0)).count() == 0


def test_dense_fingerprints_lose_no_link(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    points = {centre}
    for p in [rng.getrandbits(64) for _ in range(20)] + [centre] * 60:
        for _ in range(rng.randint(0, 5)):
            p ^= 1 << rng.randrange(64)
        points.add(p)
    points = [int(np.array(p, np.uint64).view(np.int64)) for p in points]
    got = {r["node"]: r["root"] for r in near_fingerprints(spark.createDataFrame([(p,) for p in points], "fp long")).collect()}
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    want = components(points, lambda a, b: bits(a, b) <= 3)
    assert len({(got[p], want[p]) for p in points}) == len(set(got.values())) == len(set(want.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {}
    for r in got:
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [51, 61]


def brute_contaminated(docs, items, threshold=0.8, k=5):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    out = set()
    for (d, t), (i, q) in itertools.product(docs, items):
        g, own = grams(q), grams(t)
        if g and len(g & own) >= threshold * len(g) - 1e-9:
            out.add((d, i, len(g), len(g & own)))
    return out


def test_contamination_brute_force_on_both_paths(spark):
    rng = random.Random(3)
    word = lambda: f"t{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 5, 7, 30, 60, 150])))) for i in range(25)] + [(90, None), (91, ""), (92, "  ")]
    docs = []
    for d in range(30):
        body = [word() for _ in range(rng.choice([5, 400, 4000]))]
        for i in rng.sample(range(25), 2):
            part = items[i][1].split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                part[rng.randrange(len(part))] = word()
            at = rng.randrange(len(body))
            body[at:at] = [x.upper() for x in part]
        docs.append((d, " ".join(body)))
    docs += [(100, None), (101, items[0][1]), (102, items[0][1]), (103, (items[3][1] + " pad" * 50_000))]
    frame = documents(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contaminated(docs, items)
    assert len(want) > 20
    for limit in (1 << 20, 0):
        got = contaminated(frame, bench, broadcast_bytes=limit).collect()
        assert {tuple(r)[:4] for r in got} == want and len(got) == len(want)
    assert contaminated(frame, bench.limit(0)).count() == 0 and contaminated(frame.limit(0), bench).count() == 0
