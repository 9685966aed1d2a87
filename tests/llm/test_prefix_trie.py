import hashlib
import random
import zlib

import numpy as np
import pytest

from irspark.llm.prefix_trie import RangeLeast, conversation_trie, prefix_trie, shared_heads, turn_arrays

SCHEMA = "conv_id long, turn int, role string, text string, depth string, key int"


def gathered(rows):
    digest = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs.setdefault(c, []).append((t is not None, t, digest(r, x), r, x))
    return {c: [(r, x) for *_, r, x in sorted(v, key=lambda y: y[:1] + ((y[1] or 0),) + y[2:3])] for c, v in convs.items()}


def spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[:len(p)] == p]
        childless = [q for q in under if not any(len(z) == len(q) + 1 and z[:len(q)] == q for z in under)]
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members),
                    sum(len(q) == len(p) + 1 for q in under), len(childless),
                    sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in under if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n, most, words):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 7 - 20 if seed % 2 else c
        for t in range(rng.randint(1, most)):
            rows.append((c, rng.choice([t, t, t, None]) if seed == 3 else t, rng.choice(["user", "assistant", None]),
                         rng.choice(words)))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA).repartition(5)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


COMMON = [(c, t, "user", f"same {t}") for c in range(1000, 1300) for t in range(4)]


@pytest.mark.parametrize("rows", [
    conversations(1, 60, 5, ["a", "b", "é😀", "", None]),
    conversations(2, 200, 3, ["x"]),                                          # few distinct sequences
    conversations(3, 80, 6, ["x", "yy"]) + [(None, 1, "user", "no conversation")],
    conversations(4, 20, 4, [f"w{i}" for i in range(90)]) + COMMON,           # one group over many blocks
    COMMON + [(5, t, "user", f"same {t}") for t in range(900)] + [(6, t, "user", f"same {t}") for t in range(901)],
    [(1, 0, None, None), (1, 0, None, None), (2, 0, "", "")],
], ids=["deep", "few", "nulls", "hot", "long", "repeats"])
@pytest.mark.parametrize("block_turns", [40, 1 << 18])
def test_equals_brute_force(spark, rows, block_turns):
    convs = gathered(rows)
    assert found(conversation_trie(frame(spark, rows), block_turns=block_turns)) == brute(convs)


@pytest.mark.parametrize("seed", [5, 6])
def test_shared_heads(spark, seed):
    rows = conversations(seed, 150, 7, [f"w{i}" for i in range(9)])
    convs = spliced(gathered(rows))
    assert any(not t for t in convs.values()) or seed == 6
    got = prefix_trie(shared_heads(turn_arrays(frame(spark, rows))), block_turns=64)
    assert found(got) == brute(convs)


def test_only_turnless_and_empty(spark):
    arrays = turn_arrays(frame(spark, [(3, 0, "u", "t"), (9, 0, "u", "t")])).selectExpr("conv_id", "slice(turns, 1, 0) AS turns")
    assert found(prefix_trie(arrays)) == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,9").hexdigest())]
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 100])
def test_range_least_and_extents(n):
    rng = np.random.default_rng(n)
    v = rng.integers(0, 6, n)
    t = RangeLeast(v)
    first = rng.integers(0, n, 200)
    last = np.array([rng.integers(f, n) for f in first])
    assert t.least(first, last).tolist() == [v[f:e + 1].min() for f, e in zip(first, last)]
    at, bound = rng.integers(0, n, 200), rng.integers(0, 7, 200)
    right, left = t.right(at, bound), t.left(at, bound)
    for s, b, r, m in zip(at, bound, right, left):
        assert all(v[s + 1:r + 1] >= b) and (r == n - 1 or v[r + 1] < b)
        assert all(v[m + 1:s + 1] >= b) and (m == 0 or v[m] < b)
