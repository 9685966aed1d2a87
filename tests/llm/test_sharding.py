import random
from collections import Counter

import pytest

from irspark.llm.sharding import allowed_moves, balanced_shards, gather, gather_large, quotas, shard_documents


def cells_of(df):
    return {(r["grp"], r["shard"]): r["n"] for r in df.collect()}


def spread(seed, sizes, shards):
    """An even start: rows in random order, dealt to the shards in turn."""
    rng = random.Random(seed)
    rows = [g for g, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(rows)
    return Counter((g, i % shards) for i, g in enumerate(rows))


def split(cells):
    return sum(n > 1 for n in Counter(g for (g, _), n in cells.items() if n).values())


def loads(cells, shards):
    by = Counter()
    for (_, s), n in cells.items():
        by[s] += n
    return [by[s] for s in range(shards)]


@pytest.mark.parametrize("seed", range(3))
def test_rounds_move_rows_and_lower_the_cut(spark, seed):
    shards, sizes = 8, [700, 300, 300, 90, *[random.Random(seed).randint(2, 9) for _ in range(600)]]
    start = spread(seed, sizes, shards)
    quota = quotas(sum(sizes) + 1500, shards)
    frame = spark.createDataFrame([(g, s, n) for (g, s), n in start.items()], "grp long, shard int, n long")
    trace = []
    end = cells_of(gather(frame, shards, quota, trace=trace))
    assert cells_of(gather(frame, shards, quota, rounds=0)) == start != end
    assert trace[0][0] == 0 and trace[1][0] > 0 and [t[2] for t in trace] == sorted((t[2] for t in trace), reverse=True)
    assert split(start) > 500 and split(end) <= 2
    assert Counter(g for (g, s), n in end.items() for _ in range(n)) == Counter(dict(enumerate(sizes)))
    assert all(x <= q for x, q in zip(loads({k: n for k, n in end.items() if sizes[k[0]] > 64}, shards), quota))


def test_without_free_room_flows_are_matched(spark):
    shards, sizes = 4, [5] * 400                                    # every row is linked
    start = spread(3, sizes, shards)
    frame = spark.createDataFrame([(g, s, n) for (g, s), n in start.items()], "grp long, shard int, n long")
    trace = []
    end = cells_of(gather(frame, shards, quotas(2000, shards), trace=trace))
    assert split(start) > 350 and split(end) < 20 and len(trace) > 1


def test_large_groups_gather_where_most_of_them_is():
    cells, room = {1: {0: 3, 1: 9, 2: 1}, 2: {0: 40, 1: 30, 2: 30}}, [100, 20, 0]
    moved = gather_large(cells, room)
    assert {s: n for s, n in cells[2].items() if n} == {0: 100} and moved == 60 + 4
    assert {s: n for s, n in cells[1].items() if n} == {1: 13}
    cells, room = {7: {0: 10, 1: 8, 2: 6}}, [3, 3, 3]               # more than any shard can hold
    assert gather_large(cells, room) == 6 and sorted(cells[7].values()) == [0, 11, 13] and room == [0, 0, 9]


def test_grants_never_exceed_the_room():
    rng = random.Random(8)
    for _ in range(300):
        k = rng.randint(2, 6)
        room = [rng.randint(-5, 20) for _ in range(k)]
        wanted = {(a, b): rng.randint(1, 15) for a in range(k) for b in range(k) if a != b and rng.random() < 0.5}
        grant = allowed_moves(wanted, [0] * k, room)
        assert all(0 <= grant[m] <= n for m, n in wanted.items())
        net = [sum(n for (a, b), n in grant.items() if b == s) - sum(n for (a, b), n in grant.items() if a == s) for s in range(k)]
        assert all(x <= max(r, 0) for x, r in zip(net, room))


def test_documents_move_and_clashing_columns_are_ignored(spark):
    rng = random.Random(9)
    values = ["copy " + str(i // 3) for i in range(240)] + ["hot"] * 150 + [f"alone {i}" for i in range(200)] + [None, "", "long " * 30_000]
    rows = [(i, t, 7, "x", 3) for i, t in enumerate(values)] + [(None, "copy 1", 7, "x", 3), (4, values[4], 7, "x", 3), (4, values[4], 7, "x", 3)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, size string, slot int").repartition(4)
    trace = []
    got = shard_documents(docs, 4, trace=trace).collect()
    still = shard_documents(docs, 4, rounds=0).collect()

    def groups(rows):
        by = {}
        for r in rows:
            by.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        return sum(len(s) > 1 for s in by.values())

    assert len(got) == len(still) == len(rows) and groups(still) > 60
    assert groups(got) <= 1 and trace[1][0] > 100 and trace[-1][2] < trace[0][2]
    for result in (got, still):
        load = Counter(r["shard"] for r in result)
        assert max(load.values()) - min(load.values()) <= 1
        assert all(sorted(r["slot"] for r in result if r["shard"] == s) == list(range(n)) for s, n in load.items())
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert {type(r["size"]) for r in got} == {int} and len({r["size"] for r in got}) > 3


def test_general_graphs(spark):
    nodes = spark.createDataFrame([(i,) for i in range(40)], "id long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 20, 2)] + [(None, 3), (5, 99), (6, 6)], "a long, b long")
    got = {r["id"]: r["shard"] for r in balanced_shards(nodes, edges, 4).collect()}
    assert sorted(Counter(got.values()).values()) == [10] * 4
    assert sum(got[i] == got[i + 1] for i in range(0, 20, 2)) >= 8
    assert balanced_shards(nodes.limit(0), edges, 4).count() == 0
