import random
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from irspark.llm.packing import Rooms, best_fit_decreasing, pack_documents, pack_windows, packed_sequences


def one_by_one(lengths, window):
    """Rooms left when each piece, longest first, goes to the tightest open window."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        left = rooms.pop(at) if at < len(rooms) else window
        insort(rooms, left - n)
    return rooms


def laid_out(counts, window):
    """Rooms left by the plan, after checking that no two pieces share a token's place."""
    plan, used = best_fit_decreasing(counts, window), defaultdict(list)
    for i, (length, first, sequence, each, offset) in enumerate(plan):
        last = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == length else counts[length]
        for r in range(last - first):
            used[sequence + r // each].append((offset + r % each * length, length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(used) == list(range(len(used)))
    return sorted(window - sum(n for _, n in pieces) for pieces in used.values())


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_one_by_one(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 2, 7, 16, 100, 2048])
    lengths = [rng.randint(1, window) if rng.random() < 0.6 else rng.choice([1, window, max(1, window // 3)])
               for _ in range(rng.randint(0, 900))]
    assert laid_out(dict(Counter(lengths)), window) == one_by_one(lengths, window)


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(3)
    few = {n: rng.randint(1, 50) for n in range(1, 2049)}
    many = {n: c * 10**9 + rng.randint(0, 10**9) for n, c in few.items()}
    assert len(best_fit_decreasing(many, 2048)) < 4 * 2048 * 11
    assert best_fit_decreasing({}, 2048) == []


def test_tightest_room():
    rng, rooms, held = random.Random(4), Rooms(50), Counter()
    for i in range(400):
        least = rng.randint(1, 50)
        want = min((c for c, n in held.items() if n and c >= least), default=None)
        assert rooms.tightest(least) == want
        if want and rng.random() < 0.5:
            rooms.take(want)
            held[want] -= 1
        else:
            rooms.add(least, i, 1)
            held[least] += 1


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "a", "The", ".", "'s", "é", " ", "\x1c", "２", "中", "<|endoftext|>", " <|endoftext|>",
             "\t", "!", "_", "’", "😀", "\x00", "text|>", "word", " word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    return texts + ["x" * 300_000, "one two " * 90_000, " ".join(f"u{i}" for i in range(3000)), "same", "same", "", None]


def test_documents_round_trip(spark):
    texts, tok = odd_texts(), tokenizer()
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(None, "no id", "x", 5), (3, "id three again", "x", 5), (3, "id three again", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string, sequence_id int").repartition(5)
    got = pack_documents(docs).cache()
    pieces = defaultdict(list)
    for r in got.collect():
        pieces[r["doc_id"]].append(r)
        assert r["length"] * 4 == len(r["ids"])
    for i, text in enumerate(texts):
        if i == 3:
            continue
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        mine = sorted(pieces[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == struct.pack(f"<{len(ids)}I", *ids)
        assert [r["start"] for r in mine] == [k * 2048 for k in range(len(mine))]
        assert {r["doc_tokens"] for r in mine} == {len(ids)}
    again = tok.encode("id three again", add_special_tokens=False).ids + [1]
    assert Counter(bytes(r["ids"]) for r in pieces[3])[struct.pack(f"<{len(again)}I", *again)] == 2 and len(pieces[None]) == 1
    laid = defaultdict(list)
    for r in got.collect():
        laid[r["sequence_id"]].append((r["offset"], r["length"]))
    left = []
    for inside in laid.values():
        at = 0
        for offset, n in sorted(inside):
            assert offset == at
            at += n
        left.append(2048 - at)
    assert sorted(laid) == list(range(len(laid)))
    assert sorted(left) == one_by_one([r["length"] for r in got.collect()], 2048)
    whole = {r["sequence_id"]: r for r in packed_sequences(got).collect()}
    for s, inside in laid.items():
        assert whole[s]["n_tokens"] == sum(n for _, n in inside) == len(whole[s]["ids"]) // 4
    a = got.where("doc_id = 7").first()
    assert bytes(whole[a["sequence_id"]]["ids"])[4 * a["offset"]:][:4 * a["length"]] == bytes(a["ids"])


def test_empty_and_wrong_lengths(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs).collect() == []
    with pytest.raises(ValueError, match="from 1 to 8"):
        pack_windows(spark.createDataFrame([(1, 0, 9)], "doc_id long, start long, length long"), window=8)


def test_query_digests(spark):
    import __spark_entry__ as E

    sf, tok = "/root/testdata/sf0.001", tokenizer()
    got = defaultdict(list)
    for r in E.queries()["op11_packing"](spark, sf).collect():
        got[r["doc_id"]].append(r)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = tok.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for r in got[d["doc_id"]]:
            some = ids[r["start"]:r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(some)}I", *some)) and r["doc_tokens"] == len(ids)
        assert sum(r["length"] for r in got[d["doc_id"]]) == len(ids)
    assert E.queries()["op11_packing"](spark, sf).where(F.col("ids_crc32") < 0).count() == 0
