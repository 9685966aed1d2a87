import hashlib
import re
import time

import pytest

from irspark.llm.secrets import ACCESS, ENDPOINT, secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SECRET40, KEY = "aB3/" * 10, "AKIA" + "Z9" * 8
TEXTS = {
    1: None, 2: "", 3: "plain words only",
    4: f"Password = 'abcdefgh' und 😀 token:short, {KEY} and {'0f' * 16}x",
    5: "password: token: abcdefghij",                               # the failing match is consumed
    6: f"{SECRET40} alone is weak", 7: "AKIA2345 alone", 8: "see https://host.example/x",
    9: f"é AKIA2345 … {SECRET40}", 10: f"{KEY} {SECRET40} at https://host.example/x end",
    11: f"AKIA2345 {'w ' * 300}{SECRET40}", 12: "AKIAAKIAAKIA" + "A" * 8 + " " + "g" * 5 + "a" * 31 + " " + "b" * 70,
    13: f"https://host.example/x {KEY}", 14: f"secret = \"{SECRET40}\" AKIA2345",
}


def brute(text, scope=200):
    t = text or ""
    base = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    base += [("access", m.start(), m.end()) for m in re.finditer(ACCESS, t) if len(m[0]) >= 16]
    base += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    weak = [("weak_secret", m.start(), m.end()) for m in re.finditer("[A-Za-z0-9/+]{40,}", t) if len(m[0]) == 40]
    weak += [("weak_access", m.start(), m.end()) for m in re.finditer("A[KS]IA[A-Z0-9]+", t) if 8 <= len(m[0]) <= 40]
    weak += [("endpoint", m.start(), m.end()) for m in re.finditer(ENDPOINT, t)]
    weak = [w for w in weak if not any(b[1] <= w[1] and w[2] <= b[2] for b in base)]
    ids = [p for p in base + weak if p[0] in ("access", "weak_access")]
    secrets = [p for p in base + weak if p[0] in ("assign", "hex", "weak_secret")]
    near = lambda p, others: any(q[1] <= p[2] + scope and q[2] >= p[1] - scope for q in others)
    linked = [w for w in weak if (w[0] == "weak_access" or near(w, ids)) and (w[0] == "weak_secret" or near(w, secrets))]
    order = ["assign", "access", "hex", "weak_secret", "weak_access", "endpoint"]
    text_of = lambda xs: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(xs, key=lambda x: (x[1], order.index(x[0]), x[2])))
    return text_of(base), text_of(base + linked), len(linked)


def test_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in TEXTS.items()] + [(None, TEXTS[10], "y"), (10, TEXTS[10], "z")]
    got = secret_scan(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert len(got) == len(rows)
    for r in got:
        base, spans, n = brute(TEXTS[r["doc_id"] or 10])
        assert (r["spans"], r["n_linked"]) == (spans, n), r["doc_id"]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len([x for x in base.split(",") if x])
    assert {r["doc_id"]: r["n_linked"] for r in got if r["doc_id"] in (6, 7, 8, 9, 10, 11)} == {6: 0, 7: 0, 8: 0, 9: 2, 10: 2, 11: 0}


def test_empty_table(spark):
    assert secret_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 3])
def test_very_long_text(spark, n):
    text = ("lorem ipsum " * 20_000 + f"token = abcdefgh1 {KEY} ") * n
    row = secret_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["spans"] == brute(text)[1] and row["n_assign"] == n


def test_many_matches_in_one_text(spark):
    def seconds(n):
        text = " ".join(f"https://h{i}.example/x" for i in range(n)) + f" AKIA2345 {SECRET40} " + f"token={'q' * 9} " * (n // 100)
        docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string").repartition(2)
        began = time.time()
        row = secret_scan(docs).where("doc_id = 1").first()
        took = time.time() - began
        spans = row["spans"].split(",")
        at = text.index("AKIA2345")
        assert f"weak_access:{at}:{at + 8}" in spans and row["n_assign"] == n // 100
        assert row["n_linked"] == 2 + sum(m.end() >= at + 9 - 200 for m in re.finditer(ENDPOINT, text[:at]))
        return took

    seconds(200)
    few, many = seconds(10_000), seconds(60_000)
    assert many < 3 * few + 12                                       # six times the matches; a square would be 36 times
