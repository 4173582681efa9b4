"""Periodic runs against a plain search over all periods, and the query against the whole rule."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from helixframe.llm import op11_runs as op11
from helixframe.llm.queries import QUERIES


def plain_runs(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    """Every maximal stretch of words equal at a distance, for each distance; those with a smaller period are dropped."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            e = i
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            if e - i >= q and e - i + q >= least:
                found.setdefault((i, e - i + q), q)
            i = max(e, i) + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_match_plain_search():
    rng = random.Random(5)
    for t in range(600):
        n, kinds = rng.randrange(0, 70), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(kinds) for _ in range(n)]
        if t % 3 == 0 and n:
            a, p = rng.randrange(n), rng.randrange(1, n + 1)
            w = [w[i] if i < a else w[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(n)]
        for least in (2, 5, 12):
            assert op11.runs_of(w, least) == plain_runs(w, least), w
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 400:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    for w in (fibonacci[1], [0] * 300, [0, 1] * 100 + [0, 2] * 100, sorted(range(200), reverse=True) * 2):
        assert op11.runs_of(w) == plain_runs(w)


def test_cut_texts_match_whole_ones():
    rng = random.Random(6)
    texts = []
    for _ in range(60):
        parts = [[b"%d" % rng.randrange(40) for _ in range(rng.randrange(30))] for _ in range(3)]
        root = [b"%d" % rng.randrange(40) for _ in range(rng.randrange(1, 9))]
        texts.append(parts[0] + root * rng.randrange(5) + parts[1] + parts[0] + root[:1] * rng.randrange(14) + parts[2])
    texts += [[], [b"a"], texts[0] * 2, [b"a"] * 12, [b"a"] * 11, [b"a"] * 12]
    found = op11.runs_of_texts(texts)
    assert found == [plain_runs(t) for t in texts] and sum(map(len, found)) > 30


def test_failing_hashes_are_noticed(monkeypatch):
    monkeypatch.setattr(op11, "MODULUS", 7)
    rng = random.Random(7)
    for _ in range(50):
        w = [rng.randrange(2) for _ in range(60)]
        try:
            assert op11.runs_of(w) == plain_runs(w)
        except ValueError:
            pass


def test_long_text_takes_little_time():
    w = random.Random(8).sample(range(1000), 1000)
    assert op11.runs_of(w * 60) == [(0, 60_000, 1000)]
    assert op11.runs_of([0] * 60_000) == [(0, 60_000, 1)]


def test_rows_of_all_kinds(spark):
    rows = [(1, "a b " * 10, "x"), (1, "a b " * 10, "x"), (None, None, None), (2, None, "y"), (3, "", "y"), (4, " \t\n ", "y"), (5, "é é " * 12 + " ", "z")]
    df = spark.createDataFrame(rows, "`doc.id` long, runs string, collapsed string")
    got = op11.find_runs(df, "doc.id", "runs").collect()
    assert sorted((str(r[0]), [tuple(x) for x in r[1]], r[2]) for r in got) == sorted([("1", [(0, 20, 2)], "a b")] * 2 + [("None", [], ""), ("2", [], ""), ("3", [], ""), ("4", [], ""), ("5", [(0, 12, 1)], "é é  ")])
    assert op11.find_runs(df.limit(0), "doc.id", "runs").count() == 0


def test_query(spark, sf):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = plain_runs(w) if len(w) < 1500 else op11.runs_of([hash(x) % 2**40 for x in w])
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert got[d.doc_id] == want
        some += bool(runs)
    assert some > 5


def test_planted_tails_of_odd_rows(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    df = spark.createDataFrame([(ids[0], None), (ids[1], ""), (ids[2], " \n "), (ids[3], "one"), (None, "a  b")], "i long, t string")
    assert [r[0] for r in df.select(op11.with_planted_tails(F.col("i"), F.col("t"))).collect()] == ["", "", "", "one", "a  b"]
