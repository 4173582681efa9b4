"""Collocations against plain counting."""

from __future__ import annotations

import collections
import random
import re

import duckdb
import pytest

from helixframe.llm import op12_phrases as op12
from helixframe.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows: list[tuple], least: int, top: int) -> list[tuple]:
    count, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                count.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    out = collections.defaultdict(list)
    longest = collections.Counter()
    for (lang, *w), a in count.items():
        if len(w) == 3 and a >= least:
            for p in ((lang, *w[:2]), (lang, *w[1:])):
                longest[p] = max(longest[p], a)
    for (lang, *w), a in count.items():
        if len(w) > 1 and a >= least and not (len(w) == 2 and (lang, *w) in longest and 100 * longest[lang, *w] >= 50 * a):
            cuts = [(1_000_000 * a * a // (count[lang, *w[:k]] * count[lang, *w[k:]]), k) for k in range(1, len(w))]
            s, k = min(cuts)
            out[lang].append((-s, -a, " ".join(w).encode(), count[lang, *w[:k]], count[lang, *w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, r, total[lang], -s) for lang, c in out.items() for i, (s, a, p, x, r) in enumerate(sorted(c)[:top]))


def texts(rng: random.Random, n: int) -> list[tuple]:
    rows = []
    for _ in range(n):
        w = [rng.choice("a a a b b c d e É ß The THE x\x00 \U0001f600 q".split(" ")) + rng.choice(["", "", "", ".", ",", "\n", "\t", " ", "\x0b", " ;"]) for _ in range(rng.randrange(60))]
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), " ".join(w)))
    return rows + [("en", None), (None, ""), ("zz", " .,\t\n"), ("en", rows[0][1])] + [("en", "new york city " * 9 + "x")] * 3


@pytest.mark.parametrize("shard, span", [(10**6, 10**6), (200, 10**6), (60, 25), (300, 7)])
def test_collocations_match_plain_counts(spark, monkeypatch, shard, span):
    monkeypatch.setattr(op12, "SHARD_WORDS", shard)
    monkeypatch.setattr(op12, "RANGE_PATHS", span)
    rows = texts(random.Random(4), 150)
    df = spark.createDataFrame([(*r, "x") for r in rows], "lang string, text string, phrase string").repartition(3)
    for least, top in ((3, 2000), (10, 5), (1, 40)):
        got = sorted(map(tuple, op12.collocations(df, least=least, top=top).collect()))
        assert got == plain(rows, least, top)
    assert op12.collocations(df.limit(0)).count() == 0


def test_tries_keep_their_paths():
    rng = random.Random(9)
    found = op12.tokens([" ".join(rng.choice("abcdefg") for _ in range(300)).encode() for _ in range(4)])
    trie = op12.Trie.of_tokens(found)
    again = op12.Trie.loaded(trie.dumped())
    assert again.words == trie.words and (again.paths == trie.paths).all() and (again.counts == trie.counts).all()
    assert trie.below[-1] == 1200
    flat = b" ".join(found)
    assert trie.count((b"a",)) == found.count(b"a") and trie.count((b"a", b"b")) == sum(x == b"a" and y == b"b" for x, y in zip(found, found[1:]))
    assert flat and trie.count((b"zz",)) == 0
    few = op12.Trie.of_tokens(op12.tokens([b"a b", b"", b" . "]))
    assert few.paths.T.tolist() == [[1, 2, 0], [2, 0, 0]]
    wide = [b"%07d" % i for i in range(2**21 + 5)]  # three numbers don't fit in 64 bits
    paths = op12.np.array([[1, 1, 2**21 + 5], [2, 2, 0], [3, 3, 0]])
    words, got, counts = op12.merged([(wide, paths, op12.np.array([1, 2, 3])), (wide[:3], paths[:, :1], op12.np.array([4]))])
    assert words == wide and got.T.tolist() == [[1, 2, 3], [2**21 + 5, 0, 0]] and counts.tolist() == [7, 3]


def test_scores_are_exact(spark):
    rng = random.Random(2)
    rows = [(a, rng.randrange(a, 10**15), rng.randrange(a, 10**15)) for a in (rng.randrange(1, 10**rng.randrange(1, 15)) for _ in range(400))]
    rows += [(a, a, a) for a in (1, 10**15 - 1, 3)]
    from pyspark.sql import functions as F

    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", op12.score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert all(s == 1_000_000 * a * a // (x * r) for a, x, r, s in got) and {type(r[3]) for r in got} == {int}


def test_query(spark, sf):
    got = sorted(map(tuple, QUERIES["op12_collocations"](spark, sf).collect()))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()
    assert got == plain([tuple(r) for r in docs], 10, 2000) and len(got) > 50
    duckdb.sql(f"create or replace view documents as select * from '{sf}/documents.parquet'")
    assert sorted(duckdb.sql(op12.SQL).fetchall()) == got
