"""The queries that SQL can't express, over a whole table, against plain versions."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece

from helixframe.llm import op06_media as op6
from helixframe.llm import op10_pieces as op10
from helixframe.llm.queries import QUERIES

from .test_operators import plain_set


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()


def test_media_query(spark, sf, docs):
    got = {r.doc_id: r for r in QUERIES["op6_media"](spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        raw = d.text.encode()
        want = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        media = op6.encode_pgm(np.frombuffer(want, np.uint8).reshape(-1, 64))
        r = got[d.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest()) and r.feature.startswith(op6.difference_hash(op6.decode_image(media)))


def test_join_query(spark, sf, docs):
    got = {r.doc_id: (r.group_id, r.group_rows, r.n_links, r.n_texts) for r in QUERIES["op7_jaccard_join"](spark, sf).collect()}
    sets = [plain_set(d.text) for d in docs]
    n = len(docs)
    link = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    group = list(range(n))
    changed = True
    while changed:
        new = [min([group[i], *(group[j] for j in link[i])]) for i in range(n)]
        changed, group = new != group, new
    for i, d in enumerate(docs):
        assert got[d.doc_id] == (docs[group[i]].doc_id, group.count(group[i]), len(link[i]), len({sets[j] for j in link[i]} - {sets[i]}))
    assert any(link)


def test_pieces_query(spark, sf, docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=op10.model_path())
    got = {r.doc_id: r for r in QUERIES["op10_pieces"](spark, sf).collect()}
    for d in docs:
        ids = sp.encode(d.text, add_bos=True, add_eos=True)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def test_folds(spark, sf, docs):
    for name, parts, held in (("op8_language", 4, 2), ("op9_toxicity", 5, 0)):
        for r in QUERIES[name](spark, sf).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) and 0 <= r.score <= 1
