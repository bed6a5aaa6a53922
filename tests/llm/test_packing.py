"""Packing: exact ids, gapless places, and bins no worse than a brute-force search."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from llm_fixtures import docs_of  # noqa: F401

from rosterframe.llm import packing as P

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def assert_packed(rows, capacity=1024):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_whole_table(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.pack(docs).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    want = {}
    for d in docs.select("doc_id", "text").collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [2]
        n = -(-len(ids) // 1024)
        cuts = [0, *(len(ids) - 1024 * k for k in range(n - 1, -1, -1))]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d.doc_id, k)] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    assert got == want and len(rows) == len(want)
    assert assert_packed(rows) <= 1.01 * -(-sum(r.length for r in rows) // 1024)  # no solution has fewer than that


@pytest.mark.parametrize("text", ["", "plain", "a<|endoftext|>b", "  tabs\t\n\nand  é ñ 日本 😀 1234567 don't", "­\x00\x7f"])
def test_ids_equal_the_tokenizer(tok, text):
    enc = P.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert enc(text).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_other_tokenizer_files_fall_back():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert P.encoder(path)("Some words").tolist() == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


def best_fill(counts, capacity):
    longest = max(counts)
    items = [n for n, c in counts.items() for _ in range(c - (n == longest))]
    sums = {0}
    for n in items:
        sums |= {s + n for s in sums if s + n <= capacity - longest}
    return longest + max(sums)


def test_each_bin_is_the_fullest():
    rng = random.Random(5)
    for _ in range(200):
        cap = rng.randint(5, 60)
        counts = {n: rng.randint(1, 4) for n in rng.sample(range(1, cap + 1), min(cap, rng.randint(1, 7)))}
        used = P.fullest(counts, rng.sample(list(counts), len(counts)), cap)
        assert all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == best_fill(counts, cap)


def test_plan_uses_every_piece_once():
    rng = random.Random(6)
    hist = {n: rng.randint(0, 900) for n in range(1, 1025)}
    plan = P.bin_plan(hist, 1024)
    left = dict(hist)
    for times, used in plan:
        assert sum(n * k for n, k in used.items()) <= 1024
        for n, k in used.items():
            left[n] -= times * k
    assert not any(left.values())
    total = sum(n * c for n, c in hist.items())
    assert sum(t for t, _ in plan) <= 1.01 * total / 1024
    assert len(plan) <= 2 * 1024


def test_hot_length_and_edge_cases(spark, docs_of):
    rows = [(i, "same words here") for i in range(700)] + [(None, None), (None, None), (3, ""), (3, ""),
            (9, "long " * 30_000), (10, "x")]
    out = P.pack(docs_of(rows), with_ids=True).collect()
    assert_packed(out)
    assert sum(r.piece == 0 for r in out) == len(rows)
    assert [r.length for r in out if r.doc_id is None] == [1, 1]
    assert sum(r.length for r in out if r.doc_id == 9) == sum(len(r.ids) for r in out if r.doc_id == 9)
    assert assert_packed(out) == -(-sum(r.length for r in out) // 1024)
    assert P.pack(docs_of(rows).limit(0)).collect() == []
