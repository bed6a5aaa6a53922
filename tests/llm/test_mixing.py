"""Mixing: weights, exact streams and blocks against a plain version."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from llm_fixtures import docs_of  # noqa: F401

from rosterframe.llm import mixing as M


def passes(tokens, t):
    top = max(tokens.values())
    return {s: (n / top) ** (t - 1) for s, n in tokens.items()}


def entropy(tokens, t):
    w = {s: (n / sum(tokens.values())) ** t for s, n in tokens.items()}
    z = sum(w.values())
    return -sum(x / z * math.log(x / z) for x in w.values())


@pytest.fixture()
def shares(spark):
    def make(tokens):
        return spark.createDataFrame([(s, n / sum(tokens.values())) for s, n in tokens.items()], "source string, p double")
    return make


def test_exponent_meets_the_binding_limit(shares):
    tokens = {"a": 9000, "b": 700, "c": 300, "d": 40}
    t = M.exponent(shares(tokens), None, 3.0)
    assert max(passes(tokens, t).values()) <= 3.0 < max(passes(tokens, t - 2**-23).values())
    t = M.exponent(shares(tokens), 0.8, None)
    assert entropy(tokens, t) <= 0.8 * math.log(4) < entropy(tokens, t - 2**-23)
    both = M.exponent(shares(tokens), 0.8, 3.0)
    assert both == max(t, M.exponent(shares(tokens), None, 3.0))
    assert M.exponent(shares(tokens), None, None) == 0.0
    assert M.exponent(shares(tokens), 0.0, None) == 1.0  # out of reach: the natural mix
    assert M.exponent(shares({"a": 5}), 0.5, 1.0) == 0.0


def slow(rows, t, block_tokens, seed="mix"):
    docs = [(i, s, len((x or "").split()) + 1) for i, x, _, s in rows]
    tokens = Counter()
    for _, s, n in docs:
        tokens[s] += n
    quota = {s: int(math.floor(tokens[s] * e + 0.5)) for s, e in passes(tokens, t).items()}
    blocks = max(1, round(sum(quota.values()) / block_tokens))
    out = []
    for s, q in quota.items():
        at, epoch = 0, 0
        while at < q:
            keyed = sorted((hashlib.md5(f"{seed}|{epoch}|{'' if i is None else i}|{n}".encode()).hexdigest(), i, n) for i, x, n in docs if x == s)
            for k, i, n in keyed:
                if at < q:
                    out.append((i, s, n, epoch, int(at / q * blocks), k))
                at += n
            epoch += 1
    return sorted(out, key=str)


def test_streams_blocks_and_hot_source(docs_of, spark):
    rows = [(i, "w " * (i % 23), "en", "hot") for i in range(900)]
    rows += [(1000 + i, "x y " * (i % 5), "en", f"s{i % 4}") for i in range(160)]
    rows += [(5000, None, None, None), (5001, "", "en", None), (5002, "word " * 9000, "en", "long")]
    df = docs_of(rows).repartition(5)
    got = M.mix(df, max_repetition=2.5, block_tokens=2000, bucket_rows=8)
    assert got.columns == [*df.columns, "n_tokens", "epoch", "block", "order_key"]
    found = got.collect()
    tokens = Counter()
    for i, x, _, s in rows:
        tokens[s] += len((x or "").split()) + 1
    t = M.exponent(spark.createDataFrame([(n / sum(tokens.values()),) for n in tokens.values()], "p double"), None, 2.5)
    want = slow(rows, t, 2000)
    assert sorted(((r.doc_id, r.source, r.n_tokens, r.epoch, r.block, r.order_key) for r in found), key=str) == want
    assert {r.doc_id for r in found} == {r[0] for r in rows}  # nothing is lost
    per_block = defaultdict(Counter)
    for r in found:
        per_block[r.block][r.source] += r.n_tokens
    hot = [c["hot"] for b, c in sorted(per_block.items())]
    assert max(hot) - min(hot) <= 2 * 24  # every block has its share, to a document


def test_repeated_rows_and_clashing_columns(docs_of):
    rows = [(1, "a b", "en", "s")] * 3 + [(None, "a b", "en", "s"), (1, "c d", "en", "s")]
    df = docs_of(rows).withColumns({"Epoch": F.lit("old"), "n": F.lit(7), "start": F.lit(8), "row": F.lit(9), "p": F.lit(1)})
    got = M.mix(df)
    assert got.count() == 5 and {r.n for r in got.collect()} == {7}
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "n", "start", "row", "p", "n_tokens", "epoch", "block", "order_key"]
    assert M.mix(df.limit(0)).collect() == []


def test_main_path_is_native(docs_of):
    plan = M.mix(docs_of([(1, "a", "en", "s"), (2, "b", "en", "t")]), max_repetition=2.0)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
