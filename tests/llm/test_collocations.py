"""Collocations against brute force, and the tiles against a plain count."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import docs_of  # noqa: F401
from pyspark.sql import functions as F

from rosterframe.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, most=3, least=10, covered=50, top=2000):
    f, n = Counter(), Counter()
    for r in rows:
        lang = (r[2] if len(r) > 2 else "en") or "und"
        if len(r) > 2 and r[2] == "":
            lang = ""
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, most + 1):
                f.update((lang, tuple(ws[i:i + k])) for i in range(len(ws) - k + 1))
    considered = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    gone = set()
    for (lang, ws), a in considered.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                if 100 * a >= covered * f[lang, ws[i:i + k]]:
                    gone.add((lang, ws[i:i + k]))
    out = {}
    for (lang, ws), a in considered.items():
        if (lang, ws) not in gone:
            score, _, left, right = min((10**6 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]])
                                        for k in range(1, len(ws)))
            out.setdefault(lang, []).append((score, a, " ".join(ws), left, right))
    return sorted((lang, i, p, a, left, right, n[lang], s) for lang, xs in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(xs, key=lambda x: (-x[0], -x[1], x[2].encode()))[:top], 1))


def run(df, **k):
    out = C.collocations(df, **k)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(t == "bigint" for c, t in out.dtypes if c not in ("lang", "phrase"))
    return sorted(tuple(r) for r in out.collect())


def corpus(seed, n, words=40):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "ÀB", "x\x85y", "q r", "🙂"]
    out = []
    for i in range(n):
        ws = [vocabulary[min(int(x), len(vocabulary) - 1)] for x in rng.zipf(1.4, 60) - 1]
        out.append((i, "".join(w + rng.choice([" ", "\t", "  ", ". ", ",", "\n", "\r\n", " ", " "]) for w in ws), ["en", "fr", None, "en"][i % 4]))
    return out


@pytest.mark.parametrize("k", [2, 3, 4])
def test_brute_force(docs_of, k):
    rows = corpus(1, 60)
    rows += [(100 + i, "New York City! hot hot hot hot hot", "en") for i in range(30)]  # copies, overlaps, covered phrases
    rows += [(200, None), (201, ""), (202, "...", "xx"), (None, "new YORK", None), (203, " \t ", "en"), (204, "a b", "")] + [(205, "tie one", "fr"), (206, "tie two", "fr")] * 10
    df = docs_of(rows).withColumns({"chunk": F.lit(1), "words": F.lit("x"), "codes": F.lit(0), "a": F.lit(3), "n": F.lit(4)}).repartition(4)
    want = slow(rows, most=k)
    assert run(df, max_words=k) == want and len(want) > 30
    assert run(df, max_words=k, chunk_tokens=50) == want  # chunks of a few texts
    assert run(df, max_words=k, min_count=25, covered_pct=90, top=5) == slow(rows, k, 25, 90, 5)


def test_long_texts_and_pieces(docs_of, monkeypatch):
    rng = np.random.default_rng(3)
    one = " ".join(f"k{x}" for x in rng.integers(0, 30, 40_000))  # a single piece
    rows = [(1, one, "en"), (2, one[:5000].replace("k1 ", "k1. "), "en"), (3, "é" * 100_000 + " b c", "en")]
    want = slow(rows)
    assert run(docs_of(rows), chunk_tokens=1000) == want
    monkeypatch.setattr(C, "_SLICE", 64)
    words = [w for part in C.token_lists(rows[1][1].encode()) for w in part]
    whole = rows[1][1].encode().replace(b".", b" . ").split()
    assert words == whole


def test_empty(docs_of):
    df = docs_of([(1, "a b c")])
    assert run(df.limit(0)) == [] and run(df) == []
    assert run(docs_of([(1, None), (2, "")])) == []


def test_exact_beyond_64_bits(spark):
    big = 3_000_000_019
    df = spark.createDataFrame([(big, [big * 3 + 1, big], [big * 7, big]), (big, [big, big], [big, big])], "f long, pre array<long>, post array<long>")
    got = [r[0].score for r in df.select(C._lowest_cut()).collect()]
    assert got == [10**6 * big * big // ((3 * big + 1) * 7 * big), 10**6]


def test_tiles(monkeypatch):
    rng = np.random.default_rng(0)
    codes = np.minimum(rng.zipf(1.2, 300_000) - 2, 2999).astype(np.int32)  # -1 is a gap
    want = Counter((a, b) for a, b in zip(codes.tolist(), codes[1:].tolist()) if a >= 0 and b >= 0)
    for tile, dense in ((512, 1 << 14), (64, 50), (7, 1), (512, 10**9)):
        monkeypatch.setattr(C, "TILE", tile)
        monkeypatch.setattr(C, "DENSE", dense)
        a, b, n = C.count_adjacent(codes, 3000)
        assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want and len(n) == len(want)
    for few in ([], [-1], [0], [0, -1, 0]):
        assert len(C.count_adjacent(np.array(few, np.int32), 1)[0]) == 0
