"""The pipeline against a plain version of all its stages, on a small folder."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
from test_line_dedup import slow as slow_lines
from test_mixing import passes
from test_mixing import slow as slow_mix
from test_packing import assert_packed
from test_quality_rules import slow as slow_counts
from test_simhash import brute, slow_fp
from tokenizers import Tokenizer

import corpus_pipeline
from rosterframe.llm.mixing import exponent


def make_rows():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]

    def text(n):
        ws = [rng.choice(words) for _ in range(n)]
        return "\n".join(" ".join(ws[i:i + 12]) for i in range(0, n, 12))

    rows = []
    for i in range(160):
        t = text(rng.choice([20, 60, 90, 300])) + "\nsite footer here"
        rows.append((i, t, "en", "hot" if i % 3 == 0 else f"s{i % 5}"))
    rows += [(500 + i, rows[4][1], "en", f"s{i % 5}") for i in range(30)]  # exact copies
    rows += [(600 + i, rows[7][1] + " tail", "de", "s1") for i in range(10)]
    rows += [(700, None, None, None), (701, "", "en", "hot"), (702, "same same " * 90, "en", "s2"), (703, text(9000), "fr", "s3")]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def test_run_equals_brute_force(spark, tmp_path):
    rows = make_rows()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def passed(t):  # two labels certify no rule: only the base rule rejects
        n, _, _, _, rep = slow_counts(t)
        return not (n < 50 or 100 * rep > 50 * n)

    rows = [r[:4] for r in rows if passed(r[1])]
    texts = {i: t for i, t, _ in slow_lines(rows, 0.1, 2)}
    rows = sorted((i, texts[i], lang, s) for i, _, lang, s in rows)
    root = brute([slow_fp(r[1]) for r in rows], 4)
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    tokens = Counter()
    for _, t, _, s in rows:
        tokens[s] += len(t.split()) + 1
    shares = spark.createDataFrame([(n / sum(tokens.values()),) for n in tokens.values()], "p double")
    t = exponent(shares, 0.9999, 1.5)
    assert max(passes(tokens, t).values()) <= 1.5
    mixed = Counter(r[0] for r in slow_mix(rows, t, 50_000))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text, _, _ in rows:
        n = len(tok.encode(text).ids) + 1
        first = n - (n - 1) // 1024 * 1024
        for k, length in enumerate([first] + [1024] * ((n - first) // 1024)):
            want[(i, k, length)] += mixed[i]

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.length) for r in out) == want
    assert_packed(out)
    assert {i for i in range(500, 530)}.isdisjoint({r.doc_id for r in out})  # copies went


def test_stages_keep_the_columns(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).columns == docs.columns


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
