"""Stages of the pipeline against brute force, on a small fixture with planted edited copies."""

import random
from collections import Counter

import pytest
from test_operators import plain_alignment, plain_targets, prose

import corpus_pipeline


def test_decontamination_and_mixing_equal_brute_force(spark, tmp_path):
    rng = random.Random(21)
    items = {k: prose(rng, size).split() for k, size in enumerate((30, 20, 9, 6, 3))}
    rows = []
    for d in range(60):
        words = prose(rng, 40).split()
        if d % 2:
            copy = list(items[d // 2 % 5])
            every = 3 + d % 4
            copy[every - 1 :: every] = ["edited" for _ in copy[every - 1 :: every]]
            words[20:20] = copy
        rows.append((d, " ".join(words), "en", "abbc"[d % 4], 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["benchmark decontamination"](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    clean.write.parquet(f"{tmp_path}/clean.parquet")
    clean = spark.read.parquet(f"{tmp_path}/clean.parquet")
    leaks = lambda text: any(plain_alignment(text.split(), w) >= max(len(w), 2 * min(5, len(w))) for w in items.values())
    want = {d for d, text, *_ in rows if not leaks(text)}
    assert {r["doc_id"] for r in clean.collect()} == want and 30 <= len(want) < 45

    taken, size = Counter(), Counter()
    for r in clean.collect():
        size[r["source"]] += len(r["text"].split())
    for r in stages["mixing"](spark, clean, str(tmp_path)).collect():
        taken[r["source"]] += len(r["text"].split())
    target = plain_targets(dict(size))
    assert taken == {s: pytest.approx(t, abs=70) for s, t in target.items()}
