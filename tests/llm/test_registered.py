"""The registered queries of the text operators and the pipeline."""

from collections import Counter

import pytest
from compare import connect, difference

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from sluice.llm import factor_machine, simhash
from sluice.llm.common import table
from sluice.llm.decontaminate import find_leaks
from sluice.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op1_decontaminate", *ORACLE_SQL)])
def test_query_returns_a_row_for_each_row(spark, name):
    source = "pages" if name == "op2_tag_paths" else "documents"
    assert QUERIES[name](spark, FOLDER).count() == table(spark, FOLDER, source).count()


def test_leaks_equal_a_search_for_whole_items(spark):
    """Every item whose words stand in a document in one piece is found, with score 1."""
    import re

    words = lambda t: " " + " ".join(re.findall(r"[^\W]+", (t or "").lower())) + " "
    docs = {r["doc_id"]: words(r["text"]) for r in table(spark, FOLDER, "documents").collect()}
    items = {r["item_id"]: words(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    found = QUERIES["op1_decontaminate"](spark, FOLDER).collect()
    assert want == {(r["doc_id"], r["item_id"]) for r in found if r["score"] == 1.0} and want


def test_components_equal_brute_force(spark):
    rows = QUERIES["op7_simhash_bk_trees"](spark, FOLDER).collect()
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    smallest = dict.fromkeys(prints)
    for d in sorted(prints):
        if smallest[d] is None:
            waiting = [d]
            while waiting:
                x = waiting.pop()
                if smallest[x] is None:
                    smallest[x] = d
                    waiting += [y for y in prints if (prints[x] ^ prints[y]).bit_count() <= 4]
    assert {r["doc_id"]: r["component_id"] for r in rows} == smallest


def test_pipeline_stages(spark):
    """Each stage against what its operator decides on the stage's own input."""
    docs = table(spark, FOLDER, "documents")
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        path = f"{spark.sparkContext.getCheckpointDir() or spark.conf.get('spark.checkpoint.dir')}/stage{len(outputs)}"
        result.write.mode("overwrite").parquet(path)
        outputs.append((docs, spark.read.parquet(path)))
        docs = outputs[-1][1]
    columns = table(spark, FOLDER, "documents").columns
    assert all(after.columns == columns for _, after in outputs[:-1])
    ids = lambda frame: {r["doc_id"] for r in frame.select("doc_id").collect()}
    (raw, good), (_, single), (_, clean), (before, mixed), (_, placed) = outputs
    model = factor_machine.train(raw, table(spark, FOLDER, "labels"), "quality")
    scores = raw.select("doc_id", factor_machine.quality_score(model).alias("s")).collect()
    assert ids(good) == {r["doc_id"] for r in scores if r["s"] >= 0.5}
    assert ids(single) == {r["component"] for r in simhash.simhash_groups(good).collect()}
    leaked = {r["doc_id"] for r in find_leaks(single, table(spark, FOLDER, "benchmark")).collect()}
    assert ids(clean) == ids(single) - leaked
    assert ids(mixed) <= ids(before) and max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3
    assert placed.count() == mixed.count() and placed.filter("shard is null").count() == 0
    assert corpus_pipeline.run(spark, FOLDER).count() == placed.count()
