"""Rows that repeat very often, columns of any name, and executors without the package."""

import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from dumpwinnow.llm import rows as rows_module
from dumpwinnow.llm import ppm, simhash, substring, suffix_dedup
from dumpwinnow.llm.scratch import written
from tests.llm.conftest import EDGE

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ODD_NAMES = ("lang code", "a:b", "x-y", "tick`ed", "key", "carried", "hits")


def test_stages_take_columns_of_any_name(spark, tmp_path):
    rows = [(i, t, "en", s, len(t or ""), *range(len(ODD_NAMES))) for i, t, s in EDGE]
    names = ["doc_id", "text", "lang", "source", "n_chars", *ODD_NAMES]
    kinds = ["long", "string", "string", "string", "long", *["int"] * len(ODD_NAMES)]
    quoted = ["`" + n.replace("`", "``") + "`" for n in names]
    docs = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(quoted, kinds, strict=True)))
    spark.createDataFrame([(7, 1), (1, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one lonely line")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = written(stage(spark, docs, str(tmp_path)))
        assert kept.schema == docs.schema
        assert all(tuple(r)[5:] == tuple(range(len(ODD_NAMES))) for r in kept.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


ELSEWHERE = """
import sys
sys.path.insert(0, {repository!r})
import corpus_pipeline
from dumpwinnow.llm import queries
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(["w%d " % k * 30 for k in range(40)])]
spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet({folder!r} + "/documents.parquet")
spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int").write.parquet({folder!r} + "/labels.parquet")
spark.createDataFrame([(1, "one lonely line")], "item_id long, text string").write.parquet({folder!r} + "/benchmark.parquet")
spark.createDataFrame([(k, [k / 9, 1.0], k % 3) for k in range(200)], "vec_id long, embedding array<float>, label int").write.parquet({folder!r} + "/embeddings.parquet")
corpus_pipeline.run(spark, {folder!r}).collect()
for name in ("op4_decontaminate", "op6_quality_rules", "op10_attention_mil", "op11_periodic_runs", "op12_hard_negatives", "op13_pivot_simhash"):
    assert queries.all_queries()[name](spark, {folder!r}).collect(), name
print("finished")
"""


def test_executors_need_not_have_the_package(tmp_path):
    """Workers started in another folder and without a path to the repository."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = ELSEWHERE.format(repository=REPOSITORY, folder=str(tmp_path / "shared"))
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert "finished" in done.stdout, done.stderr[-3000:]


def test_very_many_equal_rows(spark):
    """10,000 rows of one id and text: no list of theirs grows with their number."""
    text = " ".join(f"a{k}" for k in range(150))
    docs = spark.range(10_000).selectExpr("cast(null as long) AS doc_id", f"'{text}' AS text")
    docs = docs.unionByName(spark.createDataFrame([(1, f"{text} z"), (2, "b")], "doc_id long, text string"))
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], bytes(r["kept"]), len(r["removed"])) for r in rows) == {
        (None, b"", 1): 10_000, (1, b" z", 1): 1, (2, b"b", 0): 1,
    }
    texts = substring.keyed(docs, "doc_id", "text").selectExpr(
        "key", f"coalesce(doc_id, {substring.LAST}) AS rank", "text"
    )
    spans = substring.repeated_spans(texts, substring.SIZE, substring.CORE)
    assert spans.selectExpr("max(size(spans))").first()[0] <= 101
    rows = substring.remove_windows(docs).collect()
    assert Counter((r["doc_id"], r["kept"]) for r in rows) == {(None, ""): 10_000, (1, f"{text} z"): 1, (2, "b"): 1}
    rows = simhash.near_duplicates(docs).collect()
    assert Counter(r["component_id"] for r in rows) in ({1: 10_001, 2: 1}, {1: 1, 2: 1, None: 10_000})


def test_equal_rows_are_scored_in_many_groups(spark, monkeypatch):
    sizes = spark.sparkContext.accumulator(0)
    most = spark.sparkContext.accumulator(0)
    asked = ppm.distinct_keys

    def watched(table):
        sizes.add(1)
        most.add(table.num_rows)
        return asked(table)

    monkeypatch.setattr(ppm, "distinct_keys", watched)
    docs = spark.range(3000).selectExpr("7L AS doc_id", "'the same short text' AS text")
    rows = ppm.score_texts(docs, block_bytes=2000).collect()
    assert len(rows) == 3000 and len({r["score"] for r in rows}) == 1
    assert sizes.value >= 20 and most.value >= 3000


def test_every_scoring_task_releases_its_memory(spark, monkeypatch):
    done = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(rows_module, "release", lambda: done.add(1))
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('some short text ', id) AS text")
    assert ppm.score_texts(docs.repartition(3), block_bytes=20_000).count() == 3000
    assert done.value >= 3 + 2 * 2  # of counting, and two of each block
