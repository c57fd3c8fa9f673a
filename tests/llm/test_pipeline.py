import collections

import brute
import corpus_pipeline
from brute import SF
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.llm.store import staged


def test_stages_over_the_smallest_table(spark, documents):
    df, _ = documents
    docs, kept = df, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, SF), "stage")
        kept[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == df.columns
            rows = {r["doc_id"]: r for r in docs.collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
            given = [tuple(r) for r in before.select("doc_id", "text").collect()]
        if name == "line_dedup":
            report = {r[0]: r for r in brute.repeated_lines(given)}
            assert set(rows) >= {d for d, r in report.items() if not r[2]}
            assert set(rows) == {d for d, r in report.items() if not r[2] or (r[2] < r[1] and d in rows)}
            assert all(brute.space_words(rows[d]["text"]) for d, r in report.items() if r[2] and d in rows)
            assert all(brute.sha256(rows[d]["text"]) == report[d][3] for d in rows)
        if name == "simhash_near_dedup":
            assert set(rows) == {d for d, _, least in brute.near_groups(given) if d == least}
        if name == "benchmark_decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            found = {r[0]: r for r in brute.contamination(given, bench)}
            assert set(rows) == {d for d, r in found.items() if r[2] <= 0.5 * r[1]}
            text = dict(given)
            assert all(rows[d]["text"] == text[d] for d in rows if not found[d][5])
            assert all(brute.contamination([(d, rows[d]["text"])], bench)[0][1] == found[d][1] - found[d][2] for d in rows)
    packed = kept["best_fit_packing"].collect()
    assert collections.Counter(r["doc_id"] for r in packed if not r["piece"]) == collections.Counter(
        r["doc_id"] for r in kept["benchmark_decontamination"].collect())


def test_language_stage_keeps_clean_documents(spark, documents):
    """Documents labelled clean pass the stage, those without text or letters do not."""
    df, _ = documents
    clean = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    more = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "", "en", "s", 0), (-3, "12 34", "en", "s", 5)], df.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, df.unionByName(more), SF).collect()}
    assert clean and clean <= kept and not {-1, -2, -3} & kept


def test_pipeline_on_edge_and_empty_tables(spark, edge, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing columns, an empty benchmark, and no documents at all."""
    df, docs = edge
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").limit(0)
    for name, rows in (("edge", df.withColumn("lang", F.lit("en"))), ("none", df.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, f"{tmp_path}/edge").collect()
    given = {d for d, t in docs if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in packed} <= given and len(packed) > 5
    # of the equal long texts one is left, in pieces of 1024 ids that make up the whole
    long = [r for r in packed if r["doc_id"] in (6, 7)]
    assert {r["doc_id"] for r in long} == {6} and all(r["length"] <= 1024 for r in packed)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
