"""The pipeline: each stage alone on odd rows, and all of them against the operators' own results."""

import re
from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from granary.llm import mixing, queries
from granary.session import stored


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        kept = docs
        for name, stage in pipeline.STAGES:
            alone = stage(spark, docs, "")
            assert alone.count() >= 0
            kept = stored(stage(spark, kept, ""), name)
            if name != pipeline.STAGES[-1][0]:
                assert {c for c in kept.columns if c in ("doc_id", "text", "lang", "source", "n_chars")} == {"doc_id", "text", "lang", "source", "n_chars"}


def test_run_applies_every_stage(spark, sf_dir, documents):
    rows = pipeline.run(spark, sf_dir).collect()
    good = {r.doc_id for r in queries.op9_adaptive_quality(spark, sf_dir).collect() if r.kept}
    assert rows and all(r.decodes for r in rows) and {r.doc_id for r in rows} <= good
    docs = pipeline.quality_rules(spark, documents, sf_dir)
    assert {r.doc_id for r in docs.collect()} == good
    single = stored(pipeline.near_duplicates(spark, stored(docs, "good"), sf_dir), "single")
    assert {r.doc_id for r in rows} <= {r.doc_id for r in single.collect()}
    clean = pipeline.personal_data(spark, single, sf_dir).collect()
    assert not any(re.search(r"[a-z0-9]@[a-z0-9]+\.", r.text) for r in clean) and all(r.n_chars == len(r.text) for r in clean)


def test_mix_is_dealt_to_shards_and_put_in_order(spark):
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i if i % 50 else None, words(i), "en", f"s{i % 3}", 0) for i in range(1, 900)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "docs")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")  # else these few rows are one file
    try:
        found = stored(pipeline.source_mix(spark, docs, ""), "mix")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    taken = {r.doc_id: r.shards.split(",") for r in mixing.allotments(docs).where("taken > 0 and doc_id is not null").collect()}
    at = found.select("doc_id", "shard", "order", F.input_file_name().alias("file")).collect()
    own = Counter((r.doc_id, str(r.shard)) for r in at if r.doc_id is not None)
    assert own == Counter((i, shard) for i, shards in taken.items() for shard in shards) and len({r.shard for r in at}) == 2**mixing.LEVELS
    files = [[(r.shard, r.order) for r in at if r.file == file] for file in sorted({r.file for r in at})]
    assert len(files) > 1 and all(places == sorted(places) for places in files)
    assert all(a[-1] <= b[0] for a, b in zip(files, files[1:]))
    ids = pipeline.byte_bpe(spark, found, "").select("doc_id", "shard", "order").collect()
    assert Counter(tuple(r) for r in ids) == Counter((r.doc_id, r.shard, r.order) for r in at)
