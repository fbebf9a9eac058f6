"""The pipeline's stages, each on what its predecessor kept, and as a whole."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snaplytics.llm import common
from snaplytics.llm.common import staged

from .tables import documents


@pytest.mark.parametrize("extra", [False, True])
def test_stages_in_order_and_run_agree(spark, tmp_path, extra):
    path = str(tmp_path)
    documents(spark, extra=extra).coalesce(2).write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, path), f"test-{name}")
        assert docs.columns == columns
        sizes.append(docs.count())
    good, lined, unique, mixed = sizes[1:]
    assert good < sizes[0] and lined == good and unique <= lined
    texts = [r.text for r in docs.collect()]
    assert sum(texts.count(t) > 2 for t in set(texts)) == 0  # nothing is taken more than twice
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    want = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in coded.collect()) == want
    whole = corpus_pipeline.run(spark, path)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, coded.collect()))


def test_empty_documents(spark, tmp_path):
    documents(spark, rows=[]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_staged_tables_leave_no_shuffle_files(spark):
    """The files of a staged table's shuffles go with its write; the setting is as before."""
    before = spark.conf.get(common.SHUFFLE_CLEANUP, None)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName().split("_")[1] for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    here = shuffles()
    df = spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).agg(F.max(F.col("id").cast("string")).alias("m"))
    out = common.staged(df, "cleanup")
    for _ in range(50):
        if shuffles() <= here:
            break
        time.sleep(0.1)
    assert shuffles() <= here
    assert out.count() == 500 and sorted(out.collect()) == sorted(df.collect())
    assert spark.conf.get(common.SHUFFLE_CLEANUP, None) == before


def test_a_stage_leaves_only_its_result(spark, tmp_path, monkeypatch):
    """Tables that a stage stages, and the result it reads, are gone when the next stage begins."""
    from pathlib import Path

    from snaplytics.session import scratch_path

    root = Path(scratch_path(spark, "x")).parent
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    before, seen = set(root.glob("llm-*")), []

    def watched(stage):
        def run(spark, docs, sf_dir):
            seen.append({p.name.rsplit("-", 1)[0] for p in set(root.glob("llm-*")) - before})
            return stage(spark, docs, sf_dir)
        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(s)) for n, s in corpus_pipeline.STAGES])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert seen == [set(), *({f"llm-pipeline-{n}"} for n, _ in corpus_pipeline.STAGES[:-1])]


@pytest.mark.parametrize("name, left", [("line_dedup", {"line-gone"}), ("simhash_dedup", {"simhash-marked", "simhash-losers", "simhash-ties"})])
def test_a_stage_on_its_own_leaves_what_its_result_reads(spark, name, left):
    """Tables staged on the way go within the stage, not only with the whole pipeline."""
    from pathlib import Path

    from snaplytics.session import scratch_path

    root, docs = Path(scratch_path(spark, "x")).parent, documents(spark)
    before = set(root.glob("llm-*"))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert {p.name.rsplit("-", 1)[0] for p in set(root.glob("llm-*")) - before} == {f"llm-{x}" for x in left}
    assert 0 < out.count() <= docs.count()


def test_lines_leave_texts_by_a_join_that_no_size_switches(spark):
    """Which lines go is broadcast or shuffled as Spark plans it from the table's files, without a hint up to a size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dict(corpus_pipeline.STAGES)["line_dedup"](spark, documents(spark), "")
        assert "ResolvedHint" not in (plan := out._jdf.queryExecution().analyzed().toString()) and "UnresolvedHint" not in plan
        assert out.count() == documents(spark).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
