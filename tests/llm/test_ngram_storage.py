"""What the n-gram join keeps on disk, and its count of shared signatures."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import quarry.llm.ngram_join as module
from quarry.llm.common import ship_package
from quarry.llm.ngram_join import Signer, ngram_components, pack_ascending, unpack, unpack_ascending
from quarry.session import Scratch, brief_shuffles, ensure_checkpoint_dir
from tests.llm.test_llm import brute_components, near_copies

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folders(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(top) if f.startswith("ngram-join")}, top


def test_only_the_answer_stays_on_disk(spark):
    ship_package(spark)
    rows = near_copies(21, [3, 8, 20, 35, 52, 90, 200], 8, 5)
    before, top = folders(spark)
    got = ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    (mine,) = folders(spark)[0] - before
    kept = [spark.read.parquet(f"{top}/{mine}/{k}").columns for k in sorted(os.listdir(f"{top}/{mine}"), key=int)]
    assert kept == [["id", "set_id", "n"], ["set_id", "node"], ["node", "component"]]  # no set, signature or pair
    assert spark.conf.get(CLEANUP) == "false"
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def left_after(spark, before):
    """Shuffle files that are left of an action; they are removed beside it."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_shuffle_files_go_with_their_action(spark):
    before = shuffle_files(spark)
    with brief_shuffles(spark):
        table = Scratch(spark, "shuffles").keep(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert not left_after(spark, before) and table.count() == 7


def test_the_pipelines_join_leaves_no_shuffle_files(spark):
    rows = near_copies(31, [8, 35, 90], 6, 4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    docs = spark.read.parquet(write(docs, f"{ensure_checkpoint_dir(spark)}/docs-{time.time_ns()}"))
    before = shuffle_files(spark)
    out = corpus_pipeline.near_stage(spark, docs, "")
    assert len(left_after(spark, before)) <= 8 * 2  # the last count of a few keys
    parts = {}
    for i, (_, c) in brute_components(rows).items():
        parts.setdefault(c, []).append(i)
    assert sorted(r.doc_id for r in out.collect()) == sorted(min(x) for x in parts.values())


def write(df, path):
    df.write.parquet(path)
    return path


@pytest.mark.parametrize("at_once,bucket", [(50, 10), (1_000_000, 1_000_000)])
def test_shared_signatures_are_those_of_several_sets(spark, monkeypatch, at_once, bucket):
    """A set that several tasks have written is one set: its signatures are not shared for that."""
    ship_package(spark)
    monkeypatch.setattr(module, "SIGNATURES_AT_ONCE", at_once)
    monkeypatch.setattr(module, "BUCKET_SHINGLES", bucket)
    texts = [t for _, t in near_copies(5, [4, 9, 25, 60, 150], 4, 3)] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(6)
    scratch = Scratch(spark, "shared")
    first = scratch.keep(module._identify("bigint", docs))
    sets = first.where("place IS NOT NULL").select("place", "set_id", "key", "n", "shingles")
    signer, sent = Signer(np.zeros(0, np.uint64), np.zeros(0, np.int64)), spark.sparkContext.broadcast
    copies = module._copies(sets, scratch)
    got = [r.sig for r in module._shared_signatures(sets, sent(signer), sent(copies)).collect()]
    own = {bytes(r.set_id): unpack(bytes(r.shingles)) for r in sets.collect()}
    assert len(copies) == sets.count() - len(own) > 0
    times = {}
    for s in own.values():
        for x in signer.signatures(s, signer.frequency(s))[0] >> np.uint64(module.SHORT):
            times[int(x)] = times.get(int(x), 0) + 1
    assert sorted(got) == sorted(x for x, n in times.items() if n > 1)


def test_packed_runs():
    for x in ([], [0], [2**64 - 1], [5, 5, 7, 2**63, 2**64 - 1]):
        x = np.array(x, dtype=np.uint64)
        assert unpack_ascending(pack_ascending(x), len(x)).tolist() == x.tolist()


def test_too_many_copies_are_signed_like_other_sets(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(module, "COPIES", 0)
    rows = list(enumerate([t for _, t in near_copies(8, [4, 20, 60], 4, 3)] * 3))
    got = ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)
