"""Suffix sorting and the removal of repeated strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quarry.llm.common import ship_package
from quarry.llm.suffix_dedup import remove_repeats, repeated_windows, suffix_array

SCHEMA = "doc_id bigint, text string"


def test_suffix_array_equals_sorting():
    r = random.Random(1)
    for _ in range(1500):
        k = r.choice([1, 2, 3, 10])
        t = [r.randint(1, k) for _ in range(r.randint(0, 40))] + [0]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])
    for t in ([1] * 300 + [0], [1, 2] * 150 + [0], [2, 1] * 150 + [0], [1, 1, 2] * 90 + [0], [0]):
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("length", [32, 40, 47, 64, 100])
def test_windows_equal_brute_force(length):
    r = random.Random(length)
    for _ in range(60):
        core = bytes(r.randint(97, 122) for _ in range(300))
        fragments, offsets = [], []
        for _ in range(r.randint(1, 8)):
            a, b = r.randint(0, 60), r.randint(200, 300)
            f = bytearray(core[a:b])
            for _ in range(r.randint(0, 3)):
                f[r.randrange(len(f))] = 65
            fragments.append(bytes(f))
            offsets.append(100 - a)
        count = Counter(f[x : x + length] for f in fragments for x in range(len(f) - length + 1))
        want = [[x for x in range(len(f) - length + 1) if count[f[x : x + length]] > 1] or [-1] for f in fragments]
        first, last = repeated_windows(fragments, offsets, length)
        assert list(zip(first.tolist(), last.tolist())) == [(w[0], w[-1]) for w in want]


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[x : x + length] for _, t in data for x in range(len(t) - length + 1))
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for x in range(len(t) - length + 1):
            if count[t[x : x + length]] > 1:
                gone[x : x + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def result(df, length, **how):
    out = remove_repeats(df, length, **how)
    rows = out.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def odd_rows(seed, length):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé語") for _ in range(r.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, longer = text(length // 5), text(length // 2)
    texts = [None, "", "x" * (length - 1), "x" * (length + 20), "x" * 40, "ab" * length, "ab" * length + "c", " " * (3 * length), longer, longer, longer[1:], longer[: length // 2] + "?" + longer[length // 2 :]]
    for _ in range(40):
        texts.append(text(r.randint(0, length // 2)) + r.choice([passage, longer, longer[r.randint(0, 30) : -r.randint(1, 30)], ""]) + text(r.randint(0, length // 2)))
    for _ in range(10):  # near copies, with a byte changed here and there
        t = list(texts[20])
        for _ in range(3):
            t[r.randrange(len(t))] = "Z"
        texts.append("".join(t))
    texts.append(passage + text(10) + passage)  # twice in one text
    rows = list(enumerate(texts))
    return rows + [(None, texts[30]), (20, "another row of this identifier " + text(30)), rows[25], rows[25]]


@pytest.mark.parametrize("length,group_rows", [(40, 4000), (40, 3), (100, 4000), (400, 5)])
def test_removal_equals_brute_force(spark, length, group_rows):
    ship_package(spark)
    rows = odd_rows(length, length)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tag", "id", "start", "end", "gram", "digest", "n", "found", "spans", "kept"):
        df = df.withColumn(name, F.lit("clash"))
    got = result(df.repartition(4), length, group_rows=group_rows)
    assert got == brute(rows, length) and sum(t[2] for t in got) > 0


def test_texts_longer_than_a_slice(spark):
    ship_package(spark)
    r = random.Random(2)
    text = "".join(r.choice("abcdefgh") for _ in range(1_300_000))
    rows = [(1, text), (2, text[500_000:600_000]), (3, "q" + text[1_040_000:1_049_500])]
    got = result(spark.createDataFrame(rows, SCHEMA), 400)
    assert [t[:4] for t in got] == [(1, 1_300_000, 109_500, 2), (2, 100_000, 100_000, 1), (3, 9501, 9500, 1)]


def test_empty_and_short_tables(spark):
    ship_package(spark)
    assert result(spark.createDataFrame([], SCHEMA), 400) == []
    rows = [(1, None), (1, "a"), (None, "a")]
    assert result(spark.createDataFrame(rows, SCHEMA), 400) == brute(rows, 400)
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame(rows, SCHEMA), 31)


def test_query_on_documents_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    got = __spark_entry__.queries()["op12_suffix_dedup"](spark, folder).collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 400)
