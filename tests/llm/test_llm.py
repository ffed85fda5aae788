"""The training-data operators against brute force, their libraries and planted cases, on small tables."""

import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quarry.llm.bpe import bpe_tokens, word_bpe
from quarry.llm.common import ship_package
from quarry.llm.components import components
from quarry.llm.decontaminate import contaminated, least_equal, masks_of
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.language_id import in_held_out, train_language_model, with_language
from quarry.llm.ngram_join import ngram_components
from quarry.llm.secrets import BASE, MarkovPair, digest_columns, find_secrets, labelled_tokens, train_markov
from quarry.llm.token_counts import token_counts
from quarry.llm.token_files import TextEncoder, id_checksums, read_token_files, write_token_files
from quarry.llm.toxicity import score_toxicity, toxicity_samples, train_toxicity
from quarry.llm.url_reputation import judge_pages, registered_domain, suffix

SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [None, "", " ", "\n\n", "  a  b ", "x", "x", "X", "▁ a▁b", "it's <|endoftext|> 'S", "ΟΔΟΣ İ é", "a\x1cb c\u3000d",
             "日本語 text", "tab\there", " lead", "trail ", "a" * 5000, "word " * 3000, "." * 300, "x"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null and a repeated identifier, and columns whose names the operators use themselves."""
    ship_package(spark)
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", "en", "s", 1), (3, "\n\n", "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("digest", "lane", "host", "score", "sig", "node", "label", "ids", "shard", "id", "kept", "text_sha256"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- op 1
def test_urls_rules_and_posteriors(spark):
    urls = [("https://A.Example.NET/en/x?q", "a.example.net", "/en/x", "example.net/en/", "allow"), ("http://b.net/", "b.net", "/", "net/", "block"),
            ("http://b.net", "b.net", "", None, None), ("http://x.example.com/de/1#t", "x.example.com", "/de/1", "example.com/de/", "block"),
            ("ftp://org/fr/", "org", "/fr/", "org/fr/", "allow"), (None, "", "", None, None), ("no scheme", "", "", None, None),
            ("http://é.org/en", "é.org", "/en", None, None), ("a://b://c/d", "b:", "//c/d", None, None)]
    pages = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    out = {r.page_id: r for r in judge_pages(pages, spark.createDataFrame([], "page_id bigint, bad int")).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict == (verdict or "allow")
    assert judge_pages(pages.limit(0), spark.createDataFrame([], "page_id bigint, bad int")).count() == 0


def test_registered_domains_and_suffixes(spark):
    want = {"a.shop.co.uk": ("shop.co.uk", "co.uk"), "shop.co.uk:8080": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
            "x.com.au": ("x.com.au", "com.au"), "www.example.com:8080": ("example.com", "com"), "a.b.example.org": ("example.org", "org"),
            "10.0.0.1": ("10.0.0.1", "[ip]"), "10.0.0.1:80": ("10.0.0.1", "[ip]"), "[::1]:80": ("[::1]", "[ip]"), "[::1]": ("[::1]", "[ip]"),
            "localhost": ("localhost", "localhost"), "b:": ("b", "b"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    assert {r[0]: (r[1], r[2]) for r in df.select("host", registered_domain(F.col("host")), suffix(F.col("host"))).collect()} == want
    pages = spark.createDataFrame([(i, f"http://bad.co.uk/{i}") for i in range(200)] + [(200 + i, f"http://fine{i % 9}.co.uk/") for i in range(200)]
                                  + [(400, "http://unseen.co.uk/"), (401, "http://www.bad.co.uk:81/")], "page_id bigint, url string")
    out = {r.page_id: r.verdict for r in judge_pages(pages, spark.range(400).selectExpr("id page_id", "int(id < 200) bad")).collect()}
    assert (out[0], out[300], out[400], out[401]) == ("block", "allow", "allow", "block")


def test_reputation_shrinks_from_host_to_domain(spark):
    rows = [(f"http://bad.shop.io/{i}", 1) for i in range(200)] + [(f"http://new.shop.io/{i}", 1) for i in range(1)] + \
           [(f"http://good{j}.fine.org/{i}", 0) for j in range(5) for i in range(40)] + [("http://unseen.shop.io/", None), ("http://else.where.xyz/", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id bigint, url string")
    outcomes = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows)], "page_id bigint, bad int")
    out = {r.host: r for r in judge_pages(pages, outcomes).collect()}
    assert out["bad.shop.io"].verdict == "block" and out["good1.fine.org"].verdict == "allow"
    assert out["bad.shop.io"].bad_rate >= out["new.shop.io"].bad_rate >= out["good1.fine.org"].bad_rate
    assert out["new.shop.io"].bad_low < out["bad.shop.io"].bad_low
    assert abs(out["unseen.shop.io"].bad_rate - 0.99) < 0.1  # its domain's rate
    assert 0.4 < out["else.where.xyz"].bad_rate < 0.6  # the rate of all labels


# --- op 2
def expected_bpe(text):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = t.encode(text or "", add_special_tokens=False).ids
    said = t.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_bpe_equals_the_library(spark, docs, odd):
    for df in (docs, odd):
        want = [(r.doc_id, *expected_bpe(r.text)) for r in df.select("doc_id", "text").collect()]
        assert rows_of(bpe_tokens(df)) == sorted(want, key=str)
    assert bpe_tokens(empty(spark)).count() == 0


def test_bpe_round_trip_of_random_text():
    t, own, r = Tokenizer.from_file(P.path("word_bpe_49k.json")), word_bpe(P.path("word_bpe_49k.json")), random.Random(5)
    for _ in range(3000):
        text = "".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x250), r.randrange(0x370, 0x500), r.randrange(0x3040, 0x3100)])) for _ in range(r.randrange(30)))
        ids = t.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids and own.decode(ids) == t.decode(ids, skip_special_tokens=False)


# --- op 3
def brute_spans(text):
    found = []
    for k, (kind, pattern, least) in enumerate((("assign", BASE[0][1], 6), ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24))):
        for m in re.finditer(pattern, text):
            if len(m.group(2) if k == 0 else m.group(0)) >= least:
                found.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_secrets_base_spans(spark, docs, odd):
    neutral = MarkovPair(tuple([-1.0] * 66**2))
    texts = ["é token=abc password = 'x9+/=._-A'", "Token:  \"abcdefg SECRET=token = abcdefgh", "AKIA" + "A" * 15, "AKIA" * 6, "0" * 23 + " " + "f" * 24 + "g" + "a" * 30,
             "api_key=1 apikey:123456", "日本 " * 50 + "passwd=secretsecret " * 600]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for df in (docs, odd, more):
        out = digest_columns(find_secrets(df, neutral))
        for r in out.join(df.select("doc_id", "text"), "doc_id").collect():
            want = brute_spans(r.text or "")
            assert r.spans == want and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert find_secrets(empty(spark), neutral).count() == 0


def test_secrets_learned(spark, docs):
    r = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    planted = ["".join(r.choice(alphabet) for _ in range(32)) for _ in range(40)]
    plain = ["theandinghererestonbleatth", "ordinaryidentifiernameslike", "the_and_ing_that_is_with_re"]
    samples = labelled_tokens(docs).unionAll(spark.createDataFrame([("".join(r.choice(alphabet) for _ in range(32)), True) for _ in range(200)], "token string, is_random boolean"))
    df = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(planted + plain)], "doc_id bigint, text string")
    out = {x.doc_id: x for x in digest_columns(find_secrets(df, train_markov(samples))).collect()}
    assert sum(out[i].n_markov for i in range(40)) >= 36
    assert all(out[40 + i].n_markov == 0 for i in range(3))
    assert out[0].spans in ("markov:4:36", "")


# --- op 4
def test_language_held_out_accuracy(spark, docs):
    model = train_language_model(docs)
    out = with_language(docs.select("doc_id", "text", "lang"), model).withColumn("held", in_held_out(F.col("doc_id"))).collect()
    held = [r for r in out if r.held]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 and r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)


def test_language_odd_cases(spark, docs, odd):
    model = train_language_model(docs, epochs=1)
    out = with_language(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    for r in out.collect():
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert with_language(empty(spark), model).count() == 0
    nothing = train_language_model(empty(spark))
    assert {r.lang_pred for r in with_language(odd, nothing).collect()} == {"und"}


# --- op 5
def test_toxicity(spark, docs, odd):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    r = random.Random(2)
    words = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(600):
        text = [r.choice(words) for _ in range(r.randrange(30, 200))]
        for _ in range((i % 3) * 3):
            text.insert(r.randrange(len(text)), r.choice(["zorgish", "zorgen", "zorgeta", "blorg"]))
        rows.append((i, " ".join(text), int(i % 3 > 0)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = train_toxicity(toxicity_samples(df.where("doc_id < 400"), df.select("doc_id", "toxic")))
    assert (model.thresholds[1:] > model.thresholds[:-1]).all()
    out = {x.doc_id: x for x in score_toxicity(df, model).collect()}
    held = [x for x in rows if x[0] >= 400]
    assert sum(out[i].toxic == bool(t) for i, _, t in held) / len(held) > 0.97
    mean = lambda k: sum(out[i].expected_severity for i, _, _ in held if i % 3 == k) / len([1 for i, _, _ in held if i % 3 == k])
    assert mean(0) < mean(1) < mean(2)
    assert score_toxicity(odd, model).count() == odd.count() and score_toxicity(empty(spark), model).count() == 0
    none = train_toxicity(toxicity_samples(docs, labels.limit(0)))
    assert not any(x.toxic for x in score_toxicity(docs, none).collect())


# --- op 6
def brute_components(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and 100 * (n := len(sets[a] & sets[b])) >= 75 * (len(sets[a]) + len(sets[b]) - n) and sets[b]]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def near_copies(seed, lengths, copies, edits):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 8)))
    passage = [word() for _ in range(60)]
    out = []
    for n in lengths:
        base = [word() for _ in range(n)]
        if n % 2:
            base[n // 2 : n // 2] = passage
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randrange(edits + 1)):
                k = r.randrange(len(text))
                text[k : k + 1] = r.choice([[word()], [], [word(), word()]])
            out.append(" ".join(text).upper() if r.random() < 0.2 else "\n ".join(text))
    return list(enumerate(out))


def test_ngram_join_equals_all_pairs(spark, docs):
    first = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    made = near_copies(4, [1, 2, 4, 5, 6, 7, 8, 9, 12, 15, 18, 22, 30, 41, 50, 66, 90, 150, 200, 260, 400, 800], 9, 4)
    made += [(10_000 + i, t) for i, t in near_copies(9, [35, 52, 75, 101, 190, 301], 40, 9)]
    for rows in (first, made):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(df).collect()} == brute_components(rows)


@pytest.mark.parametrize("how", ["full filter", "join"])
def test_ngram_join_of_many_shared_signatures(spark, monkeypatch, how):
    """With a filter of 4096 bits, which lets nearly all through, and with the join that replaces it beyond its limit."""
    import quarry.llm.ngram_join as module

    ship_package(spark)
    rows = near_copies(12, [3, 8, 20, 35, 52, 90, 200], 12, 5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    if how == "full filter":
        monkeypatch.setattr(module, "FILTER_BITS", 12)
    got = ngram_components(df, filter_keys=0 if how == "join" else module.FILTER_KEYS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows)


def test_ngram_join_odd_cases(spark, odd):
    out = rows_of(ngram_components(odd))
    assert len(out) == odd.count() and (None, 1, None) in out
    want = brute_components([(i, t) for i, t in enumerate(ODD_TEXTS)])
    assert {r[0]: r[1:] for r in out if r[0] is not None} == want
    assert ngram_components(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (203, 202), (201, 202), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{i: 200 for i in range(200, 204)}}


# --- op 7
def expected_ids(text):
    return Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_token_files_round_trip(spark, docs, odd, tmp_path, encoding):
    for k, df in enumerate((docs, odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))):
        path = f"{tmp_path}/{encoding}{k}"
        write_token_files(df, path, encoding=encoding, page_rows=20)
        got = {r.doc_id: r for r in id_checksums(read_token_files(spark, path)).collect()}
        at = 0
        for r in df.select("doc_id", "text").orderBy("doc_id").collect():
            ids = expected_ids(r.text)
            raw = b"".join(i.to_bytes(4, "little") for i in ids)
            assert tuple(got[r.doc_id]) == (r.doc_id, at, len(ids), zlib.crc32(raw))
            at += len(ids)
        some = next(f for f in sorted((tmp_path / f"{encoding}{k}").glob("*.parquet")) if pq.ParquetFile(f).metadata.num_rows)
        column = pq.ParquetFile(some).metadata.row_group(0)
        last = column.column(column.num_columns - 1)
        assert ("RLE_DICTIONARY" in last.encodings) == (encoding == "dictionary") and (encoding == "dictionary" or "DELTA_BINARY_PACKED" in last.encodings)
        assert last.has_offset_index
    write_token_files(empty(spark), f"{tmp_path}/none")
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0


def test_token_files_of_null_and_repeated_identifiers(spark, odd, tmp_path):
    """Null identifiers first, rows of one identifier one behind the other, each with its own start."""
    rows = odd.select("doc_id", "text").collect() + [(5, "again"), (5, "again"), (None, "second")]
    df = spark.createDataFrame([tuple(r) for r in rows], "doc_id bigint, text string").repartition(3)
    write_token_files(df, f"{tmp_path}/t", shards=4)
    got = sorted(id_checksums(read_token_files(spark, f"{tmp_path}/t")).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == list(itertools.accumulate([0] + [r.n_tokens for r in got[:-1]]))
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if r[0] is None else r[0] for r in rows)
    crc = lambda t: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in expected_ids(t)))
    assert sorted(((r.doc_id, r.ids_crc32) for r in got), key=str) == sorted(((i, crc(t)) for i, t in rows), key=str)


def test_token_files_are_read_selectively(spark, docs, tmp_path):
    write_token_files(docs, f"{tmp_path}/t", page_rows=20)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    counts = read_token_files(spark, f"{tmp_path}/t", with_ids=False)
    assert "ids" not in plan(counts) and counts.count() == docs.count()
    some = read_token_files(spark, f"{tmp_path}/t").where("doc_id BETWEEN 40 AND 44")
    assert "GreaterThanOrEqual(doc_id,40)" in plan(some) and sorted(r.doc_id for r in some.collect()) == [40, 41, 42, 43, 44]


def test_encoder_equals_the_library_on_noise():
    encoder, library = TextEncoder(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    r = random.Random(3)
    pools = ["ab'sdtrevml  .,!?\n\t09", "éüßÀ\xa0¡ÿ ŁžɎ a1", "語か. x\u2009y\u0301", "<|endoftext|> a", "abcdefgh"]
    for k in range(4000):
        text = "".join(r.choice(pools[k % 5]) for _ in range(r.randrange(40)))
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("a" * 30_000, "".join(r.choice("abc") for _ in range(30_000)), " " * 5000, ODD_TEXTS[9]):
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


# --- op 8
def test_token_counts_equal_the_library(spark, docs, odd):
    sp = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    r = random.Random(1)
    noise = spark.createDataFrame([(i, "".join(r.choice("ab  \n\té.▁<s>") for _ in range(r.randrange(14)))) for i in range(2000)], "doc_id bigint, text string")
    for df in (docs, odd, noise):
        want = sorted(((x.doc_id, len((x.text or "").encode()), n := len(sp.encode(x.text or "")), n > 4096) for x in df.select("doc_id", "text").collect()), key=str)
        assert rows_of(token_counts(df, sample=0.5)) == want
    assert token_counts(empty(spark)).count() == 0


# --- op 9
def test_exact_dedup_odd_cases(spark, odd):
    out = rows_of(exact_dedup(odd))
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in [*enumerate(ODD_TEXTS), (None, "no id"), (3, "\n\n")]:
        groups.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    assert len(out) == odd.count()
    for i, keep, n, _, digest in out:
        ids = groups[digest]
        assert i in ids and n == len(ids) and keep == min((x for x in ids if x is not None), default=None)
    assert sum(r[3] for r in out) == len(groups)  # one row of each group, also where a row is repeated
    assert exact_dedup(empty(spark)).count() == 0


# --- op 10
def test_decontamination(spark, docs, odd):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9)))
    items = [" ".join(word() for _ in range(n)) for n in (8, 12, 25, 40, 70)] + ["too short", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").withColumn("doc_id", F.lit("clash"))
    planted, clean = [], []
    for k, item in enumerate(items[:5]):
        words = item.split()
        around = lambda: [word() for _ in range(50)]
        planted.append(" ".join(around() + words + around()))
        planted.append(" ".join(around()) + ".\n" + ", ".join(words).upper())
        if len(words) >= 25:
            changed = [word() if i % 9 == 4 else w for i, w in enumerate(words)]
            planted.append(" ".join(around() + changed + around()))
            clean.append(" ".join(around() + words[:7] + around()))
        clean.append(" ".join(r.sample(words, len(words)) + around()))
    df = spark.createDataFrame(list(enumerate(planted + clean)), "doc_id bigint, text string")
    assert {x.doc_id for x in contaminated(df, bench).collect()} == set(range(len(planted)))
    assert contaminated(odd, bench).count() == 0 and contaminated(empty(spark), bench).count() == 0
    assert contaminated(df, bench.limit(0)).count() == 0
    words = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    given = [(i.item_id, words(i.text)) for i in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    whole = {(d.doc_id, i) for d in docs.collect() for i, t in given if f" {t} " in f" {words(d.text)} "}
    assert whole <= {(x.doc_id, x.item_id) for x in contaminated(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}


def test_masks_miss_no_pattern():
    """Every way to change as many words as the limit allows, in windows of 1 to 24 words: some mask fits."""
    for width in range(1, 25):
        least, masks = least_equal(width, 0.8), masks_of(width, 0.8)
        fits = [{at + j for j, c in enumerate(m) if c == "1"} for m in masks for at in range(width - len(m) + 1)]
        assert all(any(not f & {*gone} for f in fits) for gone in itertools.combinations(range(width), width - least)), width
        assert width < 5 or any("0" in m for m in masks)


def test_windows_changed_anywhere_are_found(spark):
    """Items of 1 to 30 words with as many words changed as the limit allows, in each text another choice of them."""
    ship_package(spark)
    r, items, texts, want = random.Random(4), [], [], set()
    for n in range(1, 31):
        items.append(" ".join(f"w{n}x{i}" for i in range(n)))
        width = min(n, 20)
        for _ in range(40):
            at = r.randrange(n - width + 1)
            gone = r.sample(range(at, at + width), width // 5)
            words = [w if at <= i < at + width and i not in gone else "x" for i, w in enumerate(items[-1].split())]
            want.add((len(texts), n - 1))
            texts.append(" ".join(["y", *words, "z"]))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").repartition(3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert {(x.doc_id, x.item_id) for x in contaminated(df, bench).collect()} == want


def brute_overlaps(text, items, window=20):
    """item -> most equal words of a qualifying alignment, over all alignments."""
    out, words = {}, re.findall(r"\w+", text.lower())
    for k, item in enumerate(items):
        mine = re.findall(r"\w+", (item or "").lower())
        width = min(window, len(mine))
        for shift in range(-len(mine), len(words)) if width else ():
            a, b = max(0, shift), min(len(words), shift + len(mine))
            equal = [words[i] == mine[i - shift] for i in range(a, b)]
            good = [i for i in range(len(equal) - width + 1) if 5 * sum(equal[i : i + width]) >= 4 * width]
            if good:
                out[k] = max(out.get(k, 0), sum(equal[good[0] : good[-1] + width]))
    return out


def edge_cases(seed, words=60):
    """Items of 1 to 45 words, and texts that hold parts of them with one word in five changed, or one more."""
    r = random.Random(seed)
    word = lambda: f"v{int(r.paretovariate(0.6)) % words}"
    items = [" ".join(word() for _ in range(n)) for n in [*range(1, 25), 30, 45] for _ in range(2)]
    texts = []
    for item in items * 3:
        mine = item.split()
        width = min(20, len(mine))
        at = r.randrange(len(mine) - width + 1)
        part = mine[at : at + width]
        for i in r.sample(range(width), min(width, width // 5 + r.randrange(2))):
            part[i] = "changed"
        texts.append(" ".join([word() for _ in range(r.randrange(30))] + part + [word() for _ in range(r.randrange(30))]))
    return items, texts + ["", "v1", " ".join(["v1"] * 100)]


@pytest.mark.parametrize("words", [6, 60, 3000])
def test_decontamination_equals_all_alignments(spark, words):
    items, texts = edge_cases(5, words)
    ship_package(spark)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = sorted((x.doc_id, x.item_id, x.n_equal) for x in contaminated(df, bench).collect())
    assert got == sorted((d, i, n) for d, t in enumerate(texts) for i, n in brute_overlaps(t, items).items())


def test_decontamination_stage_equals_all_alignments(spark, tmp_path):
    import corpus_pipeline as C

    items, texts = edge_cases(6, 3000)
    items = [i for i in items if len(i.split()) >= 5]
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    kept = sorted(r.doc_id for r in C.decontamination_stage(spark, df, str(tmp_path)).collect())
    want = [d for d, t in enumerate(texts) if not brute_overlaps(t, items)]
    assert kept == want and 0 < len(want) < len(texts)


def test_decontamination_tasks_have_one_python_worker(spark, monkeypatch, capsys):
    from quarry.llm import decontaminate as D

    counts, cut = [], D.cut_lineage

    def counted(df):
        df.explain()
        counts.append(capsys.readouterr().out.count("MapInArrow"))
        return cut(df)

    monkeypatch.setattr(D, "cut_lineage", counted)
    item = " ".join(f"w{k}" for k in range(25))
    bench = spark.createDataFrame([(0, item)], "item_id bigint, text string")
    df = spark.createDataFrame([(0, f"a {item} b", "en", "s", 1), (1, "a b c", "en", "s", 1)], SCHEMA)
    assert [r.doc_id for r in D.without_contaminated(df, bench).collect()] == [1]
    assert [r.doc_id for r in D.contaminated(df, bench).collect()] == [0]
    assert max(counts) == 1, counts


# --- pipeline
def test_stages_treat_rows_not_identifiers(spark, tmp_path):
    """Null and repeated identifiers at the near-copy and the decontamination stage."""
    import corpus_pipeline as C

    r = random.Random(9)
    text = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    item, one, other, third = text(25), text(60), text(60), text(60)
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    left = lambda df: sorted(((x.doc_id, x.text) for x in df.collect()), key=str)
    bad = f"{one} {item}"
    kept = C.decontamination_stage(spark, table([(None, bad), (None, other), (5, bad), (5, other), (6, None), (7, third)]), str(tmp_path))
    assert left(kept) == sorted([(None, other), (5, other), (6, None), (7, third)], key=str)
    near = lambda t: f"{t} end"
    rows = [(2, one), (5, near(one)), (5, other), (None, near(other)), (None, third), (9, near(third)), (4, None), (None, ""), (7, bad), (7, bad)]
    kept = C.near_stage(spark, table(rows), str(tmp_path))
    assert left(kept) == sorted([(2, one), (5, other), (9, near(third)), (4, None), (None, ""), (7, bad), (7, bad)], key=str)


def test_pipeline_stages_against_brute_force(spark, docs, tmp_path):
    import corpus_pipeline as C

    extra = spark.createDataFrame([(9000, "12 34", "en", "s", 5), (9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 5)], SCHEMA)
    table = docs.unionAll(extra).unionAll(docs.limit(3))
    columns, before = table.columns, table
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, before, SMALL).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        rows, kept = before.collect(), after.collect()
        ids = {r.doc_id for r in kept}
        if k < len(C.STAGES) - 1:
            assert after.columns == columns
        if k == 0:
            assert not ids & {9000, 9001, 9002} and len(kept) == len([r for r in rows if any(map(str.isalpha, r.text or ""))])
        elif k == 1:
            norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
            least = {}
            for r in rows:
                least[norm(r.text)] = min(r.doc_id, least.get(norm(r.text), r.doc_id))
            assert sorted(r.doc_id for r in kept) == sorted(least.values())
        elif k == 2:
            assert ids == {i for i, (_, c) in brute_components([(r.doc_id, r.text) for r in rows]).items() if i == c}
        elif k == 3:
            found = {r.doc_id for r in contaminated(before, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
            assert found and ids == {r.doc_id for r in rows} - found
        else:
            assert rows_of(after.drop("ids")) == sorted(((r.doc_id, *expected_bpe(r.text)) for r in rows), key=str)
        before = after
    assert C.run(spark, SMALL).count() > 0
