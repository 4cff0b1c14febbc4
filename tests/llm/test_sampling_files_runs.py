"""Importance resampling, files of packed ids and periodic runs against brute force, exact round trips and SQL, on rows of every awkward kind."""

import collections
import glob
import hashlib
import math
import os
import re

import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fluxgrain.llm import importance, packedids, periodic, registry
from fluxgrain.llm.crc import crc32_sql
from fluxgrain.llm.words import words

DATA = "/root/testdata/sf0.001"


def clashing(docs):
    """docs with columns named as those that the operators make."""
    names = ("score", "rank", "weight", "features", "bucket", "n", "runs", "collapsed", "start", "length", "period", "ids", "words", "_b", "n_words", "g")
    return docs.withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", ["op11_resample", "op13_runs"])
def test_sql(spark, con, name):
    got = registry.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want))


def test_crc32_sql(con):
    for s in ("", "a", "héllo 日本 \U0001f600", "12345678901"):
        assert con.execute(f"SELECT {crc32_sql('s')} FROM (SELECT ?::VARCHAR AS s)", [s]).fetchall()[0][0] == zlib.crc32(s.encode())


# importance resampling


def naive_resample(rows, target, share=25, least=20, seed=7, n=2, buckets=10_000):
    def features(t):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return ws, [zlib.crc32(" ".join(ws[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(ws) - k + 1)]

    s, t = collections.Counter(), collections.Counter()
    for _, x in rows:
        s.update(features(x)[1])
    for x in target:
        t.update(features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
    out = []
    for i, x in rows:
        ws, f = features(x)
        weight = sum(map(gain, f)) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([i, len(f), weight, score, len(ws)])
    may = sorted((r for r in out if r[0] is not None and r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = collections.defaultdict(list)
    for k, r in enumerate(may[: len(may) * share // 100], 1):
        rank[r[0], r[3]].append(k)
    return [(*r[:4], rank[r[0], r[3]].pop(0) if r[4] >= least and rank[r[0], r[3]] else None) for r in out]


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("n,block", [(2, 1 << 20), (2, 50), (1, 300), (3, 1000)])
def test_resample(spark, docs, n, block):
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(None, "no id " * 30), (None, None)], "doc_id bigint, text string"))
    target = spark.createDataFrame([("Alpha beta GAMMA alpha beta",), (None,), ("",), ("ünï 日本語 9x",)], "text string")
    got = importance.resample(clashing(rows), target.withColumn("doc_id", F.lit("clash")), share=40, n=n, block=block)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    have = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()]
    want = naive_resample([tuple(r) for r in rows.collect()], [r[0] for r in target.collect()], share=40, n=n)
    assert sorted(have, key=key) == sorted(want, key=key)


def test_resample_ranks(spark):
    scored = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(30).alias("n_words"), (F.col("id") * 7919 % 300 - 150).alias("score"))
    got = importance.ranked(scored.unionByName(scored.limit(40).withColumn("n_words", F.lit(3))), 50, 20).collect()
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 2501)) and len(got) == 5040
    assert [(r["score"], r["doc_id"]) for r in drawn] == sorted(((r["score"], r["doc_id"]) for r in got if r["n_words"] == 30), key=lambda x: (-x[0], x[1]))[:2500]


def test_resample_empty(spark, docs, empty):
    assert importance.resample(empty, docs).count() == 0
    got = importance.resample(docs, empty)  # a target without features: weights are still defined
    assert got.count() == docs.count() and got.where("weight IS NULL").count() == 0


def test_resample_prefers_target(spark):
    texts = [(i, ("quick brown fox jumps over lazy dogs " if i % 2 else "lorem ipsum dolor sit amet elit sed ") * 5) for i in range(400)]
    got = importance.resample(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame([("the quick brown fox jumps over lazy dogs",)] * 50, "text string"))
    drawn = [r["doc_id"] for r in got.where("rank IS NOT NULL").collect()]
    assert len(drawn) == 100 and sum(i % 2 for i in drawn) > 90


# files of packed ids


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32), st.data())
def test_bits(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=40)), dtype="<u4")
    packed = packedids.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert packedids.unpack(packed, len(ids), bits).tolist() == ids.tolist()
    assert sum(int(x) << bits * i for i, x in enumerate(ids)) == int.from_bytes(packed, "little")


def test_width():
    assert [packedids.width(v) for v in (1, 2, 3, 32_000, 32_768, 32_769, 50_257, 65_537)] == [1, 1, 2, 15, 15, 16, 16, 17]


def own_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def test_packed_ids(spark, docs, tmp_path):
    rows = docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("bigint")))
    path = f"{tmp_path}/ids"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several shards, small as the table is
    packedids.write(clashing(rows), path, block=1000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(packedids.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got if r["doc_id"] is not None] == sorted(r["doc_id"] for r in rows.where("doc_id IS NOT NULL").collect())
    assert [r["doc_id"] for r in got[-3:]] == [None] * 3
    texts = collections.defaultdict(list)
    for r in rows.collect():
        texts[r["doc_id"]].append(tuple(own_ids(r["text"])))
    stream, have = [], collections.defaultdict(list)
    for r in got:
        assert r["start"] == len(stream)
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        have[r["doc_id"]].append(tuple(ids))
        stream += ids
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in texts.items()}
    m = packedids.manifest(path)
    assert m["bits"] == 16 and sum(s["ids"] for s in m["shards"]) == len(stream) and len(m["shards"]) > 1
    for a, b in ((0, 0), (0, 1), (999, 1001), (5, len(stream) - 7), (len(stream) - 1, len(stream)), (len(stream), len(stream) + 5)):
        assert packedids.ids_at(path, a, b).tolist() == stream[a:b]
    with pytest.raises(Exception, match="written already"):
        packedids.write(docs.limit(1), path)
    assert packedids.read(spark, path).count() == len(got)  # what failed left the folder as it was


def test_packed_ids_narrow(spark, tmp_path):
    path = f"{tmp_path}/narrow"
    rows = spark.createDataFrame([(i, np.arange(i % 7 * 100, dtype="<u4").tobytes()) for i in range(50)], "doc_id bigint, ids binary").coalesce(1)
    spark.dataSource.register(packedids.PackedIds)
    rows.write.format("packed_ids").option("vocabulary", 600).option("block", 64).mode("append").save(path)
    assert packedids.manifest(path)["bits"] == 10
    got = packedids.read(spark, path).orderBy("doc_id").collect()
    assert all(np.frombuffer(r["ids"], dtype="<u4").tolist() == list(range(r["doc_id"] % 7 * 100)) for r in got) and len(got) == 50
    with pytest.raises(Exception, match="not below 500"):
        rows.write.format("packed_ids").option("vocabulary", 500).mode("append").save(f"{path}-too-small")


def test_packed_ids_damage(spark, docs, tmp_path):
    path = f"{tmp_path}/ids"
    packedids.write(docs.limit(30), path)
    file = f"{path}/{packedids.manifest(path)['shards'][0]['file']}"
    data = bytearray(open(file, "rb").read())
    data[10] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        packedids.ids_at(path, 0, 5)
    open(file, "wb").write(data[:-9])
    with pytest.raises(ValueError, match="whole shard"):
        packedids.Shard(file)


def test_packed_ids_empty(spark, empty, tmp_path):
    packedids.write(empty, f"{tmp_path}/none")
    assert packedids.read(spark, f"{tmp_path}/none").count() == 0


def test_op12(spark):
    got = {r["doc_id"]: r for r in registry.op12_binary(spark, DATA).collect()}
    at = 0
    for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect():
        ids = own_ids(r["text"])
        g = got.pop(r["doc_id"])
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    assert not got


# periodic runs


def naive_runs(s, folds, least):
    found = {}
    for q in range(1, len(s) // folds + 1):
        i = q
        while i < len(s):
            j = i
            while j < len(s) and s[j] == s[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, folds * q):
                found.setdefault((i - q, j), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=7), st.integers(1, 9), st.integers(0, 6)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=4), st.sampled_from([(4, 6), (2, 3), (3, 5), (5, 12)]))
def test_runs_against_brute_force(texts, limits):
    said = [[b"%d" % x for w, times, rest in t for x in w * times + w[:rest]] for t in texts]
    assert periodic.runs_of(said, *limits) == [naive_runs(s, *limits) for s in said]
    assert all(periodic.main_lorentz([int(x) for x in s], *limits) == sorted(naive_runs(s, *limits)) for s in said)


def test_runs_of_documents(spark, docs):
    texts = [(20_001, "a " * 5), (20_002, "a " * 6), (20_003, "x a b a b a b a b y"), (20_004, "x a b a b a b a y"), (20_005, "a b a b a b a b " + "c " * 6), (None, "z " * 9), (20_006, "w " * 50_000)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id bigint, text string"))
    got = periodic.find(clashing(rows)).collect()
    have = collections.Counter((r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got)
    want = collections.Counter()
    for i, t in rows.collect():
        ws = words(t)
        runs = naive_runs(ws, 4, 6) if len(ws) < 20_000 else [(0, len(ws), 1 if len(set(ws)) == 1 else 18_000)]  # the long text repeats after 3,000 times six words
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        want[i, tuple(runs), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode()] += 1
    assert have == want
    by = {r["doc_id"]: r for r in got}
    assert by[20_001]["runs"] == [] and by[20_002]["collapsed"] == "a" and by[20_003]["collapsed"] == "x a b y" and by[20_004]["runs"] == [] and by[20_005]["collapsed"] == "a b c"
    assert by[20_006]["collapsed"] == "w"


def test_runs_long_text(spark):
    text = " ".join(f"w{i}" for i in range(30_000)) + " " + " ".join(f"v{i % 7000}" for i in range(30_000))
    r = periodic.find(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()[0]
    assert [tuple(x) for x in r["runs"]] == [(30_000, 30_000, 7000)] and r["collapsed"] == " ".join([f"w{i}" for i in range(30_000)] + [f"v{i}" for i in range(7000)])


def test_runs_edges(spark, empty):
    assert periodic.digest(periodic.find(empty)).count() == 0
    with pytest.raises(ValueError):
        periodic.find(empty, folds=1)
    none = periodic.digest(periodic.find(spark.createDataFrame([(1, None)], "doc_id bigint, text string"), change=periodic.looped)).collect()[0]
    assert none["n_runs"] == 0 and none["start"] is None and none["exponent_milli"] is None and none["runs_sha256"] == none["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()


