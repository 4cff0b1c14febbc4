"""Each operator against a brute-force version, an exact round trip or held-out accuracy, on rows of every awkward kind."""

import collections
import hashlib
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxgrain.llm import graph, langid, license, mixing, neardup, packing, pii, quality, registry, search, substring, toxicity
from fluxgrain.llm.words import words

SPACE = r"[^\x20\x09-\x0D]+"


def collected(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_words():
    for t in ("", " a\x0bb\x0c ", "\x1ca\x85b c ", None):
        assert [w.decode() for w in words(t)] == re.findall(SPACE, t or "")


# licences


def test_license(spark, docs, empty):
    mit = "\n".join(license.SENTENCES[k] + "." for k in ("mit-grant", "mit-notice", "mit-asis"))
    texts = [(1, "x y.\nReleased under the MIT License.\nz"), (2, mit), (3, mit.replace(" to ", "\nto ")), (4, license.SENTENCES["mit-notice"]), (5, "Licensed under CC BY-NC 4.0. Released under the MIT License.")]
    got = {r["doc_id"]: r for r in license.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert [got[i]["license"] for i in range(1, 6)] == ["MIT", "MIT", "MIT", None, "CC-BY-NC-4.0"]
    assert got[5]["licenses"] == "CC-BY-NC-4.0,MIT" and got[4]["n_known"] == 1
    assert license.scan(docs).count() == docs.count() and license.scan(empty).count() == 0
    assert all(re.search(license.KEYWORDS, s) for s, name in license.known().items() if "+" not in name)


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "ISC": """ISC License

Copyright (c) 2020 Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE.
""",
    "GPL-3.0-or-later": """Copyright (C) 2020 Jane Doe

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "GPL-2.0-or-later": """Copyright (C) 2020 Jane Doe

This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "Apache-2.0": """Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "Unlicense": "Notes\nThis is free and unencumbered software released into the public\ndomain.\n",
}


def test_license_wrapped(spark):
    kinds = {"plain": lambda t: t, "crlf": lambda t: t.replace("\n", "\r\n"), "comment": lambda t: "".join(f" * {x}\n" for x in t.splitlines()), "no blank lines": lambda t: re.sub("\n+", "\n", t), "inside": lambda t: "some words\n" + t + "other words\n\n" * 3000}
    rows = [(name, kind, f(t)) for name, t in WRAPPED.items() for kind, f in kinds.items()]
    df = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license.scan(df).collect()}
    assert [(k, got[i]["license"]) for i, (_, k, _) in enumerate(rows)] == [(k, name) for name, k, _ in rows]
    whole = dict(license.heard_sequences()[::-1])  # the first rule of each name
    assert all(got[i]["sentence_ids"].split(",") == whole[name] for i, (name, _, _) in enumerate(rows) if name == "Apache-2.0")


# substring dedup


def brute_repeats(rows, length=50):
    w = [(d, re.findall(SPACE, t or "")) for d, t in rows]
    first = {}
    for d, ws in w:
        for i in range(len(ws) - length + 1):
            k = tuple(ws[i : i + length])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, ws in w:
        gone = set()
        for i in range(len(ws) - length + 1):
            if first[tuple(ws[i : i + length])] < d:
                gone |= set(range(i, i + length))
        kept = [x for i, x in enumerate(ws) if i not in gone]
        out.append((d, len(ws), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_substring(spark, empty):
    rng = np.random.default_rng(1)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    passage, base = fresh(60), fresh(300)
    rows = [(i, " ".join(fresh(30) + passage + fresh(30))) for i in range(20)]
    for i in range(20, 40):  # near copies of near copies
        base = list(base)
        base[int(rng.integers(300))] = f"edit{i}"
        rows.append((i, " ".join(base)))
    rows += [(40, "line one two " * 400), (41, "line one two " * 100), (42, None), (43, ""), (44, " ".join(passage[:49])), (45, " ".join(passage[:50])), (20, rows[20][1]), (None, " ".join(passage))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("sha", F.lit("clash"))
    got = [tuple(r) for r in substring.remove_repeats(df, shard=64, share=3).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute_repeats([r for r in rows if r[0] is not None])
    assert [r[1:3] for r in got if r[0] is None] == [(60, 0)]
    assert substring.remove_repeats(empty).count() == 0
    kept = {r["doc_id"]: r["kept_text"] for r in substring.remove_repeats(df.where("doc_id < 2"), texts=True).collect()}
    assert kept[0] == rows[0][1] and len(kept[1].split()) == 60


def test_suffix_automaton():
    rng = np.random.default_rng(2)
    draw = lambda n: [bytes([97 + x]) for x in rng.integers(0, 3, n)]
    refs, query = [draw(40), draw(30)], draw(60)
    a = substring.SuffixAutomaton()
    for r in refs:
        a.add(r)
    has = {tuple(r[i:j]) for r in refs for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
    want = [max(n for n in range(e + 1) if n == 0 or tuple(query[e - n : e]) in has) for e in range(1, 61)]
    assert a.statistics(query) == want


# packing


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    ids = {d: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4") for d, t in collected(docs)}
    rows = packing.pack(docs).collect()
    of, held, padding, total = collections.Counter(), collections.defaultdict(list), 0, 0
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        of[r["doc_id"]] += r["length"]
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    copies = collections.Counter(d for d, _ in collected(docs))
    assert all(of[d] == n * len(ids[d]) for d, n in copies.items())
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.02 * total
    assert packing.pack(empty).count() == 0


def test_differencing():
    window = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(np.bincount(window, weights=[8, 7, 6, 5, 4])) in ([14, 16], [15, 15])
    sizes = np.random.default_rng(3).integers(1, 512, 900).tolist()
    sums = np.bincount(packing.differencing(sizes, 100), weights=sizes, minlength=100)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() < 0.05 * sums.mean()


def test_plain_texts_encode_alike(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder()
    for t in ("it's  \n\n x'LL 12½", "«é» — ‘q’ €5", *[t for _, t in collected(docs) if t][:40]):
        assert encode(t)[:-1].tolist() == tok.encode(t, add_special_tokens=False).ids


# near duplicates


def test_neardup(spark, docs, empty):
    rng = np.random.default_rng(4)
    base = [f"v{x}" for x in rng.integers(0, 10**6, 200)]
    near = []
    for i in range(30):
        ws = list(base)
        for at in rng.integers(0, 200, int(rng.integers(0, 6))):
            ws[at] = f"e{i}"
        near.append((20_000 + i, " ".join(ws), "en", "s", 1))
    df = docs.unionByName(spark.createDataFrame(near, docs.schema)).withColumn("band", F.lit(1))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    rows = collected(df)
    frequency = np.zeros(1 << neardup.BITS, dtype=np.int64)
    for _, t in rows:
        np.add.at(frequency, (neardup.shingles(words(t))[0] >> np.uint64(64 - neardup.BITS)).astype(np.int64), 1)
    weigh = neardup.Weights(np.log1p(len(rows) / np.maximum(frequency, 1)), 5)
    sets = {d: weigh.of(words(t)) for d, t in rows if words(t)}
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and neardup.jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {d: find(d) for d in root}
    assert neardup.classes(empty).count() == 0
    single = neardup.keep_first(df)
    assert single.columns == df.columns and {r["doc_id"] for r in single.collect()} == {d for d in got if got[d] == d}


def test_neardup_frequencies_are_exact(spark):
    """Texts whose shared shingles would share hashed counters with many other texts are judged by their own frequencies."""
    shared = " ".join(f"s{i}" for i in range(14))
    a, b = f"{shared} x", f"{shared} y"
    counter = lambda h: h >> np.uint64(64 - neardup.BITS)
    both = np.intersect1d(neardup.shingles(words(a))[0], neardup.shingles(words(b))[0])
    tries = [b"w%d" % i for i in range(4_000_000)]
    hits = np.flatnonzero(np.isin(counter(neardup.mix(neardup.word_hashes(tries))), counter(both)))
    texts = [a, b, *(tries[i].decode() for i in hits), None, ""]
    sets = [neardup.shingles(words(t)) for t in texts]
    h, df = np.unique(np.concatenate([s[0] for s in sets]), return_counts=True)
    exact = [(s[0], s[1] * np.log1p(len(texts) / df[np.searchsorted(h, s[0])])) for s in sets]
    table = np.bincount(counter(np.concatenate([s[0] for s in sets])).astype(np.int64), minlength=1 << neardup.BITS)
    rough = neardup.Weights(np.log1p(len(texts) / np.maximum(table, 1)), 5)
    assert neardup.jaccard(exact[0], exact[1]) >= 0.8 > neardup.jaccard(rough.of(words(a)), rough.of(words(b)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for options in ({}, {"share": 40}):
        got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs, **options).collect()}
        assert got == {i: 0 if i == 1 else i for i in range(len(texts))}


def test_sampling_agrees_with_similarity():
    rng = np.random.default_rng(5)
    h = np.sort(rng.integers(1, 1 << 63, 600).astype(np.uint64))
    a, b = (h[:450], np.full(450, 2.0)), (h[150:], rng.uniform(0.5, 3, 450))
    s = neardup.samples(np.r_[a[0], b[0]], np.r_[a[1], b[1]], np.array([0, 450]), 3000)
    assert (s[0] == s[1]).mean() == pytest.approx(neardup.jaccard(a, b), abs=0.04)


def test_spanning_equals_pairs():
    rng = np.random.default_rng(6)
    h = np.sort(rng.integers(1, 1 << 63, 60).astype(np.uint64))
    sets = []
    for _ in range(25):
        own = np.sort(rng.choice(60, 50, replace=False))
        sets.append((h[own], rng.integers(1, 4, 50), (own % 5 + 1.0)))
    links = neardup.spanning(list(range(25)), list(range(25)), sets, 0.7)
    joined = lambda pairs: {frozenset(c) for c in _components(25, pairs)}
    all_pairs = [(i, j) for i in range(25) for j in range(i) if neardup.jaccard((sets[i][0], sets[i][1] * sets[i][2]), (sets[j][0], sets[j][1] * sets[j][2])) >= 0.7]
    assert joined(links) == joined(all_pairs) and len(links) < 25


def _components(n, pairs):
    own = [{i} for i in range(n)]
    for a, b in pairs:
        x, y = next(s for s in own if a in s), next(s for s in own if b in s)
        if x is not y:
            own.remove(y)
            x |= y
    return own


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r["v"]: r["root"] for r in graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# quality rules


def test_quality(docs, empty):
    got = {(r["doc_id"]): r for r in quality.quality(docs.withColumn("g", F.lit("clash"))).collect()}
    for d, t in collected(docs):
        w = re.findall(SPACE, t or "")
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = collections.Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(SPACE, x)]
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    assert quality.quality(docs).count() == docs.count() and quality.quality(empty).count() == 0


def test_quality_rejects_outliers(spark):
    rng = np.random.default_rng(7)
    word = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, int(rng.integers(2, 9))))
    rows = [(i, " ".join(word() for _ in range(120)), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(word() + "$$$" for _ in range(120)), "en", "s") for i in range(30)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(300)) and not any(got[1000 + i] for i in range(30))


# languages


def test_language(spark, docs, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.held_out(4, 2)
    model = langid.learn(d.where(~out))
    r = langid.classify(d, model).join(d.select("doc_id", "lang", out.alias("held")), "doc_id").where("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert r > 0.95
    odd = {x["doc_id"]: x for x in langid.classify(docs, model).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (10_001, 10_002, 10_003))
    assert all(0 <= x["score"] <= 1 for x in odd.values())
    assert langid.learn(empty) == [] and langid.classify(docs, []).where("lang_pred = 'und'").count() == docs.count()


# personal data

BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def brute_pii(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(digits))) % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), [k for k, _ in BASE].index(kind), m.end()))
    return sorted(out)


def test_pii_base_kinds(spark, docs):
    tricky = ["a@b.c@d.e.f x@y @z.w a@@b.c a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111", "+1 (314) 555-4198 +49.30 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "٣@b.c é@b.c.d", "\U0001f600 a@b.cd"]
    rng = np.random.default_rng(8)
    tricky += ["".join(rng.choice(list("a1.@+- ()9"), 60)) for _ in range(400)]
    tricky += [t for _, t in collected(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))]
    for t in tricky:
        assert [x[:3] for x in pii.spans(t) if x[1] < 4] == brute_pii(t)


def test_pii_more(docs, empty):
    kinds = lambda t: [pii.KINDS[k] for _, k, _, _ in pii.spans(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01") == ["iban"]
    assert kinds("call me: phone 030 123 4567") == ["tel"] and kinds("030 123 4567 pieces") == []
    assert pii.redact("a@b.cd x") == "[EMAIL] x" and pii.redact(None) is None
    assert len(pii.spans("x" * 300_000 + "@" + "1" * 300_000)) == 0
    digest = pii.pii_digest(docs)
    assert digest.count() == docs.count() and pii.pii_digest(empty).count() == 0
    assert digest.where("doc_id = 10001").first()["base_sha256"] == hashlib.sha256(b"").hexdigest()
    masked = pii.redact_pii(docs)
    assert masked.columns == docs.columns and masked.where("n_chars <> length(text)").count() == 0
    assert pii.find_pii(docs).selectExpr("sum(size(spans))").first()[0] > 0


# mixing


def test_mixing(spark, docs, empty):
    rows = [(i, "a b c d e f g h", "en", "big" if i % 10 else f"small{i % 3}", 1) for i in range(3000)]
    df = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    got = mixing.plan(df, block=64).groupBy("source").agg(F.sum("n_tokens").alias("t"), F.max("copy").alias("c"), F.max("weight").alias("w"), F.count_distinct("doc_id").alias("n")).collect()
    t = {r["source"]: r["n_tokens"] for r in df.groupBy("source").agg(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \t\n\x0b\f\r]+"), lambda w: w != ""))).alias("n_tokens")).collect()}
    total = sum(r["t"] for r in got)
    for r in got:
        assert t[r["source"]] <= r["t"] <= 2 * t[r["source"]] + 1 and r["c"] <= 3
        assert r["t"] / total == pytest.approx(r["w"], abs=0.02)
    assert mixing.plan(df).select("doc_id").distinct().count() == df.select("doc_id").distinct().count()
    out = mixing.mix(df)
    assert out.columns == df.columns and out.count() == mixing.plan(df).count()
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_exponent(spark):
    p = [0.7, 0.2, 0.05, 0.05]
    x = mixing.exponent(spark.createDataFrame([(v,) for v in p], "p double"), 0.9, 100.0)
    q = np.array(p) ** x
    q /= q.sum()
    assert -(q * np.log(q)).sum() == pytest.approx(0.9 * np.log(4), abs=1e-6)
    x = mixing.exponent(spark.createDataFrame([(v,) for v in p], "p double"), 1.0, 2.0)
    assert (0.7 / 0.05) ** (1 - x) == pytest.approx(2, abs=1e-6)


# toxicity


def test_toxicity(spark, docs, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    d = d.join(labels.select("doc_id"), "doc_id", "left_semi")
    out = langid.held_out(5, 0)
    model = toxicity.fit(d, labels.where(~out))
    r = toxicity.score(d, model).join(labels, "doc_id").where(out).selectExpr("toxic", "score >= 0.5 AS p").toPandas()
    assert r[r.p].toxic.mean() > 0.95 and r[r.toxic == 1].p.mean() > 0.85
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= x["score"] <= 1 for x in odd)
    none = toxicity.fit(empty, labels.limit(0))
    assert toxicity.score(docs, none).where("score > 0.5").count() == 0


def test_machine_learns_pairs():
    """Only both terms together are toxic, and each is as frequent without the other."""
    rng = np.random.default_rng(9)
    texts = [np.unique(np.r_[rng.integers(10, 40, 6), [1] * a, [2] * b]).astype(np.int64) for a, b in [(1, 1), (1, 0), (0, 1), (0, 0)] * 150]
    y = [1, 0, 0, 0] * 150
    m = toxicity.Machine(8, 4).fit(texts, y, epochs=40)
    assert ((m.score(texts) >= 0.5) == np.array(y, dtype=bool)).mean() > 0.98


# search


def test_search(spark):
    rng = np.random.default_rng(10)
    rows = [(int(i), [float(x) for x in np.round(v * 4) / 4]) for i, v in enumerate(rng.normal(size=(700, 6)))]
    rows += [(150, rows[3][1]), (701, None), (702, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (703, [float("nan")] * 6), (704, [float("inf")] * 6), (None, [1.0] * 6), (705, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("block", F.lit(1))
    good = [(i, np.floor(np.array(v) * 256)) for i, v in rows[:701]]
    best = lambda q, v: sorted((-int(v @ w), c) for c, w in good if c != q)[:5]
    want = sorted((q, r, c, -s) for q, v in good if q % 50 == 0 for r, (s, c) in enumerate(best(q, v), 1))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search.top_k(df, F.col("vec_id") % 50 == 0, size=64, chunk=4).collect())
    assert got == want
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search.top_k(df, F.col("vec_id") % 50 == 0, size=64, chunk=4, range_bytes=2 * 64 * 6 * 8).collect())
    assert got == want  # several ranges of two blocks
    few = search.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert len(few) == 2
    assert search.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_search_prunes():
    """Blocks whose vectors are alike are left out; equal scores go to the smaller id, whatever block comes first."""
    rng = np.random.default_rng(3)
    m = np.concatenate([np.floor(256 * (c + 0.05 * rng.normal(size=(100, 8)))) for c in rng.normal(size=(20, 8))]).astype("<i8")
    m[1500:1510] = m[30]
    ids, starts = np.arange(2000), np.arange(0, 2000, 100)
    q_ids = np.arange(0, 2000, 50)
    parts = {"ids": ids, "matrix": m, "highs": np.maximum.reduceat(m, starts), "lows": np.minimum.reduceat(m, starts), "q_ids": q_ids, "q": m[q_ids], "kth": np.full(len(q_ids), search.LOWEST)}
    scored, best = search.searched(SimpleNamespace(**{k: v.astype("<i8").tobytes() for k, v in parts.items()}), 100, 5)
    assert scored.sum() < 0.3 * len(q_ids) * len(starts)
    for i, q in enumerate(q_ids):
        want = sorted((-int(m[q] @ m[c]), c) for c in ids if c != q)[:5]
        assert [(-s, c) for s, c in zip(best.scores[i], best.ids[i])] == want


def test_search_mixed_lengths(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [0.5, 0.5]), (3, [1.0, 1.0, 1.0]), (50, [2.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in search.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (50, 1, 3)]


# pipeline


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    d = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, d, "").write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert sorted(d.columns) == sorted(docs.columns)
    kept = spark.read.parquet(str(tmp_path / "pii"))
    assert 0 < kept.count() < docs.count() and kept.where("text RLIKE '[a-z]@[a-z]+[.]com'").count() == 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_sql(spark):
    import duckdb

    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name, sql in registry.oracle_sql().items():
        got, want = registry.queries()[name](spark, data).toPandas(), con.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        key = lambda df: sorted(str([None if x is None or x != x else x for x in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))
        assert key(got) == key(want)


def test_ids_without_loss(spark):
    """An id beyond 2**53 beside rows without one comes back as it is from every operator."""
    big = 2**53 + 1
    text = "some plain words of a longer text that says token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and no more " * 5
    rows = [(big, text, "en", "s", len(text)), (None, text, "en", "s", len(text)), (None, "²½ Ⅷ 3", None, None, 6), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = [("en", b"some plain words"), ("de", b"einige andere worte")]
    results = {
        "license": license.scan(df),
        "substring": substring.remove_repeats(df),
        "packing": packing.pack(df),
        "neardup": neardup.classes(df),
        "quality": quality.quality(df),
        "language": langid.classify(df, model),
        "pii": pii.pii_digest(df),
        "spans": pii.find_pii(df),
        "mixing": mixing.plan(df),
        "mixed": mixing.mix(df),
        "masked": pii.redact_pii(df),
        "toxicity": toxicity.score(df, toxicity.Machine(8, 2)),
    }
    for name, out in results.items():
        got = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert got == {big, None}, name
    assert neardup.keep_first(df).where("doc_id IS NULL").count() == 3
    assert {r["lang_pred"] for r in langid.classify(df, model).collect()} == {"en", "und"}
    held = packing.pack(df).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    whole = {None: 0, big: 0}
    for d, t, *_ in rows:
        whole[d] += len(packing.encoder()(t or ""))
    assert {r["doc_id"]: r["n"] for r in held} == whole


def test_secrets():
    kinds = lambda t: [pii.KINDS[k] for _, k, _, _ in pii.spans(t)]
    assert kinds('x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y') == ["secret"]
    assert kinds("commit 04dbebab91ab85687d33eeaaf9ac699e1188f962") == [] and kinds('token = "aaaaaaaaaaaaaaaaaaaaaaaa1"') == []


def test_machine_learns_exclusive_pairs():
    """Either term is toxic, both together are not: neither says anything alone."""
    rng = np.random.default_rng(9)
    texts = [np.unique(np.r_[rng.integers(10, 40, 6), [1] * a, [2] * b]).astype(np.int64) for a, b in [(1, 1), (1, 0), (0, 1), (0, 0)] * 150]
    y = [0, 1, 1, 0] * 150
    m = toxicity.Machine(8, 4).fit(texts, y, epochs=60)
    assert ((m.score(texts) >= 0.5) == np.array(y, dtype=bool)).mean() > 0.95


def test_quality_agrees_with_brute_force(spark):
    """kept against a minimum covariance determinant by sorting, from 40 random starts."""
    rng = np.random.default_rng(12)
    word = lambda hi: "".join(chr(97 + x) for x in rng.integers(0, 26, int(rng.integers(2, hi))))
    rows = []
    for i in range(420):
        bad = i % 7 == 0
        mark = "#" * int(rng.integers(0, 3)) if rng.random() < 0.3 else ""
        ws = [word(9) + ("|#" if bad else "") + (mark if k == 0 else "") for k in range(120)]
        ws += ws[:6] if rng.random() < 0.4 else []
        rows.append((i, "\n".join(" ".join(ws[k : k + 12]) for k in range(0, len(ws), 12)), "en", "s"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.quality(df).collect()}
    stats = quality.vector(quality.counts(df)).collect()
    x = np.array([[r[c] for c in quality.X] for r in stats])
    floor = np.array([quality.FLOOR[c] for c in quality.X])

    def model(own, factor):
        m, c = own.mean(0), np.cov(own.T, bias=True) * factor
        low = np.zeros((4, 4))
        for a in range(4):
            for b in range(a + 1):
                rest = c[a, b] - low[a, :b] @ low[b, :b]
                low[a, b] = np.sqrt(max(rest, floor[a] ** 2)) if a == b else rest / low[b, b]
        return m, low

    d2 = lambda m, low: (np.linalg.solve(low, (x - m).T) ** 2).sum(0)
    h, found = int(np.ceil(0.75 * len(x))), []
    for _ in range(40):
        m, low = model(x[rng.choice(len(x), 12, replace=False)], 1.0)
        for _ in range(30):
            m, low = model(x[np.argsort(d2(m, low), kind="stable")[:h]], quality.FACTOR_75)
        found.append((np.log(np.diag(low)).sum(), m, low))
    _, m, low = min(found, key=lambda f: f[0])
    m, low = model(x[d2(m, low) <= quality.QUANTILE_975], quality.FACTOR_975)
    want = dict(zip((r["doc_id"] for r in stats), d2(m, low)))
    for i, w in want.items():
        if not 0.85 < w / quality.CUTOFF < 1.15:
            assert got[i]["kept"] == (w <= quality.CUTOFF), (i, w, got[i]["d2"])
    assert 0 < sum(not r["kept"] for r in got.values()) < 100


def test_groups_join_alike_when_salted(spark):
    from fluxgrain.llm.joins import with_groups

    rows, groups = spark.range(500).selectExpr("id", "id % 7 AS g"), spark.range(7).selectExpr("id AS g", "id * 10 AS x")
    plain = sorted(map(tuple, with_groups(rows, groups, ["g"]).select("id", "x").collect()))
    assert plain == sorted(map(tuple, with_groups(rows, groups, ["g"], small=1).select("id", "x").collect())) == [(i, i % 7 * 10) for i in range(500)]


def test_mixing_realises_permutations(spark):
    """Each pass of a block is whole, in an order of its own, and columns of the plan's own names pass through."""
    rows = [(i, "a b c d", "big" if i % 4 else "small", i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int").withColumn("g", F.lit("clash"))
    plan = mixing.plan(df, block=50).orderBy("source", "block", "copy", "place").collect()
    passes = collections.defaultdict(list)
    for r in plan:
        passes[r["source"], r["block"], r["copy"]].append(r["doc_id"])
    assert all(len(set(p)) == len(p) for p in passes.values()) and [r["place"] for r in plan[:3]] == [1, 2, 3]
    for (s, b, c), p in passes.items():
        if c == 2 and len(p) > 8:
            assert set(p) <= set(passes[s, b, 1]) and p != [d for d in passes[s, b, 1] if d in set(p)]
    got = [r["doc_id"] for r in mixing.mix(df, block=50).collect()]
    assert sorted(got) == sorted(r["doc_id"] for r in plan)
    at = {p[0]: k for k, p in passes.items() if len(p) > 1}
    starts = [i for i, d in enumerate(got) if d in at]
    assert any(got[i : i + len(passes[at[got[i]]])] == passes[at[got[i]]] for i in starts)
    assert mixing.mix(df).columns == df.columns


def test_search_large_integers(spark):
    """Scores beyond 2**53 that floating point would call equal."""
    big = 10**9
    rows = [(0, [big, 1]), (1, [big, 1]), (2, [big, 2]), (3, [1, 1])]
    df = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in search.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(2, big**2 + 2), (1, big**2 + 1), (3, big + 1)]


def test_pipeline_run_agrees_with_plain_stages(spark, docs, tmp_path):
    """run() against a plain chain: the verdicts of the quality rules, all pairs of what they keep, masked texts, and the pieces of each reading rebuilt."""
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = sorted({r["doc_id"] for r in quality.quality(docs).collect() if r["kept"]})
    of = {d: collections.Counter(zip(*[words(texts[d])[k:] for k in range(5)])) for d in good}
    rows = [d for d in (r["doc_id"] for r in docs.collect()) if d in of]
    df = collections.Counter(g for d in rows for g in of[d])
    weigh = lambda c: {g: n * np.log1p(len(rows) / df[g]) for g, n in c.items()}
    sets = {d: weigh(c) for d, c in of.items()}
    root = {d: d for d in good}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(good):
        for b in good[i + 1 :]:
            both = sum(min(w, sets[b][g]) for g, w in sets[a].items() if g in sets[b])
            if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    single = [d for d in good if find(d) == d]
    masked = {d: pii.redact(texts[d]) for d in single}
    mixed = docs.where(F.col("doc_id").isin(single)).dropDuplicates(["doc_id", "text"])
    times = collections.Counter(r["doc_id"] for r in mixing.plan(pii.redact_pii(mixed)).collect())
    held, encode = collections.Counter(), packing.encoder()
    ids = {d: encode(t) for d, t in masked.items()}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        held[r["doc_id"]] += r["length"]
    assert held == {d: times[d] * len(ids[d]) for d in single}


def test_neardup_recall(spark):
    """Of all pairs of similarity 0.8 or more with an id divisible by 20, nine in ten and more share a class."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(d).collect()}
    rows = collected(d)
    sets = [neardup.shingles(words(t)) for _, t in rows]
    h, n = np.unique(np.concatenate([s[0] for s in sets]), return_counts=True)
    weighted = {i: (s[0], s[1] * np.log1p(len(rows) / n[np.searchsorted(h, s[0])])) for (i, _), s in zip(rows, sets) if len(s[0])}
    pairs = [(a, b) for a in weighted if a % 20 == 0 for b in weighted if a != b and neardup.jaccard(weighted[a], weighted[b]) >= 0.8]
    found = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 3 and found >= 0.9 * len(pairs), (found, len(pairs))
