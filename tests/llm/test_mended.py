"""Cases of the operators on personal data, mixing and search that were wrong once."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluxgrain.llm import mixing, pii, search


def kinds(text):
    return [(pii.KINDS[k], text[s:e]) for s, k, e, _ in pii.spans(text)]


def test_ibans():
    def check(country, rest):
        digits = int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97
        return f"{country}{98 - digits:02d}{rest}"

    for country, n in pii.IBAN_LENGTHS.items():
        whole = check(country, "".join("0123456789AB"[i * 7 % 12] for i in range(n - 4)))
        spaced = " ".join(whole[i : i + 4] for i in range(0, n, 4))
        for form in (whole, spaced):
            assert ("iban", form) in kinds(f"x {form} BANK NOTE 12"), form  # a capital word behind it is no part of it
            assert ("iban", form) in kinds(f"({form})")
        assert not any(k == "iban" for k, _ in kinds(f"x {whole}7 y")) and not any(k == "iban" for k, _ in kinds(f"x {whole[:-1]} y"))
        wrong = whole[:2] + f"{(int(whole[2:4]) + 1) % 97 + 2:02d}" + whole[4:]
        assert ("iban", wrong) not in kinds(f"x {wrong} y") or pii.mod97(wrong)
    assert ("iban", "BE68 5390 0754 7034") in kinds("IBAN BE68 5390 0754 7034 BANK")
    assert not any(k == "iban" for k, _ in kinds("iban ZZ68 5390 0754 7034"))  # no such country


@pytest.mark.parametrize("n", [20, 512, 513, 600, 5000])
def test_long_secrets(n):
    secret = ("a1B2c3D4e5F6g7H8" * (n // 16 + 1))[:n]
    assert kinds(f'token = "{secret}"') == [("secret", secret)] and kinds(f"nothing {secret}") == []


def test_mixing_deals_sources(spark):
    """Passes of several sources come among each other, and rows without id and text fall into blocks like all others."""
    rows = [(i, "a b c d", ("x", "y", "z")[i % 3]) for i in range(3000)]
    got = [r["source"] for r in mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), block=50).collect()]
    assert sum(a != b for a, b in zip(got, got[1:])) > 20
    none = spark.createDataFrame([(None, None, "x")] * 5000 + [(1, "a b", "x")], "doc_id bigint, text string, source string")
    plan = mixing.plan(none)
    assert plan.count() == 5001 and plan.groupBy("block", "copy").count().agg(F.max("count")).first()[0] < 800
    places = collections.Counter((r["block"], r["copy"], r["place"]) for r in plan.collect())
    assert max(places.values()) == 1


def test_search_very_large_vectors(spark):
    """One finite vector of 1e16 among others neither ends the search nor changes what others get."""
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=4).tolist() for i in range(120)} | {77: [1e16, -1e16, 5.0, 1.0], 100: [3e15, 1.0, 0.0, -2.0]}
    got = search.top_k(spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0, size=16, chunk=8, range_bytes=2048).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors.items()}
    top = np.iinfo(np.int64).max
    for q in (0, 50, 100):
        scores = sorted(((max(-top, min(top, sum(a * b for a, b in zip(whole[q], v)))), i) for i, v in whole.items() if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert [(r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == scores


def test_language_is_the_smallest_compression(spark, docs):
    """Predictions against plain compression with the same dictionaries, one text at a time."""
    import zstandard

    from fluxgrain.llm import langid

    model = langid.learn(docs)
    got = {(r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in langid.classify(docs, model).collect()}
    want = set()
    for i, t in docs.select("doc_id", "text").collect():
        if t is None or not any(c.isalpha() for c in t):
            want.add((i, "und", 0.0))
            continue
        raw = "".join(c for c in t if not langid.NOISE.match(c)).lower().encode()
        sizes = []
        for k, (name, content) in enumerate(model):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes.append((len(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False).compress(raw)), k, name))
        sizes.sort()
        lead = sizes[1][0] - sizes[0][0]
        want.add((i, sizes[0][2], round(lead / (lead + 8), 9)))
    assert got == want


def test_toxicity_scores_naively():
    """Scores against w0, the weights and all pairs of factors, added up one by one."""
    from fluxgrain.llm import toxicity

    rng = np.random.default_rng(1)
    m = toxicity.Machine(10, 4)
    m.w0, m.w, m.v = -0.3, rng.normal(size=1 << 10).astype(np.float32), rng.normal(0, 0.4, (1 << 10, 4)).astype(np.float32)
    texts = ["", None, "one", "One, two! three four five", "insulting words about a mentioned group of people " * 3]
    ids = [toxicity.terms(t, 10) for t in texts]
    for t, got in zip(ids, m.score(ids)):
        z = m.w0 + sum(float(m.w[i]) for i in t) + sum(float(m.v[a] @ m.v[b]) for n, a in enumerate(t) for b in t[:n])
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-4
