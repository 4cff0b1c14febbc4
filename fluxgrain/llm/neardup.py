"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A text's shingles are its runs of five words (the whole text if it has fewer), each weighted by its count in the text times
log(1 + documents / documents that have it). Texts of equal words are one representative from the start, which counts as often as it has copies.

Document frequencies are exact (of 64-bit hashes): representatives are dealt into blocks, each block sends its
distinct shingles with their counts, in order and cut into ranges of hashes, to one task a range, which adds the counts up and sends the
sums back to the blocks. Blocks and ranges have a fixed mean size, so their number grows with the corpus and a task's memory does not;
there are never more rows than shingles. A shingle that no other text has cannot be in any intersection. So a text with more than
1 - ``like`` of its weight in such shingles has no partner, whatever the other text is; it is a class of its own and gets neither samples nor buckets.

All other texts get ``bands * rows`` samples by improved consistent weighted sampling; two texts agree on a sample with the probability of
their weighted Jaccard similarity. Texts that agree on all samples of a band meet in a bucket. From here on packed shingles travel (those that another
text has too, and the weight of all), never texts. In a bucket every member is compared with the pivot, the member whose shingles are the most frequent on
average (the text that others were made from, if there is one), by the exact weighted Jaccard similarity (sum of lesser weights over sum of greater).
A pair that meets in several buckets is compared once. The pivot then is done; buckets whose other members are one component are done too. The rest is
split into blocks by bytes, and every two blocks, but not two of the pivot's own component, are compared in one task; there a pair is compared in its
first common band only, and not if it is joined already or if its weights alone rule out ``like``. So a bucket of n copies costs n comparisons, and no
link between members of one bucket that would join two classes is passed over; only members that stay unlinked cost more, as the square of
their bytes over the size of a block. Classes are the components of the links; a class is named by its smallest id.

Texts without words are in no bucket: each is a class of its own. So are rows without an id (class null). Rows that repeat an id are one document: they
share a class, even with different texts. An empty table gives no rows. Columns but the id and the text are not read. All tables that later steps build on are written to the shared
folder, so lost executors cost no more than their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.llm.graph import components
from fluxgrain.llm.lineage import kept, stored
from fluxgrain.llm.rows import map_rows
from fluxgrain.llm.words import mix, ngram_hashes, word_hashes, words

GRAM, BANDS, ROWS, LIKE = 5, 16, 4, 0.8
BITS = 20
#: Mean bytes of text whose shingles a block or a range of hashes holds.
SHARE = 6 << 20
#: Bytes of packed shingles in a block of what is left of a bucket.
BLOCK = 6 << 20


def shingles(ws: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a text's words and their counts."""
    h = word_hashes(ws)
    g = ngram_hashes(h, min(gram, len(h))) if len(h) else h
    return np.unique(g, return_counts=True)


def planes(a: np.ndarray) -> bytes:
    """An array's bytes, those of equal place together, which compress better."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def from_planes(b: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(b, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def cut_at(h: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the equal ranges of hashes begins and ends in sorted hashes."""
    bounds = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)
    return np.r_[0, np.searchsorted(h, bounds), len(h)]


def heads(part: pd.DataFrame, gram: int) -> tuple[pd.DataFrame, list[tuple[np.ndarray, np.ndarray]]]:
    """A block's representatives and the shingles of each."""
    own = part[part["copies"] > 0]
    wanted, texts, un = set(own["name"]), {}, zstandard.ZstdDecompressor()
    for name, z in zip(part["name"], part["z"]):
        if z is not None and name in wanted:
            texts[name] = z
    return own, [shingles(un.decompress(texts[x]).split(), gram) for x in own["name"]]


def distinct(own: pd.DataFrame, sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a block's representatives and the number of documents that have each."""
    every = np.concatenate([np.empty(0, dtype=np.uint64), *(s[0] for s in sets)])
    h, at = np.unique(every, return_inverse=True)
    copies = np.repeat(own["copies"].to_numpy(dtype=np.float64), [len(s[0]) for s in sets])
    return h, np.bincount(at, weights=copies, minlength=len(h)).astype(np.uint64)


def frequencies(dealt: DataFrame, ranges: int, gram: int) -> DataFrame:
    """(block, r, counts): for each block of dealt and range r the document frequencies of the block's shingles in that range, in their order."""

    def send(part: pd.DataFrame) -> pd.DataFrame:
        h, n = distinct(*heads(part, gram))
        at = cut_at(h, ranges)
        out = [(part["block"].iloc[0], r, planes(np.diff(h[x:y], prepend=np.uint64(0))), planes(n[x:y])) for r, (x, y) in enumerate(zip(at[:-1], at[1:])) if x < y]
        return pd.DataFrame(out, columns=["block", "r", "hashes", "counts"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        sent = [np.cumsum(from_planes(b, np.uint64), dtype=np.uint64) for b in part["hashes"]]
        _, at = np.unique(np.concatenate(sent), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([from_planes(b, np.uint64) for b in part["counts"]])).astype(np.uint64)
        ends = np.cumsum([len(x) for x in sent])
        return pd.DataFrame({"block": part["block"], "r": part["r"], "counts": [planes(total[at[y - len(x) : y]]) for x, y in zip(sent, ends)]})

    return dealt.groupBy("block").applyInPandas(send, "block bigint, r bigint, hashes binary, counts binary").groupBy("r").applyInPandas(add, "block bigint, r bigint, counts binary")


@lru_cache(maxsize=1)
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tables of 2**16 gamma(2, 1) and uniform draws that a shingle's hash picks from: r, 1 / r, log c, beta."""
    rng = np.random.default_rng(20)
    r, c, beta = rng.gamma(2, 1, 1 << 16), rng.gamma(2, 1, 1 << 16), rng.random(1 << 16)
    return r.astype(np.float32), (1 / r).astype(np.float32), np.log(c).astype(np.float32), beta.astype(np.float32)


def samples(h: np.ndarray, w: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
    """One hash for each text (shingles h with weights w, texts begin at starts) and sample: equal where shingle and level are.

    Each sample reads r, c and beta from other tables entries: the hash is multiplied anew and three fields of it are used.
    """
    r_, inv_, lc_, beta_ = draws()
    logw = np.log(w).astype(np.float32)
    lens = np.diff(np.r_[starts, len(h)])
    out = np.empty((len(starts), number), dtype=np.uint64)
    rng = np.random.default_rng(21)
    for k in range(number):
        x = h * (rng.integers(1 << 62, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        x ^= x >> np.uint64(29)
        i = (x & np.uint64(0xFFFF)).astype(np.intp)
        j = ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.intp)
        beta = beta_[(x >> np.uint64(40)).astype(np.intp) & 0xFFFF]
        t = np.floor(logw * inv_[i] + beta)
        value = lc_[j] - r_[i] * (t - beta + 1)
        least = np.minimum.reduceat(value, starts)
        at = np.flatnonzero(value == np.repeat(least, lens))
        text = np.searchsorted(starts, at, side="right") - 1
        first = at[np.unique(text, return_index=True)[1]]  # ties: the smallest hash, as shingles are sorted
        out[:, k] = mix(h[first] ^ (t[first].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out


def banded(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A bucket key for each text and band; keys of different bands differ."""
    out = np.empty((len(s), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(s), np.uint64(b + 1))
        for x in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, b * rows + x])
        out[:, b] = key
    return out.view(np.int64)


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets (sorted hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    return both / (float(a[1].sum()) + float(b[1].sum()) - both)


class Weights:
    """Weighted shingles of texts under a table of inverse document frequencies by a hash's first bits: an approximation for comparison, not used by classes()."""

    def __init__(self, idf: np.ndarray, gram: int):
        self.idf, self.gram = idf, gram

    def of(self, ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        h, n = shingles(ws, self.gram)
        return h, n * self.idf[(h >> np.uint64(64 - BITS)).astype(np.intp)]


def pack(h: np.ndarray, n: np.ndarray, df: np.ndarray) -> bytes:
    """A text's sorted shingles, their counts in the text and their document frequencies."""
    return zstandard.compress(planes(np.diff(h, prepend=np.uint64(0))) + planes(n.astype(np.uint32)) + planes(df.astype(np.uint64)), 1)


def unpack(z: bytes, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, counts and inverse document frequencies."""
    raw = zstandard.decompress(z)
    k = len(raw) // 20
    return np.cumsum(from_planes(raw[: 8 * k], np.uint64), dtype=np.uint64), from_planes(raw[8 * k : 12 * k], np.uint32).astype(np.int64), idf(from_planes(raw[12 * k :], np.uint64), total)


def idf(df: np.ndarray, total: int) -> np.ndarray:
    return np.log1p(total / df)


def named_by(ws: list[bytes]) -> bytes | None:
    """Equal for texts of equal words."""
    return xxhash.xxh3_128_digest(b" ".join(ws)) if ws else None


def spanning(ids: list[int], labels: list[int], sets: list[tuple], like: float, weights: np.ndarray | None = None, halves: np.ndarray | None = None, bands: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (a, b) that join whatever links of similarity ``like`` or more join, given that equal labels are joined already.

    sets: shingles, counts, inverse document frequencies; weights: the weight of each whole set, if more than that of its shingles here. With halves only
    pairs of different halves are compared; with bands (their earlier bands' keys) only pairs that have none of these in common. One text after
    the other is the pivot: its weights lie in a table by shingle, and the lesser weights of all texts that may be linked to it are summed at once.
    """
    if len(set(labels)) < 2:
        return []
    lens = np.array([len(s[0]) for s in sets])
    starts = np.cumsum(lens) - lens
    _, column = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True)
    weight = np.concatenate([s[1] * s[2] for s in sets])
    common = np.bincount(np.repeat(np.arange(len(sets)), lens), weights=weight, minlength=len(sets))
    whole = common if weights is None else np.asarray(weights, dtype=np.float64)
    table = np.zeros(int(column.max(initial=-1)) + 1)
    root = np.unique(np.asarray(labels), return_inverse=True)[1]
    out = []
    for i in range(len(sets) - 1):
        able = np.minimum(common[i], common[i + 1 :]) * (1 + like) >= (whole[i] + whole[i + 1 :]) * like * (1 - 1e-9)
        able &= (root[i + 1 :] != root[i]) & (lens[i + 1 :] > 0)
        if halves is not None:
            able &= halves[i + 1 :] != halves[i]
        if bands is not None and bands.shape[1]:
            able &= ~(bands[i + 1 :] == bands[i]).any(axis=1)
        others = i + 1 + np.flatnonzero(able)
        if not len(others):
            continue
        own = slice(starts[i], starts[i] + lens[i])
        table[column[own]] = weight[own]
        ends = np.cumsum(lens[others])
        at = np.arange(ends[-1]) + np.repeat(starts[others] - (ends - lens[others]), lens[others])
        both = np.add.reduceat(np.minimum(table[column[at]], weight[at]), ends - lens[others])
        table[column[own]] = 0
        for j in others[both >= (like - 1e-12) * (whole[i] + whole[others] - both)].tolist():
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                out.append((ids[i], ids[j]))
    return out


def classes(docs: DataFrame, gram: int = GRAM, bands: int = BANDS, rows: int = ROWS, like: float = LIKE, share: int = SHARE, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id) of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def names(ids: list, texts: list) -> dict:
        found = [words(t) for t in texts]
        return {"doc_id": ids, "name": [named_by(w) for w in found], "size": [sum(map(len, w)) + len(w) for w in found]}

    named = stored(map_rows(docs, names, "doc_id bigint, name binary, size bigint"))
    total = named.count()
    texts = stored(named.where("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies"), F.max("size").alias("size")))
    pieces = texts.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // share + 1

    def whole(batches: Iterator[tuple[list, list]]) -> Iterator[dict]:
        """The words of texts; of those without an id, which may be many copies, each text once a task."""
        said, z = set(), zstandard.ZstdCompressor(level=1)
        for ids, some in batches:
            out = {"doc_id": [], "name": [], "z": []}
            for d, t in zip(ids, some):
                name = named_by(w := words(t))
                if name is None or d is None and name in said:
                    continue
                if d is None:
                    said.add(name)
                for k, v in zip(out, (d, name, z.compress(b" ".join(w)))):
                    out[k].append(v)
            yield out

    sent = map_rows(docs, whole, "doc_id bigint, name binary, z binary", streamed=True).withColumn("copies", F.lit(0).cast("bigint"))
    marks = texts.select(F.col("head").alias("doc_id"), "name", F.lit(None).cast("binary").alias("z"), "copies")
    place = F.coalesce("doc_id", F.xxhash64("name"))
    dealt = sent.unionByName(marks).select(F.pmod(F.xxhash64(place), F.lit(pieces)).alias("block"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNotNull().alias("has_id"), "name", "copies", "z")

    def signatures(part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own, sets = heads(part, gram)
        h, _ = distinct(own, sets)
        df = np.concatenate([np.empty(0, dtype=np.uint64), *(from_planes(b, np.uint64) for b in found.sort_values("r")["counts"])])
        if len(df) != len(h):
            raise RuntimeError(f"a block has {len(h)} distinct shingles and frequencies of {len(df)}: its input differed between two readings")
        full = []
        for d, has_id, copies, (x, n) in zip(own["d"], own["has_id"], own["copies"], sets):
            f = df[np.searchsorted(h, x)]
            w = n * idf(f, total)
            shared = f > copies
            if has_id and w[shared].sum() >= like * w.sum() * (1 - 1e-9):
                full.append((d, float(w.sum() / n.sum()), float(w.sum()), x, w, pack(x[shared], n[shared], f[shared])))
        keys = []
        for at in range(0, len(full), 256):
            now = full[at : at + 256]
            lens = np.array([len(r[3]) for r in now])
            s = samples(np.concatenate([r[3] for r in now]), np.concatenate([r[4] for r in now]), np.cumsum(lens) - lens, bands * rows)
            keys += list(banded(s, bands, rows))
        return pd.DataFrame({"d": [r[0] for r in full], "rank": [r[1] for r in full], "weight": [r[2] for r in full], "bands": pd.Series(keys, dtype=object), "z": pd.Series([r[5] for r in full], dtype=object)})

    # both sides read one exchange of dealt
    replies = frequencies(dealt, pieces, gram)
    signed = stored(dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(signatures, "d bigint, rank double, weight double, bands array<bigint>, z binary"))

    # buckets of more than one, each with its pivot
    members = signed.select(F.explode("bands").alias("band"), "d", "rank", F.octet_length("z").alias("size")).dropDuplicates(["band", "d"])
    many = members.groupBy("band").agg(F.count("*").alias("n"), F.min(F.struct("rank", "d")).getField("d").alias("p")).where("n > 1")
    state = stored(members.join(many, "band").select("band", "d", "p", "n", "size"))
    pairs = state.where("d <> p").select("p", "d").distinct()
    asked = pairs.join(signed.select("d", "weight", "z"), "d").join(signed.select(F.col("d").alias("p"), F.col("weight").alias("p_weight"), F.col("z").alias("p_z")), "p")

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, pivot = None, None
        for b in batches:
            like_ones = []
            for r in b.itertuples(index=False):
                if last != (r.p, r.p_z):
                    last, (h, n, x) = (r.p, r.p_z), unpack(r.p_z, total)
                    pivot = h, n * x
                h, n, x = unpack(r.z, total)
                _, i, j = np.intersect1d(pivot[0], h, assume_unique=True, return_indices=True)
                both = float(np.minimum(pivot[1][i], (n * x)[j]).sum())
                like_ones.append(both >= (like - 1e-12) * (r.weight + r.p_weight - both))
            yield b.loc[like_ones, ["p", "d"]].rename(columns={"p": "a", "d": "b"})

    # rows of one id are one document, whatever their texts
    heads_of = named.join(texts.select("name", "head"), "name", "left").select("doc_id", F.coalesce("head", "doc_id").alias("head")).where("doc_id IS NOT NULL")
    repeated = heads_of.groupBy("doc_id").agg(F.min("head").alias("a"), F.max("head").alias("b"), F.collect_set("head").alias("all")).where("a < b").select(F.col("doc_id").alias("a"), F.explode("all").alias("b"))
    links = stored(asked.mapInPandas(verified, "a bigint, b bigint").unionByName(repeated))
    roots = components(links)

    # what is left of buckets: members that are not the pivot's component, with one another and with those that are
    label = lambda x: roots.select(F.col("v").alias(x), F.col("root").alias(f"c_{x}"))
    now = state.where("n > 2 AND d <> p").join(label("d"), "d", "left").join(label("p"), "p", "left")
    now = now.select("band", "d", "size", F.coalesce("c_d", "d").alias("c"), (F.coalesce("c_d", "d") != F.coalesce("c_p", "p")).cast("int").alias("out"))
    blocks = lambda side: F.ceil(F.sum(F.when(F.col("out") == side, F.col("size")).otherwise(0)) / F.lit(float(block)))
    sizes = now.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high"), blocks(1).alias("outs"), blocks(0).alias("ins")).where("low < high")
    dealt_rest = stored(now.join(sizes.select("band", "outs", "ins"), "band"))
    drawn = F.xxhash64("d")
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    outer, inner = dealt_rest.where("out = 1").withColumn("own", F.pmod(drawn, "outs")), dealt_rest.where("out = 0").withColumn("own", F.pmod(drawn, "ins"))
    among = outer.withColumn("other", F.explode(upto("outs"))).select("band", "d", "c", F.lit(0).alias("kind"), F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own")
    across = outer.where("ins > 0").withColumn("y", F.explode(upto("ins"))).select("band", "d", "c", F.lit(1).alias("kind"), F.col("own").alias("x"), "y", F.lit(-1).cast("bigint").alias("own"))
    against = inner.withColumn("x", F.explode(upto("outs"))).select("band", "d", "c", F.lit(1).alias("kind"), "x", F.col("own").alias("y"), F.lit(-2).cast("bigint").alias("own"))
    rest = among.unionByName(across).unionByName(against).join(signed.select("d", "rank", "weight", "bands", "z"), "d")

    def linked(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["rank", "d"])
        first = part.iloc[0]
        keys = np.stack(part["bands"].to_list())
        column = int(np.flatnonzero(keys[0] == first["band"])[0])
        halves = part["own"].to_numpy() if first["kind"] or first["x"] != first["y"] else None
        got = spanning(part["d"].tolist(), part["c"].tolist(), [unpack(z, total) for z in part["z"]], like, part["weight"].to_numpy(), halves, keys[:, :column])
        return pd.DataFrame(got, columns=["a", "b"])

    more = stored(rest.groupBy("band", "kind", "x", "y").applyInPandas(linked, "a bigint, b bigint"))
    if not more.isEmpty():
        roots = components(roots.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(more))
    owned = named.where("doc_id IS NOT NULL").join(texts.select("name", "head"), "name", "left").select("doc_id", F.coalesce("head", "doc_id").alias("head"))
    known = owned.join(roots, F.col("head") == F.col("v"), "left").select("doc_id", F.coalesce("root", "head").alias("class_id"))
    return known.unionByName(named.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("bigint").alias("class_id")))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stand for their class (those whose id names it), equal rows once; rows without an id stay."""
    first = classes(docs, **options).where("doc_id = class_id").select(F.col("doc_id").alias("first_id")).distinct()
    stay = docs.join(first, docs["doc_id"] == first["first_id"], "left_semi")
    return stay.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
