"""Removal of long passages that an earlier document has, by suffix automata of reference shards.

A window is ``length`` consecutive words of one document. Words covered by a window whose words also stand in a document
with a smaller id are removed; windows are judged on the input.

How the work is dealt out. Anchors are a candidate filter before the automata, one that loses nothing (tested against a full scan). Each window has an anchor: the smallest hash of the ``gram``-word runs in it, which depends on the
window's words alone, so that equal windows have equal anchors. Only anchors found in two documents or more matter. An
anchor's home is the smallest document that has it. The windows of a home's anchors are its reference shard (of at most
about ``shard`` words, long documents have several); every other document sends the windows of those anchors to that shard.
There a suffix automaton of the reference passages is built and the other documents' passages are streamed through it: the matching
statistic at a word is the length of the longest run ending there that the reference has, and where it reaches ``length``
the words of the window go. A shard that many documents ask for is sent to several tasks, each with a share of the documents.

A window that its home lacks may still stand in another document that is no home (near copies of near copies). Such windows go
through the same once more with the window's own hash as the anchor, after which nothing is left over. So any number of
documents may share a passage, and no task holds more than one reference shard and one batch of passages.

Null and empty texts have no words. Rows without an id neither lose words nor take them from others. Rows that repeat an id
never take words from one another; each gets a result of its own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.llm.lineage import kept
from fluxgrain.llm.rows import map_rows
from fluxgrain.llm.words import ngram_hashes, word_hashes, words

LENGTH, GRAM, SHARD, SHARE = 50, 10, 16_384, 400


class SuffixAutomaton:
    """Suffix automaton of passages of words; matches never run over the end of a passage."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.last, self.passages = [-1], [0], 0, 0

    def add(self, passage: list[bytes]) -> None:
        for w in passage:
            self.extend(w)
        self.passages += 1
        self.extend(self.passages)  # a number equals no word

    def extend(self, w) -> None:
        nxt, link, length = self.next, self.link, self.length
        cur, p = len(nxt), self.last
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur

    def statistics(self, passage: list[bytes]) -> list[int]:
        """For each word the length of the longest run ending there that a reference passage has."""
        nxt, link, length = self.next, self.link, self.length
        v = n = 0
        out = []
        for w in passage:
            to = nxt[v].get(w)
            while to is None and v:
                v = link[v]
                n = length[v]
                to = nxt[v].get(w)
            if to is not None:
                v, n = to, n + 1
            out.append(n)
        return out


def digest(ws: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(ws)).hexdigest()


def anchors(h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hash (as int64) and its place for each window, given a text's word hashes."""
    if len(h) < length:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    g = ngram_hashes(h, gram)
    n = length - gram + 1
    at = np.lib.stride_tricks.sliding_window_view(g, n).argmin(axis=1) + np.arange(len(g) - n + 1)
    return g[at].view(np.int64), at


def runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (first, last) of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist()))


def homes(places: DataFrame) -> DataFrame:
    """(a, doc_id, s) -> doc_id with l: its anchors that other documents have too, each with home, the home's shard and the number of documents."""
    known = places.groupBy("a").agg(F.min(F.struct("doc_id", "s")).alias("home"), F.max("doc_id").alias("top"), F.count("*").alias("n"))
    known = kept(known.where(F.col("home.doc_id") < F.col("top")).select("a", F.col("home.doc_id").alias("home"), F.col("home.s").alias("s"), "n"))
    each = places.select("a", "doc_id").join(known, "a").groupBy("doc_id").agg(F.collect_list(F.struct("a", "home", "s", "n")).alias("l"))
    return each.select("doc_id", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("a", "home", "s", "n")])


PASSAGE = "home bigint, s int, share int, asks boolean, doc_id bigint, sha string, start bigint, words binary"


def passages(texts: DataFrame, length: int, gram: int, share: int) -> DataFrame:
    """Reference passages (asks false) of homes and passages of the documents that ask them, from texts with homes()'s lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ws = words(r.text)
                h = word_hashes(ws)
                a, _ = anchors(h, length, gram)
                if not len(a):
                    continue
                sha = digest(ws)
                order = np.argsort(r.l_a)
                keys = np.asarray(r.l_a)[order]
                i = np.minimum(np.searchsorted(keys, a), len(keys) - 1)
                at = np.flatnonzero(keys[i] == a)
                which = order[i[at]]
                home, shard, n = np.asarray(r.l_home)[which], np.asarray(r.l_s)[which], np.asarray(r.l_n)[which]
                group, back = np.unique(np.stack([home, shard.astype(np.int64)]), axis=1, return_inverse=True)
                back = back.ravel()
                for k in range(group.shape[1]):
                    starts, shares = at[back == k], int(-(-n[back == k].max() // share))
                    hm, sd = int(group[0, k]), int(group[1, k])
                    asks = hm != r.doc_id
                    if not asks:  # equal windows are wanted once
                        full = ngram_hashes(h, length)[starts]
                        starts = starts[np.sort(np.unique(full, return_index=True)[1])]
                    for first, last in runs(starts):
                        part = b" ".join(ws[first : last + length])
                        for x in [r.doc_id % shares] if asks else range(shares):
                            out.append((hm, sd, x, asks, r.doc_id, sha, first, part))
                if len(out) > 2000:
                    yield pd.DataFrame(out, columns=[x.split()[0] for x in PASSAGE.split(", ")])
                    out = []
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PASSAGE.split(", ")])

    return texts.select("doc_id", "text", "l_a", "l_home", "l_s", "l_n").mapInPandas(run, PASSAGE)


FOUND = "doc_id bigint, sha string, first array<bigint>, last array<bigint>, left array<bigint>"


def streamed(parts: DataFrame, length: int) -> DataFrame:
    """Each asking passage streamed through its reference shard's automaton: runs of windows found there, hashes of those left over."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, automaton = None, SuffixAutomaton()
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ws = r.words.split()
                if key != (r.home, r.s, r.share):
                    key, automaton = (r.home, r.s, r.share), SuffixAutomaton()
                if not r.asks:
                    automaton.add(ws)
                    continue
                hit = np.array(automaton.statistics(ws)[length - 1 :]) >= length
                found = [(f + r.start, e + r.start) for f, e in runs(np.flatnonzero(hit))] if hit.any() else []
                left = np.empty(0, dtype=np.int64) if hit.all() else np.unique(ngram_hashes(word_hashes(ws), length)[~hit]).view(np.int64)
                out.append((r.doc_id, r.sha, [f for f, _ in found], [e for _, e in found], left))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in FOUND.split(", ")])

    return parts.repartition("home", "s", "share").sortWithinPartitions("home", "s", "share", "asks").mapInPandas(run, FOUND)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, share: int = SHARE, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text, words joined by a space, if texts) of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def read(ids: list, some: list) -> dict:
        out = {"doc_id": ids, "sha": [], "n_words": [], "a": [], "s": []}
        for t in some:
            ws = words(t)
            a, at = anchors(word_hashes(ws), length, gram)
            own, first = np.unique(a, return_index=True)
            for k, v in (("sha", digest(ws)), ("n_words", len(ws)), ("a", own), ("s", at[first] // shard)):
                out[k].append(v)
        return out

    read_all = kept(map_rows(docs, read, "doc_id bigint, sha string, n_words bigint, a array<bigint>, s array<int>"))
    places = read_all.where("doc_id IS NOT NULL").select("doc_id", F.explode(F.arrays_zip("a", "s")).alias("x")).select("x.a", "doc_id", "x.s")
    asked = kept(docs.join(homes(places), "doc_id"))
    one = kept(streamed(passages(asked, length, gram, share), length))
    left = one.select("doc_id", F.explode("left").alias("a")).distinct().withColumn("s", F.lit(0))
    again = asked.select("doc_id", "text").join(homes(left), "doc_id")
    two = streamed(passages(again, length, length, share), length)
    found = one.select("doc_id", "sha", "first", "last").unionByName(two.select("doc_id", "sha", "first", "last")).where(F.size("first") > 0)
    found = found.groupBy("doc_id").agg(F.collect_list(F.struct("sha", "first", "last")).alias("l"))
    found = found.select("doc_id", *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("sha", "first", "last")])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ws = words(r.text)
                sha, step = digest(ws), np.zeros(len(ws) + 1, dtype=np.int64)
                for own, first, last in zip(r.l_sha, r.l_first, r.l_last):
                    if own == sha:
                        np.add.at(step, np.asarray(first, dtype=np.int64), 1)
                        np.add.at(step, np.asarray(last, dtype=np.int64) + length, -1)
                stay = [w for w, k in zip(ws, np.cumsum(step[:-1]).tolist()) if k == 0]
                out.append((r.doc_id, sha, len(ws) - len(stay), digest(stay), b" ".join(stay).decode() if texts else None))
            yield pd.DataFrame(out, columns=["doc_id", "sha", "n_removed", "kept_sha256", "kept_text"])

    less = asked.select("doc_id", "text").join(found, "doc_id").mapInPandas(cut, "doc_id bigint, sha string, n_removed bigint, kept_sha256 string, kept_text string").dropDuplicates(["doc_id", "sha"])
    out = read_all.select("doc_id", "sha", "n_words").join(less, ["doc_id", "sha"], "left")
    out = out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept_text")
    if texts:
        # of rows without removals the words are those of the text, joined anew
        whole = docs.withColumn("sha", F.sha2(F.array_join(F.filter(F.split("text", "[ \t\n\x0b\f\r]+"), lambda w: w != ""), " "), 256)).dropDuplicates(["doc_id", "sha"])
        out = out.join(whole.select("doc_id", F.col("sha").alias("kept_sha256"), "text"), ["doc_id", "kept_sha256"], "left")
        return out.withColumn("kept_text", F.coalesce("kept_text", F.array_join(F.filter(F.split("text", "[ \t\n\x0b\f\r]+"), lambda w: w != ""), " "))).drop("text")
    return out.drop("kept_text")
