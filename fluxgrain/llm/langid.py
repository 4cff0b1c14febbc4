"""Language of a text by compression: the language whose dictionary makes the text smallest.

For each language a raw-content zstandard dictionary is made of labelled texts: a bounded sample of whole texts, at most ``docs_per_language``
of a language (those with the smallest hash of their id). Every whole text is
then compressed once with each dictionary; the smallest result names the language. The score is d / (d + 8) for a lead of d
bytes over the second; a lead below ``narrow`` bytes is marked ``rejected`` (the best guess is given all the same).

Texts that are null or have no letter get ``und`` and score 0. Ties go to the language with more labelled documents,
then to the smaller name. Repeated rows and rows without an id are judged each for itself; an empty table gives no rows. Without labelled texts every result is ``und``. The
sample's size is the only thing that reaches the driver, with one row per language; columns but the id, the text and (for
learning) the language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import regex as re
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.llm.rows import map_rows

LETTER = re.compile(r"\p{L}")
#: Characters that say little of a language.
NOISE = re.compile(r"[^\w\s]|[\d_]")


def plain(text: str) -> str:
    return NOISE.sub("", text).lower()


def learn(docs: DataFrame, docs_per_language: int = 128, known: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary content), most labelled first. Texts without letters teach nothing."""
    labelled = docs.where(F.col(known).isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in labelled.groupBy(known).count().collect()}
    if not counts:
        return []
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2.0 * docs_per_language / n))])[F.col(known)]
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = labelled.where(drawn < rate * (1 << 30)).select(F.col(known).alias("lang"), drawn.alias("d"), "doc_id", "text")
    some = some.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("d", "doc_id", "text"))).where(F.col("n") <= docs_per_language)
    texts: dict[str, list] = {}
    for r in some.orderBy("lang", "n").collect():
        texts.setdefault(r["lang"], []).append(plain(r["text"]))
    return [(k, "\n".join(texts[k]).encode()) for k in sorted(texts, key=lambda k: (-counts[k], k))]


def classify(docs: DataFrame, model: list[tuple[str, bytes]], level: int = 3, narrow: int = 4) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row of docs (doc_id, text)."""

    def run(batches: Iterator[tuple[list, list]]) -> Iterator[dict]:
        coders = []
        for name, content in model:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            coders.append((name, zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False)))
        for ids, texts in batches:
            out = []
            for text in texts:
                if text is None or not coders or not LETTER.search(text):
                    out.append(("und", 0.0, True))
                    continue
                raw = plain(text).encode("utf-8", "replace")
                sizes = sorted((len(c.compress(raw)), i) for i, (_, c) in enumerate(coders))
                lead = sizes[1][0] - sizes[0][0] if len(sizes) > 1 else len(raw)
                out.append((coders[sizes[0][1]][0], lead / (lead + 8), lead < narrow))
            yield {"doc_id": ids, **{k: [x[i] for x in out] for i, k in enumerate(("lang_pred", "score", "rejected"))}}

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, lang_pred string, score double, rejected boolean", streamed=True)


def held_out(parts: int, part: int):
    """Whether crc32 of the id's text falls into the part that is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))
