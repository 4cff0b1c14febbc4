"""Quality rules: fixed rules on counts, and robust outliers by minimum covariance determinant.

Counts are taken over whole texts with built-in functions only, row by row. A document that passes the fixed rules is judged by
its vector of transformed statistics (log of mean word length; square roots of symbols, repeated lines and repeated words
a word or line) within its language and source: location and scatter are those of the
``coverage`` share of the group that has the smallest determinant, then reweighted once. It is found by concentration steps from several
deterministic starts (medians with, for the scatter, absolute deviations alone, the correlation of the signs of the centred vectors, and that of their
hyperbolic tangents); steps go on until no determinant falls by more than a thousandth, and of the starts the one with the smallest determinant is taken. A squared Mahalanobis distance above ``cutoff`` rejects.

The h-subset of a step is cut at an edge of a fixed grid of distances, so that a group of any size is never gathered: each
step is two grouped aggregations with partial sums, and models, one row per group and start, are counted and then broadcast. Sums are of decimals, medians are
exact ones of rounded values: no result depends on how rows were partitioned. A scatter needs rows to be estimated from, so groups below ``least`` rows
are pooled by language, and pools still below it all together. Each deviation has a floor, so that constant statistics (no symbols anywhere) reject nobody
who is close to them. Null texts have no words and fail the fixed rules; null languages and sources are groups of their own;
repeated rows and rows without an id count each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxgrain.llm.joins import with_groups
from fluxgrain.llm.lineage import kept

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: The statistics and the least standard deviation each is granted.
FLOOR = {"x1": 0.05, "x2": 0.05, "x3": 0.2, "x4": 0.15}
X = tuple(FLOOR)
COVERAGE = 0.75
#: Fixed values of the chi-squared distribution with 4 degrees of freedom: consistency factors of the scatter of the inner
#: 75 and 97.5 per cent, the 97.5 per cent quantile, and the point exceeded by one in a million.
FACTOR_75, FACTOR_975, QUANTILE_975, CUTOFF = 1.4866, 1.0645, 11.143, 33.4


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns in keep, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    t = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", *keep, t.alias("t"), F.filter(F.split(t, f"[{SPACE}]+"), lambda w: w != "").alias("w"), F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"))
    length = lambda c: F.length(c).cast("bigint")
    n = F.size("w").cast("bigint")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("p"))))
    out = out.select(
        "doc_id",
        *keep,
        n.alias("n_words"),
        length(F.translate("t", SPACE, "")).alias("word_chars"),
        (length(F.col("t")) - length(F.translate("t", SYMBOLS, ""))).alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(windows).alias("s"),
    )
    # equal windows are neighbours once sorted; then each window found twice or more covers three words, less what the one before covers
    again = F.filter("s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"]))
    covered = F.aggregate(
        F.sort_array(F.transform(again, lambda x: x["p"])),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("s")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def vector(stats: DataFrame) -> DataFrame:
    per = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    mean = F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1)))
    return stats.withColumns({"x1": mean, "x2": per("n_symbols", "n_words"), "x3": per("n_dup_lines", "n_lines"), "x4": per("n_repeat_words", "n_words")})


PAIRS = [(a, b) for i, a in enumerate(X) for b in X[: i + 1]]
STARTS = (0, 1, 2)


def mean(c: Column) -> Column:
    """A mean that does not depend on the order of rows."""
    return F.sum(F.round(c, 9).cast("decimal(28,9)")).cast("double") / F.count("*")


def factored(scatter: DataFrame, keys: list[str], factor: float = 1.0) -> DataFrame:
    """Location m_i, Cholesky factor l_i_j and log determinant of scatters c_i_j."""
    out = scatter
    for i, a in enumerate(X):
        for j, b in enumerate(X[: i + 1]):
            rest = reduce(lambda s, k: s - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}"), X[:j], F.col(f"c_{a}_{b}") * factor)
            out = out.withColumn(f"l_{a}_{b}", F.sqrt(F.greatest(rest, F.lit(FLOOR[a] ** 2))) if a == b else rest / F.col(f"l_{b}_{b}"))
    det = reduce(lambda s, a: s + 2 * F.log(f"l_{a}_{a}"), X, F.lit(0.0))
    return kept(out.select(*keys, *[f"m_{a}" for a in X], *[f"l_{a}_{b}" for a, b in PAIRS], det.alias("det")))


def fitted(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """The model of each group's (and start's) rows."""
    out = rows.groupBy(*keys).agg(*[mean(F.col(a)).alias(f"m_{a}") for a in X], *[mean(F.col(a) * F.col(b)).alias(f"s_{a}_{b}") for a, b in PAIRS])
    return factored(out.withColumns({f"c_{a}_{b}": F.col(f"s_{a}_{b}") - F.col(f"m_{a}") * F.col(f"m_{b}") for a, b in PAIRS}), keys, factor)


def distance(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """rows with d2, the squared Mahalanobis distance in their model (by forward substitution)."""
    out = with_groups(rows, model, keys, how="left")
    for i, a in enumerate(X):
        rest = reduce(lambda s, b: s - F.col(f"l_{a}_{b}") * F.col(f"y_{b}"), X[:i], F.col(a) - F.col(f"m_{a}"))
        out = out.withColumn(f"y_{a}", rest / F.col(f"l_{a}_{a}"))
    return out.select(*rows.columns, reduce(lambda s, a: s + F.col(f"y_{a}") ** 2, X, F.lit(0.0)).alias("d2"))


def inner(rows: DataFrame, keys: list[str], coverage: float) -> DataFrame:
    """The rows of each group and start up to the grid edge at which ``coverage`` of the group is reached; rows need d2."""
    cell = F.floor(F.log(F.col("d2") + 1e-6) * 32)
    grid = rows.groupBy(*keys, cell.alias("cell")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    grid = grid.withColumns({"upto": F.sum("n").over(w.orderBy("cell")), "all": F.sum("n").over(w)})
    edges = kept(grid.where(F.col("upto") >= coverage * F.col("all")).groupBy(*keys).agg(F.min("cell").alias("edge")))
    return with_groups(rows, edges, keys).where(cell <= F.col("edge")).drop("edge")


def starts(good: DataFrame) -> DataFrame:
    """Models of the starts (g, s): medians, and deviations with no, the sign's and the tangent's correlation."""
    median = lambda c: F.percentile(F.round(c, 3), F.lit(0.5))
    middle = kept(good.groupBy("g").agg(*[median(F.col(a)).alias(f"m_{a}") for a in X]))
    spread = with_groups(good, middle, ["g"])
    spread = spread.groupBy("g").agg(*[median(F.abs(F.col(a) - F.col(f"m_{a}"))).alias(f"s_{a}") for a in X])
    scale = kept(middle.join(spread, "g").select("g", *[f"m_{a}" for a in X], *[F.greatest(1.4826 * F.col(f"s_{a}"), F.lit(FLOOR[a])).alias(f"s_{a}") for a in X]))
    z = with_groups(good, scale, ["g"]).select("g", *[((F.col(a) - F.col(f"m_{a}")) / F.col(f"s_{a}")).alias(a) for a in X])
    norm = F.sqrt(reduce(lambda s, a: s + F.col(a) ** 2, X, F.lit(0.0)))
    sums = z.withColumn("norm", F.greatest(norm, F.lit(1e-9))).groupBy("g")
    sums = sums.agg(*[mean(F.col(a) * F.col(b) / F.col("norm") ** 2).alias(f"c1_{a}_{b}") for a, b in PAIRS], *[mean(F.tanh(a) * F.tanh(b)).alias(f"c2_{a}_{b}") for a, b in PAIRS])
    every = scale.join(sums, "g").withColumn("s", F.explode(F.array(*map(F.lit, STARTS))))

    def scatter(a: str, b: str) -> Column:
        if a == b:
            return F.col(f"s_{a}") ** 2
        alike = lambda k: F.coalesce(F.try_divide(F.col(f"c{k}_{a}_{b}"), F.sqrt(F.col(f"c{k}_{a}_{a}") * F.col(f"c{k}_{b}_{b}"))), F.lit(0.0))
        return F.when(F.col("s") == 1, alike(1)).when(F.col("s") == 2, alike(2)).otherwise(0.0) * F.col(f"s_{a}") * F.col(f"s_{b}")

    return factored(every.withColumns({f"c_{a}_{b}": scatter(a, b) for a, b in PAIRS}), ["g", "s"])


def groups(rows: DataFrame, least: int) -> DataFrame:
    """rows with g: language and source, or the language's pool, or the pool of all."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    rows = rows.withColumns({"g1": F.concat_ws("\x1f", name("lang"), name("source")), "g2": name("lang")})
    size = kept(rows.groupBy("g1", "g2").agg(F.count("*").alias("n")))
    small = size.where(F.col("n") < least).groupBy("g2").agg(F.sum("n").alias("pool"))
    chosen = size.join(small, "g2", "left").select("g1", F.when(F.col("n") >= least, F.col("g1")).when(F.col("pool") >= least, F.concat(F.lit("lang "), F.col("g2"))).otherwise(F.lit("all")).alias("g"))
    return with_groups(rows, kept(chosen), ["g1"]).drop("g1", "g2")


def judge(stats: DataFrame, steps: int = 12, least: int = 60, coverage: float = COVERAGE, cutoff: float = CUTOFF) -> DataFrame:
    """stats (counts() with lang and source) with d2 and kept; d2 is null where the fixed rules failed."""
    good = kept(groups(vector(stats.where(~F.col("base_failed"))), least).select("g", *X))
    every, keys = good.withColumn("s", F.explode(F.array(*map(F.lit, STARTS)))), ["g", "s"]
    model = fitted(inner(distance(every, starts(good), keys), keys, coverage), keys, FACTOR_75)
    for _ in range(steps):
        new = fitted(inner(distance(every, model, keys), keys, coverage), keys, FACTOR_75)
        falls = new.join(model.select(*keys, F.col("det").alias("was")), keys).where(F.col("det") < F.col("was") - 1e-3)
        settled, model = falls.isEmpty(), new
        if settled:
            break
    best = model.groupBy("g").agg(F.min_by("s", F.struct("det", "s")).alias("s"))
    model = kept(model.join(best, keys).drop("s"))
    model = fitted(distance(good, model, ["g"]).where(F.col("d2") <= QUANTILE_975), ["g"], FACTOR_975)
    named = groups(vector(stats.where(~F.col("base_failed"))), least)
    judged = distance(named, model, ["g"]).withColumn("kept", F.coalesce(F.col("d2") <= cutoff, F.lit(True)))
    failed = stats.where("base_failed").withColumns({"d2": F.lit(None).cast("double"), "kept": F.lit(False)})
    return judged.select(*failed.columns).unionByName(failed)


def quality(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the counts, base_failed, d2 and kept of every row of docs (doc_id, text, lang, source)."""
    stats = kept(counts(docs, "lang", "source"))
    return judge(stats, **options)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that pass; rows of equal id and text fare alike."""
    stats = kept(counts(docs.select("doc_id", "text", "lang", "source", F.xxhash64("text").alias("text_hash")), "lang", "source", "text_hash"))
    good = judge(stats, **options).where("kept").select(F.col("doc_id").alias("good_id"), F.col("text_hash").alias("good_hash")).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good["good_id"]) & (F.xxhash64(docs["text"]) == good["good_hash"]), "left_semi")
