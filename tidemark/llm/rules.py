"""Quality rules: fixed limits, then robust multivariate outliers of each language and source.

Statistics of each text are transformed into a vector. For each (lang, source)
the minimum-covariance-determinant estimate of centre and spread is found as
FAST-MCD does: on a bounded sample of the group's rows, many starts take two
concentration steps, the best of them more until the determinant falls no
further; each group goes on from the best two over all its rows, and of these
estimates the one of least determinant stays. A step over all rows is
one grouped sum, with the quantile of distances taken from a fine histogram, so
that a group of any size is summed up before it is shuffled. A fixed matrix is
added to each covariance (as in the regularised form of the estimate): on an
axis where most rows are equal, small differences do not count. Texts far from
the centre by Mahalanobis distance are rejected.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _powers, documents, mix64, need, saved, slices, small_batches, text_bytes, words

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
AXES = ["x0", "x1", "x2", "x3", "x4"]
REPEAT_WINDOW = 8
#: Share of rows that an estimate rests on; rows of a group's sample, about; random starts, and how many of them go on;
#: the fall of the logarithm of the determinant under which steps end, however many that takes.
SHARE, SAMPLE, STARTS, BEST, ENOUGH = 0.75, 1500, 50, 5, 1e-4
#: Rows that a group of five axes needs (five for each axis); a smaller one is judged by its language, that by all rows.
LEAST = 25
#: Groups whose estimates are broadcast (300 bytes each); beyond, they are joined.
MAX_BROADCAST_ROWS = 100_000
#: Fixed values for five axes. Factor that makes the covariance of the nearest 3/4 that of all rows if these are normal:
#: 0.75 / P(chi2 with 7 degrees <= q), q the 0.75 quantile of chi2 with 5 degrees. Limit: the 0.99999 quantile of chi2 with 5 degrees.
CONSISTENCY, LIMIT = 1.41, 30.86
#: Least standard deviation of each axis: on an axis where most rows are equal (no symbols, no repeats), smaller differences do not count.
FLOOR = [0.3, 0.15, 0.06, 0.1, 0.1]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _again(group: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element: is an equal one (same group, same code) in the list; is it not the first of these."""
    order = np.lexsort((code, group))
    g, c = group[order], code[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
    many, later = np.empty(len(order), bool), np.empty(len(order), bool)
    many[order] = same[:-1] | same[1:]
    later[order] = same[:-1]  # lexsort is stable
    return many, later


def statistics(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """STATS of each text, as arrays."""
    n = len(offsets) - 1

    def of_docs(flags: np.ndarray) -> np.ndarray:
        run = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(flags, out=run[1:])
        return run[offsets[1:]] - run[offsets[:-1]]

    start, end, doc, code = words(raw, offsets)
    n_words = np.bincount(doc, minlength=n)
    starts_char = (raw & 0xC0) != 0x80
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))

    # lines with a word: equal length and hash, in one text
    breaks = np.flatnonzero(raw == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(raw)]
    after = np.concatenate([begin[1:], [len(raw)]]).astype(np.int64)
    after -= (raw[np.maximum(after - 1, 0)] == 10) if len(begin) else 0
    n_dup = np.zeros(n, np.int64)
    if len(begin):
        with np.errstate(over="ignore"):
            run = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(0xD1342543DE82EF95, len(raw)), out=run[1:])
            line = mix64((run[after] - run[begin]) * _powers(pow(0xD1342543DE82EF95, -1, 1 << 64), len(raw))[begin] + (after - begin).astype(np.uint64))
        has = np.searchsorted(start, after) > np.searchsorted(start, begin)
        of = np.searchsorted(offsets, begin, side="right") - 1
        _, later = _again(of[has], line[has])
        n_dup = np.bincount(of[has][later], minlength=n)

    n_repeat = np.zeros(n, np.int64)
    if len(code) >= REPEAT_WINDOW:
        k = REPEAT_WINDOW
        whole = np.flatnonzero(doc[k - 1 :] == doc[: len(doc) - k + 1])
        with np.errstate(over="ignore"):
            total = np.zeros(len(whole), np.uint64)
            for j in range(k):
                total = mix64(total * np.uint64(0xD1342543DE82EF95) + code[whole + j])
        many, _ = _again(doc[whole], total)
        cover = np.zeros(len(code) + 1, np.int64)
        np.add.at(cover, whole[many], 1)
        np.add.at(cover, whole[many] + k, -1)
        n_repeat = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    values = (n_words, of_docs(starts_char & ~blank), of_docs(_SYMBOL[raw]), n_dup, n_repeat)
    return {name: v.astype(np.int64) for name, v in zip(STATS, values)}


def _measure(batches, columns: list[str]):
    for batch in batches:
        for part in slices(batch):
            found = statistics(*text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *[pa.array(found[s]) for s in STATS]], names=[*columns, *STATS])


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The named columns of docs and STATS; null texts count as empty."""
    need(docs, "text", *keep)
    small_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), *(f"{s} bigint" for s in STATS)])
    return docs.select(*keep, "text").mapInArrow(lambda batches: _measure(batches, list(keep)), schema)


def _transform(df: DataFrame) -> DataFrame:
    """Length on a log scale, mean word length drawn to 5 in short texts, square roots of shares."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda c, of: F.sqrt(F.col(c) / of)
    axes = [
        F.log1p("n_words"),
        (F.col("word_chars") + 250.0) / (F.col("n_words") + 50),
        share("n_symbols", F.greatest(F.col("word_chars"), F.lit(1))),
        share("n_dup_lines", n),
        share("n_repeat_words", n),
    ]
    return df.select("*", *[a.cast("double").alias(x) for a, x in zip(axes, AXES)])


def _distance(mean: str = "mean", inverse: str = "inverse"):
    """Squared Mahalanobis distance; `inverse` holds the matrix row by row."""
    p = len(AXES)
    off = [F.col(x) - F.get(mean, i) for i, x in enumerate(AXES)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(p):
            total = total + off[i] * off[j] * F.get(inverse, i * p + j)
    return total


def covariance(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the rows, made consistent, with the floor added."""
    mean = x.mean(axis=0)
    off = x - mean
    return mean, off.T @ off / len(x) * CONSISTENCY + np.diag(np.square(FLOOR))


def distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    off = x - mean
    return (off @ np.linalg.inv(cov) * off).sum(axis=1)


def _concentrate(x: np.ndarray, mean: np.ndarray, cov: np.ndarray, steps: int):
    """Estimates from the SHARE of rows that are nearest, again and again; the determinant never grows."""
    h = -(-len(x) * 3 // 4)
    last = np.linalg.slogdet(cov)[1]
    for _ in range(steps):
        mean, cov = covariance(x[np.argsort(distances(x, mean, cov), kind="stable")[:h]])
        now = np.linalg.slogdet(cov)[1]
        if abs(last - now) < 1e-9:
            break
        last = now
    return mean, cov, float(last)


def fast_mcd(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Estimates (mean, covariance, log determinant), least determinant first: from the medians and from random small subsets."""
    x = x[np.lexsort(x.T[::-1])]  # whatever order the rows come in
    rng = np.random.default_rng(len(x))
    median = np.median(x, axis=0)
    spread = 1.4826 * np.median(np.abs(x - median), axis=0)
    starts = [(median, np.diag(np.square(spread) + np.square(FLOOR)))]
    starts += [covariance(x[rng.choice(len(x), min(len(x), x.shape[1] + 1), replace=False)]) for _ in range(STARTS)]
    first = sorted((_concentrate(x, *s, 2) for s in starts), key=lambda e: e[2])[:BEST]
    return sorted((_concentrate(x, *e[:2], 100) for e in first), key=lambda e: e[2])


_PARAMETERS = "grp string, try int, mean array<double>, inverse array<double>, logdet double, whole boolean"


def _of_sample(df: pd.DataFrame) -> pd.DataFrame:
    """A group's sample to its two best estimates; whole: the sample is the group."""
    whole = len(df) == df["n"].iloc[0]
    found = fast_mcd(df[AXES].to_numpy(np.float64))[:2]
    return pd.DataFrame({
        "grp": df["grp"].iloc[0], "try": range(len(found)), "mean": [e[0].tolist() for e in found], "inverse": [np.linalg.inv(e[1]).ravel().tolist() for e in found],
        "logdet": [e[2] for e in found], "whole": whole,
    })


def _estimate(frames):
    """Sums of each group to mean, inverse covariance and determinant, a batch of groups at a time."""
    p = len(AXES)
    for df in frames:
        means, inverses, dets = [], [], []
        for row in df.itertuples(index=False):
            mean = np.array(row.sums) / row.n
            second = np.zeros((p, p))
            second[np.triu_indices(p)] = np.array(row.products) / row.n
            second = second + np.triu(second, 1).T
            cov = (second - np.outer(mean, mean)) * CONSISTENCY + np.diag(np.square(FLOOR))
            means.append(mean.tolist())
            inverses.append(np.linalg.inv(cov).ravel().tolist())
            dets.append(float(np.linalg.slogdet(cov)[1]))
        yield pd.DataFrame({"grp": df["grp"], "try": df["try"], "mean": pd.Series(means, dtype=object), "inverse": pd.Series(inverses, dtype=object), "logdet": dets, "whole": False})


def _wide(table: DataFrame) -> DataFrame:
    """A table of groups, broadcast if it has at most MAX_BROADCAST_ROWS rows."""
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table


def estimates(rows: DataFrame) -> DataFrame:
    """grp, mean, inverse: the estimate of least determinant of each group; rows have grp, u (uniform from 0 to 1) and AXES."""
    sizes = saved(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "rules-sizes")
    sample = rows.join(_wide(sizes), "grp").filter((F.col("n") <= SAMPLE) | (F.col("u") < SAMPLE / F.col("n")))
    now = saved(sample.groupBy("grp").applyInPandas(_of_sample, _PARAMETERS), "rules-sample")
    done = [now.filter("whole")]
    p = len(AXES)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    going = now  # every group alike: an estimate of a whole group has nowhere to fall
    for step in count():
        if going.isEmpty():
            break
        # sixty-fourths of an octave: the nearest share of rows ends with a whole bin
        near = rows.join(_wide(going), "grp").withColumn("bin", F.floor(F.log2(_distance() + 1e-6) * 64).cast("int"))
        bins = near.groupBy("grp", "try", "bin").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"a{i}") for i, x in enumerate(AXES)],
            *[F.sum(F.col(AXES[i]) * F.col(AXES[j])).alias(f"b{i}_{j}") for i, j in pairs],
        )
        whole, upto = Window.partitionBy("grp", "try"), Window.partitionBy("grp", "try").orderBy("bin")
        inner = bins.withColumn("all", F.sum("n").over(whole)).withColumn("before", F.sum("n").over(upto) - F.col("n")).filter(F.col("before") < SHARE * F.col("all"))
        sums = inner.groupBy("grp", "try").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(f"a{i}") for i in range(p)]).alias("sums"), F.array(*[F.sum(f"b{i}_{j}") for i, j in pairs]).alias("products")
        )
        after = saved(sums.mapInPandas(_estimate, _PARAMETERS), "rules-step")
        falls = after.join(going.select("grp", "try", F.col("logdet").alias("was")), ["grp", "try"])
        still = F.col("was") - F.col("logdet") > ENOUGH if step else F.lit(True)  # the first one came from the sample
        falls = saved(falls.withColumn("still", still).drop("was"), "rules-falls")
        done.append(falls.filter("not still").drop("still"))
        going = falls.filter("still").drop("still")
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    best = every.groupBy("grp").agg(F.min_by(F.struct("mean", "inverse"), F.struct("logdet", "try")).alias("e"))
    return saved(best.select("grp", "e.mean", "e.inverse"), "rules-estimates")


def judge(docs: DataFrame, *, limit: float = LIMIT, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """`keep` columns, STATS, base_failed, distance, judged_by and kept, a row per document.

    base_failed: under 20 words, or over 30 % of the words in repeated windows.
    Estimates come from documents that pass; null lang or source is a value of
    its own. A group of fewer than LEAST such rows is judged by the estimate of
    its language, a language of fewer by that of all rows (judged_by: the JSON
    array of what the estimate is of); if all rows are fewer, distance is null
    and the verdict is to keep. Null and empty texts fail. Repeated rows are rows
    of their own.
    """
    keep = tuple(dict.fromkeys([*keep, "lang", "source"]))
    clash = {*STATS, *AXES, "grp", "base_failed", "kept", "distance", "judged_by", "mean", "inverse", "u"} & set(docs.columns)
    rows = saved(measure(docs.drop(*clash), tuple(c for c in keep if c not in clash)), "rules-stats")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stored = [c for c in keep if c in rows.columns]
    rows = _transform(rows).withColumn("base_failed", failed)
    rows = rows.withColumns({"_own": F.to_json(F.array("lang", "source")), "_lang": F.to_json(F.array("lang"))})
    sizes = saved(rows.filter(~F.col("base_failed")).groupBy("_own", "_lang").agg(F.count(F.lit(1)).alias("n")), "rules-groups")
    of_lang = sizes.groupBy("_lang").agg(F.sum("n").alias("lang_n"), F.min("n").alias("least_n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.lit(0)).first()["n"]
    rest = F.when(F.col("lang_n") >= LEAST, F.col("_lang")).when(F.lit(total >= LEAST), F.lit("[]"))
    groups = sizes.join(of_lang, "_lang").withColumn("judged_by", F.when(F.col("n") >= LEAST, F.col("_own")).otherwise(rest))
    to_all = bool(total >= LEAST) and not of_lang.filter(F.col("lang_n") < LEAST).isEmpty()
    members = F.array(
        F.when(F.col("n") >= LEAST, F.col("_own")), F.when((F.col("lang_n") >= LEAST) & (F.col("least_n") < LEAST), F.col("_lang")), F.when(F.lit(to_all), F.lit("[]"))
    )
    groups = saved(groups.select("_own", "judged_by", F.filter(members, lambda x: x.isNotNull()).alias("members")), "rules-names")
    wide = _wide(groups)
    uniform = F.pmod(F.xxhash64(*stored, *AXES), F.lit(1 << 30)) / float(1 << 30)
    good = saved(rows.filter(~F.col("base_failed")).join(wide, "_own").select(F.explode("members").alias("grp"), uniform.alias("u"), *AXES), "rules-axes")
    found = estimates(good).withColumnRenamed("grp", "judged_by")
    out = rows.join(wide.drop("members"), "_own", "left").join(_wide(found), "judged_by", "left").withColumn("distance", _distance())
    verdict = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return out.withColumn("kept", verdict).select(*stored, *STATS, "base_failed", "distance", "judged_by", "kept")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).select("doc_id", "lang", "source", "text")).drop("lang", "source")
