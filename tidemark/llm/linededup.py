"""Line dedup by overlapping three-line windows, with DataFrame functions only.

Lines are what lies between \\n; a line without a word takes no part and stays.
Each run of three consecutive other lines of a text is a window. Of equal
windows anywhere in the table the first by (doc_id, position) stays; the lines
that later ones cover go, where covered positions are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, let, need

#: Lines of a window.
WINDOW = 3
HAS_WORD = r"[^\x20\x09-\x0D]"


def _worded(every):
    """Of all lines, those that hold a word, as array<struct<at, a, b>>: number of the line and 128 bits of hash."""
    numbered = F.transform(every, lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    return F.transform(
        F.filter(numbered, lambda x: F.rlike(x["line"], F.lit(HAS_WORD))),
        lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b")),
    )


def _windows(lines, size: int):
    """array<struct<a, b, at>>: hashes of each window and the numbers of its lines."""
    starts = F.when(F.size(lines) >= size, F.sequence(F.lit(0), F.size(lines) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(*[F.get(lines, i + j)["a"] for j in range(size)]).alias("a"),
            F.xxhash64(*[F.get(lines, i + j)["b"] for j in range(size)]).alias("b"),
            F.array(*[F.get(lines, i + j)["at"] for j in range(size)]).alias("at"),
        ),
    )


def dedup_lines(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """docs with `text` cut to the lines that stay, and n_lines, n_removed (lines with a word), removed (their numbers in the text, from 0).

    Every other column is kept. Null text stays null, with no lines; texts of
    fewer than `window` lines with a word stay as they are. A text that loses
    every line becomes empty. Rows that repeat both doc_id and text are one
    document and lose the same lines; a null doc_id sorts first.
    """
    need(docs, "doc_id", "text")
    clash = [c for c in docs.columns if c in ("n_lines", "n_removed", "removed", "_t", "_id")]
    if clash:
        docs = docs.drop(*clash)
    key = F.xxhash64("text").alias("_t")
    found = let(F.split("text", "\n", -1), lambda every: let(_worded(every), lambda lines: _windows(lines, window)))
    windows = docs.select(F.col("doc_id").alias("_id"), key, F.explode(found).alias("w")).select("_id", "_t", "w.*")
    here = F.struct("_id", "_t", "at")
    firsts = windows.groupBy("a", "b").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = (
        windows.join(firsts, ["a", "b"])
        .filter(here > F.col("first"))
        .groupBy("_id", F.col("_t").alias("_u"))
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("removed"))
    )
    out = docs.withColumn("_t", F.xxhash64("text")).join(later, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_u")), "left")

    def rest(every):
        kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("removed"))
        return F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n")

    return out.select(
        *[F.when(F.col("removed").isNull(), F.col("text")).otherwise(let(F.split("text", "\n", -1), rest)).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.coalesce(F.size(F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(HAS_WORD)))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


#: The same in DuckDB SQL.
OP8_SQL = r"""
WITH every AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents WHERE text IS NOT NULL
), worded AS (
    SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM every WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
    SELECT w.*, lead(line, 1) OVER d AS line2, lead(line, 2) OVER d AS line3, lead(pos, 1) OVER d AS pos2, lead(pos, 2) OVER d AS pos3
    FROM worded w WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id NULLS FIRST, pos) AS nth FROM windows WHERE pos3 IS NOT NULL
), covered AS (
    SELECT DISTINCT doc_id, unnest([pos, pos2, pos3]) AS pos FROM numbered WHERE nth > 1
), lost AS (
    SELECT doc_id, count(*) AS n_removed, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS removed FROM covered GROUP BY doc_id
), rest AS (
    SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) AS kept FROM every e ANTI JOIN covered c ON e.doc_id = c.doc_id AND e.pos = c.pos GROUP BY e.doc_id
), counts AS (
    SELECT doc_id, count(*) AS n_lines FROM worded GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed,
    sha256(coalesce(kept, '')) AS text_sha256
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN rest USING (doc_id)
"""
