"""Secret scans: base patterns and a battery of randomness tests, with DataFrame functions only.

Long tokens of letters and digits get three statistics as strings over the
alphabet that their characters suggest (hex, base32, base64): chi-squared of the
symbols, number of runs above and below the middle of the alphabet, and serial
correlation; the sum of their -log p is small where a token looks drawn at
random. What ordinary strings give is counted over the whole corpus: each
document lends all letters of its text that an encoding has, for each encoding,
cut into strings of the least length of each band of lengths. So a token's p-value is the share of
ordinary strings of its encoding and band that look as random as it does, and
tokens are called secrets at a false-discovery rate of RATE (Benjamini-Hochberg)
in each band and encoding. Where too few ordinary strings are known for a
p-value to be small enough, none is called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, let, need, saved
from .spans import overlaps, spans, written

KINDS = ["assign", "access", "hex"]
#: The contract's patterns; those of a least length match only where that is reached, which leaves the same matches.
PATTERNS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
VALUE = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: Tokens that are tested: characters of base64 in either form, so many at least.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
RATE = 0.05
#: What lends no ordinary letters: words with a digit, and such as long as a token. A word's end from its first digit on; its start, read backwards, to that digit.
TAIL, HEAD, LONG = r"[0-9][^\x20\x09-\x0D]*+", r"0[^\x20\x09-\x0D]*+", r"(?<![A-Za-z+/_-])[A-Za-z+/_-]{20,}+"
#: Least lengths of the bands; their common multiple; fours of letters in a block of sums; statistics are counted by eighths up to MOST.
BANDS, PIECE, BLOCK, BINS, MOST = (20, 24, 32, 48, 64, 96), 960, 16, 8, 120
_ALPHABETS = {
    "hex": ("^[0-9a-fA-F]+$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base64": ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}


def base(text: Column) -> dict[str, Column]:
    """The base matches of each kind."""
    maybe = {"assign": F.rlike(text, F.lit("[:=]")), "access": F.contains(text, F.lit("AKIA")), "hex": None}
    out = {k: spans(text, k, PATTERNS[k], maybe[k]) for k in KINDS}
    out["assign"] = F.filter(out["assign"], lambda s: F.length(F.regexp_extract(s["value"], VALUE, 1)) >= 6)
    return out


#: What the three tests are computed from: number of symbols, size of the alphabet, sum of squares of the symbols' counts, symbols in its upper half,
#: runs, and of the symbols: sum, sum of squares, sum of products of neighbours, first and last together. All are whole numbers, in doubles.
SUMS = ("n", "k", "squares", "high", "runs", "total", "total2", "products", "ends")


def scored(df: DataFrame) -> DataFrame:
    """Add `statistic`, the sum of -log p of the three tests, and drop SUMS.

    P(Z > z) by a rational approximation, right to 1e-7; at least 1e-12. Each
    step is a column, so that the generated code stays short enough to be compiled.
    """
    n, k, squares, high, runs, total, total2, products, ends = (F.col(f"_{name}") for name in SUMS)
    pairs, expected = F.col("_pairs"), F.col("_expected")
    steps = [
        {"_pairs": high * (n - high), "_above": n * products - total * (2 * total - ends) + (n - 1) * total * total / n, "_below": n * total2 - total * total},
        {"_expected": 2 * pairs / n + 1},
        {
            "_z0": (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n)),
            "_z1": F.abs(runs - expected) / F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(0.05))),
            "_z2": F.abs(F.when(F.col("_below") == 0, 1.0).otherwise(F.try_divide("_above", "_below"))) * F.sqrt(n),
        },
        {f"_t{i}": 1 / (1 + 0.2316419 * F.abs(f"_z{i}")) for i in range(3)},
    ]
    t = [F.col(f"_t{i}") for i in range(3)]
    poly = [x * (0.319381530 + x * (-0.356563782 + x * (1.781477937 + x * (-1.821255978 + x * 1.330274429)))) for x in t]
    steps.append({f"_u{i}": F.exp(-F.col(f"_z{i}") * F.col(f"_z{i}") / 2) * 0.3989422804014327 * poly[i] for i in range(3)})
    least, twice = F.lit(1e-12), [F.least(F.lit(1.0), 2 * F.greatest(f"_u{i}", F.lit(1e-12))) for i in (1, 2)]
    steps.append({
        "_p0": F.greatest(F.when(F.col("_z0") >= 0, F.col("_u0")).otherwise(1 - F.col("_u0")), least),
        "_p1": F.when(pairs == 0, least).otherwise(twice[0]), "_p2": twice[1],
    })
    steps.append({"statistic": -(F.log("_p0") + F.log("_p1") + F.log("_p2"))})
    made = [name for step in steps for name in step if name != "statistic"]
    return reduce(lambda d, step: d.withColumns(step), steps, df).drop(*made, *[f"_{name}" for name in SUMS])


def battery(rows: DataFrame) -> DataFrame:
    """Add `statistic` (the sum of -log p of the three tests) to rows with `code` (array of symbols from 0, two at least) and `symbols` (size of the alphabet)."""
    n, k = F.size("code").cast("double"), F.col("symbols").cast("double")
    summed = lambda over, f: let(F.col("code"), lambda v: F.aggregate(over, F.lit(0.0), lambda s, x: s + f(v, x)))
    later = F.sequence(F.lit(1), F.size("code") - 1)
    sums = {
        "n": n, "k": k,
        "squares": summed(F.array_distinct("code"), lambda v, c: let(F.size(F.filter(v, lambda x: x == c)).cast("double"), lambda m: m * m)),
        "high": summed(F.col("code"), lambda v, x: F.when(x >= k / 2, 1.0).otherwise(0.0)),
        "runs": 1 + summed(later, lambda v, i: F.when((F.get(v, i) >= k / 2) != (F.get(v, i - 1) >= k / 2), 1.0).otherwise(0.0)),
        "total": summed(F.col("code"), lambda v, x: x), "total2": summed(F.col("code"), lambda v, x: x * x),
        "products": summed(later, lambda v, i: F.get(v, i) * F.get(v, i - 1)),
        "ends": F.get("code", 0) + F.get("code", F.size("code") - 1),
    }
    return scored(rows.withColumns({f"_{name}": sums[name] for name in SUMS}))


def _band(length: Column) -> Column:
    """Number of the band of a length, from 0."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in BANDS]), lambda b: b <= length)) - 1


def tested(tokens: DataFrame) -> DataFrame:
    """value, encoding, band and statistic of distinct tokens in `value`."""
    encoding = F.lit("base64")
    for name in ("base32", "hex"):
        encoding = F.when(F.rlike("value", F.lit(_ALPHABETS[name][0])), name).otherwise(encoding)
    alphabet = F.create_map(*[F.lit(x) for name, (_, letters) in _ALPHABETS.items() for x in (name, letters)])[F.col("encoding")]
    plain = F.when(F.col("encoding") == "hex", F.lower("value")).otherwise(F.translate("value", "-_", "+/"))
    df = tokens.withColumn("encoding", encoding).withColumn("_letters", alphabet).withColumn("symbols", F.length("_letters"))
    df = df.withColumn("code", F.transform(F.split(plain, ""), lambda c: F.instr(F.col("_letters"), c).cast("double") - 1))
    return battery(df.withColumn("band", _band(F.length("value")))).select("value", "encoding", "band", "statistic")


def _constant(values: list[int]) -> Column:
    """An array of whole numbers; folded to one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _strings(pieces: DataFrame, encoding: str, bands: list[int]) -> DataFrame:
    """band and statistic of each string of the encoding's letters that `letters`, PIECE at most a row, is cut into for each band.

    Sums run over the letters and are kept after each four, the step that all
    lengths of BANDS have in common; a string's sums are the difference of two.
    The counts of eight letters share a number, seven bits each, of which a
    string of 96 needs no more; likewise products, squares, sums and changes.
    """
    own = _ALPHABETS[encoding][1]
    code = [i for i, c in enumerate(own) if c.isalpha()]
    many, high = len(code), [c >= len(own) / 2 for c in code]
    words = many // 8 + 1  # the symbols in the upper half are counted behind the letters
    counts = lambda w, i: sum(1 << 7 * (s % 8) for s in ([i, many] if high[i] else [i]) if s // 8 == w)
    alone = [(x * x << 18) + (x << 36) for x in code]
    next_to = [code[i] * code[j] + ((high[i] != high[j]) << 49) for i in range(many) for j in range(many)]
    number = {ord(own[x]): i for i, x in enumerate(code)}
    numbers, step = _constant([number.get(64 + i, 0) for i in range(64)]), _constant(next_to)
    of_two = {f"c{w}": _constant([counts(w, i) + counts(w, j) for i in range(many) for j in range(many)]) for w in range(words)}
    of_two["w"] = _constant([alone[i] + alone[j] + next_to[i * many + j] for i in range(many) for j in range(many)])

    def four(x: Column) -> Column:
        """Letters 1 and 2, 2 and 3, 3 and 4 as places in the tables, with the first and last."""
        return let(F.array(*[F.get(numbers, F.ascii(F.substring(x, i, 1)) - 64).cast("int") for i in (1, 2, 3, 4)]), lambda v: F.struct(
            (F.get(v, 0) * many + F.get(v, 1)).alias("a"), (F.get(v, 1) * many + F.get(v, 2)).alias("mid"), (F.get(v, 2) * many + F.get(v, 3)).alias("b"),
            F.get(v, 0).alias("first"), F.get(v, 3).alias("last"),
        ))

    def add(s: Column, t: Column) -> Column:
        more = {name: s[name] + F.get(table, t["a"]) + F.get(table, t["b"]) for name, table in of_two.items()}
        more["w"] = more["w"] + F.get(step, t["mid"]) + F.get(step, s["last"] * many + t["first"])
        return F.struct(*[v.alias(name) for name, v in more.items()], t["first"].alias("first"), t["last"].alias("last"))

    zero = F.struct(*[F.lit(0).cast("long").alias(name) for name in of_two], F.lit(0).alias("first"), F.lit(0).alias("last"))
    kept = "array<struct<" + ",".join(f"{name}:bigint" for name in of_two) + ",first:int,last:int>>"

    def some(acc: Column, b: Column) -> Column:
        """A block more: appending copies, so the array is one of short ones, each from where the one before ends on."""
        carry = F.when(b == 0, zero).otherwise(F.get(F.get(acc, b - 1), BLOCK))
        return F.concat(acc, F.array(F.aggregate(F.slice("fours", b * BLOCK + 1, F.lit(BLOCK)), F.array(carry).cast(kept), lambda s, t: F.concat(s, F.array(add(F.get(s, F.size(s) - 1), t))))))

    def after(q: Column) -> Column:
        """The sums over the first q fours."""
        return F.get(F.get("sums", F.floor(q / BLOCK).cast("int")), q % BLOCK)

    df = pieces.filter(F.length("letters") >= BANDS[0]).select(F.transform(F.regexp_extract_all("letters", F.lit(".{4}"), F.lit(0)), four).alias("fours"))
    df = df.select(F.size("fours").alias("many"), F.aggregate(F.sequence(F.lit(0), F.floor(F.size("fours") / BLOCK).cast("int")), F.array().cast(f"array<{kept}>"), some).alias("sums"))
    df = df.select("many", "sums", F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.lit(BANDS[b] // 4).alias("fours")) for b in bands])).alias("b"))
    df = df.filter(F.col("many") >= F.col("b.fours"))
    df = df.select("sums", "b.band", "b.fours", F.explode_outer(F.sequence(F.lit(0), F.floor(F.col("many") / F.col("b.fours")).cast("int") - 1)).alias("i"))
    at = F.col("i") * F.col("fours")
    df = df.select("band", "fours", after(at).alias("_before"), after(at + 1)["first"].alias("_first"), after(at + F.col("fours")).alias("_last"))
    sure = lambda x: F.coalesce(x, F.lit(0).cast("long"))  # noqa: E731  never null; said so, the generated code is shorter
    own_sum = lambda name: F.col("_last")[name] - F.col("_before")[name]
    df = df.select(
        "band", (F.col("fours") * 4).cast("double").alias("_n"), *[sure(own_sum(f"c{w}")).alias(f"c{w}") for w in range(words)],
        sure(own_sum("w") - F.get(step, F.col("_before.last") * many + F.col("_first"))).alias("w"),
        sure(F.get(_constant(code), F.col("_first")) + F.get(_constant(code), F.col("_last.last"))).alias("ends"),
    )
    part = lambda name, at, bits: F.shiftright(name, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    count = [part(f"c{s // 8}", 7 * (s % 8), 7) for s in range(many + 1)]
    for w in range(words):  # a step for each number, as in `scored`
        squares = sum((c * c for c in count[8 * w : min(8 * w + 8, many)]), F.col("squares") if w else F.lit(0).cast("long"))
        df = df.withColumn("squares", squares)
    sums = {"squares": F.col("squares"), "high": count[many], "runs": part("w", 49, 7) + 1, "total": part("w", 36, 13), "total2": part("w", 18, 18), "products": part("w", 0, 18), "ends": F.col("ends")}
    df = df.select("band", "_n", F.lit(float(len(own))).alias("_k"), *[v.cast("double").alias(f"_{name}") for name, v in sums.items()])
    return scored(df).select(F.lit(encoding).alias("encoding"), "band", "statistic")


def ordinary(docs: DataFrame, cells: list[tuple[str, int]] | None = None) -> DataFrame:
    """encoding, band and statistic of all strings of ordinary letters of all documents (text).

    Words that could be tokens lend nothing. Of the other letters of a text
    those count that the encoding's alphabet has, in its case; for each band
    they are cut, from the first on, into strings of its least length, and what
    is left at the end is shorter than a string. Only strings of the named
    cells (encoding, band), if any are named.
    """
    words = F.reverse(F.regexp_replace(F.reverse(F.regexp_replace("text", TAIL, "0")), HEAD, ""))
    letters = F.regexp_replace(F.regexp_replace(words, LONG, ""), "[^A-Za-z]+", "")
    spelled = {"hex": F.regexp_replace(F.lower(letters), "[^a-f]+", ""), "base32": F.upper(letters), "base64": letters}
    parts = []
    for encoding in _ALPHABETS:
        bands = [b for b in range(len(BANDS)) if cells is None or (encoding, b) in cells]
        if bands:
            # pieces of a common multiple of the bands' lengths are cut where the strings are; for `explode`, Spark would ask a filter that reads each text again
            pieces = docs.select(F.explode_outer(F.regexp_extract_all(spelled[encoding], F.lit(f".{{1,{PIECE}}}"), F.lit(0))).alias("letters"))
            parts.append(_strings(pieces, encoding, bands))
    if not parts:
        return docs.filter(F.lit(False)).select(F.lit("").alias("encoding"), F.lit(0).alias("band"), F.lit(0.0).alias("statistic"))
    return reduce(DataFrame.unionByName, parts)


def secrets(tokens: DataFrame, plain: DataFrame) -> DataFrame:
    """The `value`s that are called secrets; both tables have encoding, band and statistic."""
    binned = lambda df: df.withColumn("bin", F.least(F.floor(F.col("statistic") * BINS), F.lit(MOST * BINS)).cast("int"))
    cell = ["encoding", "band"]
    both = binned(tokens).groupBy(*cell, "bin").agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("plain"))
    both = both.unionByName(binned(plain).groupBy(*cell, "bin").agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("plain")))
    both = both.groupBy(*cell, "bin").agg(F.sum("n").alias("n"), F.sum("plain").alias("plain"))  # at most MOST * BINS + 1 rows a cell
    of_cell = Window.partitionBy(*cell)
    upto = of_cell.orderBy("bin")
    step = both.withColumns({"found": F.sum("n").over(upto), "all": F.sum("n").over(of_cell), "alike": F.sum("plain").over(upto), "known": F.sum("plain").over(of_cell)})
    # a bin's p-value is that of its upper end: it holds for each statistic in it
    called = step.filter((F.col("n") > 0) & ((1 + F.col("alike")) / (1 + F.col("known")) <= RATE * F.col("found") / F.col("all")))
    last = called.groupBy(*cell).agg(F.max("bin").alias("last"))
    return binned(tokens).join(F.broadcast(last), cell).filter(F.col("bin") <= F.col("last")).select("value")  # a row for each cell


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_spans, more_spans (arrays), a row per row of docs.

    Null texts count as empty; rows that repeat doc_id and text get equal spans.
    Added spans (kind random) hold a letter and a digit and overlap no base
    span; a corpus of little text has too few ordinary strings to add any.
    Other columns are not read.
    """
    need(docs, "doc_id", "text")
    text = F.col("text")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", *[c.alias(k) for k, c in base(text).items()])
    found = found.withColumn("base", F.concat(*KINDS))
    long = F.filter(spans(text, "random", TOKEN), lambda s: F.rlike(s["value"], F.lit("[0-9]")) & F.rlike(s["value"], F.lit("[A-Za-z]")))
    free = F.filter(long, lambda s: ~F.exists("base", lambda b: overlaps(b, s)))
    slim = lambda c: F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = saved(
        found.select(
            "doc_id", F.xxhash64("text").alias("_t"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], slim(F.col("base")).alias("base_spans"),
            F.transform(free, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))).alias("tokens"),
        ),
        "secrets-found",
    )
    tokens = rows.select("doc_id", "_t", F.explode("tokens").alias("s")).select("doc_id", "_t", "s.*")
    found = saved(tested(tokens.select("value").distinct()), "secrets-tested")
    cells = [(r["encoding"], r["band"]) for r in found.select("encoding", "band").distinct().collect()]  # of len(_ALPHABETS) * len(BANDS)
    good = secrets(found, ordinary(docs.select("text").filter(F.col("text").isNotNull()), cells))
    more = (
        tokens.join(good, "value").groupBy(F.col("doc_id").alias("_id"), F.col("_t").alias("_u"))
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("more_spans"))
    )
    out = rows.join(more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_u")), "left")
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], "base_spans", F.coalesce("more_spans", empty).alias("more_spans"))


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in [*KINDS, "random"]]), s["kind"])

    def by_start(found: Column) -> Column:
        keyed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.array_sort(keyed)

    return find(documents(spark, sf_dir)).select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(written(by_start(F.col("base_spans"))), 256).alias("base_sha256"),
        written(by_start(F.concat("base_spans", "more_spans"))).alias("spans"),
    )
