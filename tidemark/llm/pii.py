"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers: the
seeds, whatever their characters. A seed or candidate has two lexical patterns:
the two words of the text before the token that it begins in, and the one word
before it with its own shape (runs of digits and of letters as one sign each).
Candidates are tokens with a digit, number tokens joined by spaces and tokens
like e-mail addresses. Patterns and values form a graph, scored in rounds: a
pattern by the share of its values' scores, a value by the mean of its
patterns' of the better sort, seeds staying at 1. Candidates that meet no base span but stand
behind a pattern of high confidence are added, without the punctuation behind
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, need, saved
from .spans import spans, written

KINDS = ["email", "ip", "card", "phone"]
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The contract's patterns. A match can only begin where the one before ends or where its first run of characters does;
#: saying so, and taking runs without going back, keeps long runs from costing their square.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SPACE, _WORD = r"\x20\x09-\x0D", r"[^\x20\x09-\x0D]"
_TOKEN = rf"[^{_SPACE}0-9]*+[0-9]{_WORD}*+"
#: Number tokens joined by spaces, of at most 19 digits, without the punctuation behind them.
_RUN = rf"(?=[0-9().+/-]++\x20)[+(]{{0,2}}+[0-9](?:[().+/-]{{0,3}}+(?:\x20(?:-\x20)?+[(+]{{0,2}}+)?+[0-9]){{1,18}}\)?+(?=[.,;:!?\"'\])}}>]*+(?!{_WORD}))"
_OPEN, _CLOSE = r"\x20?[\[({<]\x20?", r"\x20?[\])}>]\x20?"
_DOT = rf"(?:{_OPEN}(?i:dot){_CLOSE}|\x20(?i:dot)\x20)"
#: A local part, a sign or word "at" and a host: name@host, name[at]host, name (at) host (dot) com, name_at_host.com, name at host dot com.
_END = rf"(?:{_WORD}*[\p{{L}}0-9])"
LIKE_EMAIL = (
    rf"[^{_SPACE}@]+?(?:(?:@|{_OPEN}(?i:at){_CLOSE}){_END}(?:{_DOT}{_END})*+"
    rf"|[_-](?i:at)[_-]{_WORD}{{1,253}}?(?:\.|[_-](?i:dot)[_-])[\p{{L}}0-9]{_END}?+|\x20(?i:at)\x20[^{_SPACE}.]++(?:\x20(?i:dot)\x20{_END})++)"
)
#: A candidate, from the start of a token.
CANDIDATE = rf"(?<!{_WORD})(?:{LIKE_EMAIL}|{_RUN}|{_TOKEN})"
#: Without this there is no candidate.
MAYBE = r"[0-9@]|(?i:[\[({<]\x20?at\x20?[\])}>]|[_-]at[_-]|\x20dot\x20)"
#: A token with a digit.
TOKEN = rf"(?<!{_WORD}){_TOKEN}"
NODES = "array<struct<start:int,end:int,value:string,before:string,kind:string>>"
#: Kinds whose members may hold spaces.
SPACED = ("card", "phone")
#: Rounds of scoring; least score of a pattern, distinct seeds behind it, and digits of a token that it adds.
ROUNDS, CONFIDENCE, SEEDS, DIGITS = 3, 0.8, 3, 6


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Is the check sum of a string of digits right."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str):
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")).cast("int") <= 3
        small = lambda p: F.try_to_number(F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 4), F.lit("9999")) <= 255
        return lambda s: F.forall(F.split(s["value"], r"\."), lambda p: part(p) & small(p))
    if kind == "card":
        return lambda s: F.length(_digits(s["value"])).between(16, 19) & luhn(_digits(s["value"]))
    if kind == "phone":
        return lambda s: F.length(_digits(s["value"])).between(8, 15)
    return lambda s: F.lit(True)


def base(text: Column) -> dict[str, Column]:
    """The base matches of each kind."""
    maybe = {"email": F.contains(text, F.lit("@")), "ip": F.rlike(text, F.lit(r"[0-9]\.[0-9]")), "card": F.rlike(text, F.lit("[0-9][0-9\\x20-]{14}")), "phone": F.contains(text, F.lit("+"))}
    return {k: F.filter(spans(text, k, PATTERNS[k], maybe[k]), _valid(k)) for k in KINDS}


#: Characters in front of a value that its words are looked for in first; where they don't hold two whole ones, all the text in front is read.
_REACH = 82


def _before(text: Column, start: Column, near: Column) -> Column:
    """The two words in front of the token at `start`, lower-cased, whatever their length and distance; one where there is one.

    `near` is the text that ends at `start`; where it is shorter than the reach, the text itself is read.
    """
    n = F.length(near)
    own = F.substring(text, F.greatest(start - (_REACH - 1), F.lit(1)), F.least(start, F.lit(_REACH)))
    ahead = F.when((n >= _REACH) | (n == start), F.substring(near, F.lit(-_REACH), F.lit(_REACH))).otherwise(own)
    two = F.regexp_extract(ahead, rf"[{_SPACE}]({_WORD}+[{_SPACE}]+{_WORD}+)[{_SPACE}]+{_WORD}*$", 1)
    every = F.when(start <= _REACH, ahead).otherwise(F.substring(text, F.lit(1), start))
    whole = F.regexp_extract(every, rf"(?:^|[{_SPACE}])((?:{_WORD}+[{_SPACE}]+)?{_WORD}+)[{_SPACE}]+{_WORD}*$", 1)
    return F.lower(F.when(two != "", two).otherwise(whole))


def shape(value: Column) -> Column:
    """Runs of digits as 9, runs of letters as a, other characters as they are."""
    return F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]+", "9")


def contexts(before: Column, value: Column) -> Column:
    """The patterns of a value behind the words `before`: none where no word is."""
    one = F.concat(F.lit("1 "), F.substring_index(before, " ", -1), F.lit(" "), shape(value))
    return F.when(before == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("2 "), before), one))


def patterns(candidates: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of the patterns of high confidence; candidates have patterns, value and kind (null but for seeds)."""
    edges = saved(
        candidates.select(F.explode("patterns").alias("pattern"), "value", "kind").groupBy("pattern", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.max("kind").alias("kind")),
        "pii-edges",
    )
    seed = F.col("kind").isNotNull()
    scored = edges.withColumn("score", F.when(seed, 1.0).otherwise(0.0))
    for i in range(ROUNDS):
        # one task's sums go out for each pattern or token, however many rows it has
        of_pattern = saved(
            scored.groupBy("pattern").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("confidence"), F.count(F.when(seed, 1)).alias("seeds"), F.mode("kind", True).alias("kind")),
            "pii-patterns",
        )
        if i == ROUNDS - 1:
            break
        joined = edges.join(of_pattern.select("pattern", "confidence"), "pattern")
        # the mean of each sort of pattern; the better one counts
        tokens = joined.groupBy("value", F.substring("pattern", 1, 1).alias("sort")).agg((F.sum(F.col("n") * F.col("confidence")) / F.sum("n")).alias("mean"))
        tokens = tokens.groupBy("value").agg(F.max("mean").alias("mean"))
        scored = edges.join(tokens, "value").withColumn("score", F.when(seed, 1.0).otherwise(F.col("mean"))).drop("mean")
    return of_pattern.filter((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= SEEDS)).select("pattern", "kind", "confidence")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans, more_spans (arrays), a row per row of docs.

    Null texts count as empty; rows that repeat doc_id and text get equal spans.
    Spans that bootstrapping adds have the kind that prevails among the pattern's
    seeds; they overlap no base span. Other columns are not read.
    """
    need(docs, "doc_id", "text")
    text = F.col("text")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", *[c.alias(k) for k, c in base(text).items()])
    found = found.withColumn("base", F.concat(*KINDS))
    made = found.select("*", spans(text, "token", CANDIDATE, F.rlike(text, F.lit(MAYBE))).alias("made"))

    def node(s: Column, near: Column, kind: Column, shift: Column | int = 0) -> Column:
        start = s["start"] + shift
        return F.struct(start.alias("start"), (s["end"] + shift).alias("end"), s["value"].alias("value"), _before(text, start, near).alias("before"), kind.alias("kind"))

    def candidate(s: Column, i: Column) -> Column:
        """The candidate itself, or where it meets a base span those of its tokens that do not."""
        free = lambda x, shift=0: ~F.exists("base", lambda b: (x["start"] + shift < b["end"]) & (b["start"] < x["end"] + shift))
        last = [F.get("made", i - k) for k in (3, 2, 1)]
        near = F.concat(*[F.coalesce(p[c], F.lit("")) for p in last for c in ("gap", "value")], s["gap"])
        parts = F.filter(spans(s["value"], "token", TOKEN), lambda t: free(t, s["start"]))
        split = F.transform(parts, lambda t: node(t, F.lit(""), F.lit(None).cast("string"), s["start"]))
        return F.when(free(s), F.array(node(s, near, F.lit(None).cast("string")))).when(F.contains(s["value"], F.lit(" ")), split).otherwise(F.array().cast(NODES))

    seeds = F.transform("base", lambda s: node(s, s["gap"], s["kind"]))
    tokens = F.concat(seeds, F.flatten(F.transform("made", candidate)))
    short = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = saved(
        made.select(
            "doc_id", F.xxhash64("text").alias("_t"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
            short.alias("base_spans"), tokens.alias("tokens"),
        ),
        "pii-found",
    )
    tokens = rows.select("doc_id", "_t", F.explode("tokens").alias("s")).select("doc_id", "_t", "s.*")
    words = F.regexp_replace("before", rf"[{_SPACE}]+", " ")
    # a token's own end punctuation is none of its value
    bare = F.when(F.col("kind").isNull(), F.regexp_replace("value", r"[.,;:!?\"'\])}>]+$", "")).otherwise(F.col("value"))
    tokens = tokens.withColumn("value", bare).withColumn("patterns", contexts(words, F.col("value")))
    good = patterns(tokens)
    like_email = F.rlike("value", F.lit(f"^(?:{LIKE_EMAIL})$"))
    # where the pattern's kind holds no spaces, a run is its first token
    whole = F.when(F.col("kind").isin(*SPACED) | like_email, F.col("value")).otherwise(F.substring_index("value", " ", 1))
    enough = ((F.col("kind") == "email") & like_email) | (F.length(_digits(whole)) >= DIGITS)
    behind = tokens.filter(F.col("kind").isNull()).drop("kind", "before").withColumn("pattern", F.explode("patterns")).drop("patterns")
    more = (
        behind.join(good, "pattern").groupBy("doc_id", "_t", "start", "value").agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
        .filter(enough).withColumn("end", F.col("start") + F.length(whole))
        .groupBy(F.col("doc_id").alias("_id"), F.col("_t").alias("_u"))
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("more_spans"))
    )
    out = rows.join(more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_u")), "left")
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], "base_spans", F.coalesce("more_spans", empty).alias("more_spans"))


def op3_pii(spark, sf_dir: str) -> DataFrame:
    def of(found: Column, kind: str) -> Column:
        return F.array_sort(F.filter(found, lambda s: s["kind"] == kind))

    def by_kind(found: Column) -> Column:
        return F.flatten(F.array(*[of(found, k) for k in KINDS]))

    return find(documents(spark, sf_dir)).select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(written(by_kind(F.col("base_spans"))), 256).alias("base_sha256"),
        written(by_kind(F.concat("base_spans", "more_spans"))).alias("spans"),
    )
