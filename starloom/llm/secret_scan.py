"""Secrets in texts: three fixed patterns, and tokens that look random to character Markov models.

The patterns give assignments (``password = ...``), access keys and long hexadecimal numbers, leftmost and without
overlap for each kind.  Two first-order Markov models of characters are trained from labelled tokens: the values that
the patterns found are random strings, the words that two texts or more have are ordinary identifiers.  A further token of
``LEAST_TOKEN`` characters or more is a secret if the log-likelihood ratio of the models exceeds ``LEAST_RATIO``; tokens
without a letter are numbers, not secrets, and what lies under a pattern's span is not looked at again.

All of it is column expressions.  Java's regular expressions give no positions, so a text is split at the matches and
positions are prefix sums over the lengths of what lies between.  The models are one table of log ratios for pairs of
ASCII characters (its size is fixed), counted over all pattern values and over the words of a bounded sample of texts
without any (``SAMPLE_DOCS``, by hash of the doc_id).

Defined cases: null and empty texts have no spans; positions count code points, the end is exclusive; repeated rows
stay; other columns are ignored; without any pattern value random characters are taken as uniform; an empty table gives
an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.natively import let, pairs, running_max, running_sum, words

#: The patterns of the three base kinds, in the order in which equal starts are listed.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORD = r"(?i)password|passwd|secret|token|api_?key"
#: Longer matches only: the same as dropping short ones, because a run of these characters is matched whole.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
LEAST_VALUE = 6

LEAST_TOKEN = 16
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
#: Nats by which the random model must be likelier for the whole token, and for each of its pairs.
LEAST_RATIO, LEAST_MEAN = 8.0, 0.5
SAMPLE_DOCS = 2000
#: Pairs that each model starts with for each first character, shared out as single characters are.
PRIOR = 20.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"


def _matches(text: Column, pattern: str, group: int | None = None) -> Column:
    """Structs (start, end, match, value) of all matches, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def located(m: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))
        ends = running_sum(F.zip_with(between, m, lambda a, b: (F.length(a) + F.length(b)).cast("long")))
        joined = F.zip_with(ends, m, lambda e, x: F.struct((e - F.length(x)).alias("start"), e.alias("end"), x.alias("match")))
        return F.zip_with(joined, value, lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"), v.alias("value")))

    return let(found, located)


def _none() -> Column:
    return F.expr("cast(array() as array<struct<start: bigint, end: bigint, match: string, value: string>>)")


def base_matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, the matches of each kind as arrays, and the whole row."""
    t = F.col("text")
    df = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.struct("*").alias("row"))
    assigned = F.filter(_matches(t, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST_VALUE)
    return df.select(
        "doc_id",
        "text",
        "row",
        F.when(t.rlike(KEYWORD), assigned).otherwise(_none()).alias("assign"),
        F.when(t.contains("AKIA"), _matches(t, ACCESS)).otherwise(_none()).alias("access"),
        F.when(t.rlike(HEX), _matches(t, HEX)).otherwise(_none()).alias("hex"),
    )


def _pair_counts(tokens: DataFrame, name: str) -> DataFrame:
    """a, b, n: how often character b follows a; at most one row for each two characters of the alphabet."""
    both = pairs(F.split("token", ""), lambda a, b: F.concat(a, b))
    of = tokens.select(F.explode(both).alias("ab")).filter(F.col("ab").rlike(r"^[A-Za-z0-9+/_-]{2}$"))
    return of.groupBy("ab").agg(F.count("*").cast("double").alias(name))


def train(matched: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log ratio of the random to the ordinary model for each two ASCII characters, at 128 * first + second."""
    values = matched.select(F.explode(F.concat("assign", "access", "hex")).alias("m"))
    random = values.select(F.regexp_replace("m.value", "^AKIA", "").alias("token"))
    found = F.size("assign") + F.size("access") + F.size("hex") > 0
    ordinary = matched.filter(~found).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).distinct()
    plain = matched.join(F.broadcast(ordinary), "doc_id").select("doc_id", F.explode(F.array_distinct(words(F.col("text")))).alias("token"))
    plain = plain.groupBy("token").agg(F.count("*").alias("docs")).filter("docs > 1")
    counts = _pair_counts(random, "random").join(_pair_counts(plain, "ordinary"), "ab", "full").collect()  # 66 * 66 rows at most
    tables = {name: {r.ab: r[name] for r in counts if r[name]} for name in ("random", "ordinary")}

    def character(name: str) -> dict[str, float]:
        seen = {b: 1.0 for b in ALPHABET}
        for ab, n in tables[name].items():
            seen[ab[1]] += n
        return {b: n / sum(seen.values()) for b, n in seen.items()}

    def chance(name: str, a: str) -> dict[str, float]:
        row = [tables[name].get(a + b, 0.0) + PRIOR * alone[name][b] for b in ALPHABET]
        return {b: math.log(x / sum(row)) for b, x in zip(ALPHABET, row, strict=True)}

    alone = {name: character(name) for name in tables}
    out = [0.0] * (128 * 128)
    for a in ALPHABET:
        random_, plain_ = chance("random", a), chance("ordinary", a)
        for b in ALPHABET:
            out[128 * ord(a) + ord(b)] = random_[b] - plain_[b]
    return out


def _blanked(text: Column, pattern: str, least: int = 0) -> Column:
    """``text`` with spaces in place of the matches, so that positions stay."""

    def put(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        blank = F.concat(F.transform(found, lambda m: F.repeat(F.lit(" "), F.length(m))), F.array(F.lit("")))
        return F.array_join(F.zip_with(between, blank, lambda a, b: F.concat(a, b)), "")

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), put)


def _ratio(token: Column, table: Column) -> Column:
    steps = pairs(F.split(token, ""), lambda a, b: F.element_at(table, F.ascii(a) * 128 + F.ascii(b) + 1))
    return F.aggregate(steps, F.lit(0.0), lambda a, b: a + b)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def scan(docs: DataFrame, table: list[float] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans (start, order, end, kind), row (as it was) of each text."""
    matched = base_matches(docs, doc_id, text)
    table = table or train(matched)
    ratios = F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")
    t = F.col("text")
    base = F.concat(_spans(F.col("assign"), "assign"), _spans(F.col("access"), "access"), _spans(F.col("hex"), "hex"))
    df = matched.select(
        "doc_id",
        "row",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        base.alias("base"),
        F.when(F.size("assign") + F.size("access") + F.size("hex") > 0, _blanked(_blanked(_blanked(t, ASSIGN), ACCESS), HEX)).otherwise(t).alias("rest"),
    )
    tokens = F.when(F.col("rest").rlike(TOKEN), _matches(F.col("rest"), TOKEN)).otherwise(_none())
    df = df.select("doc_id", "row", "n_assign", "n_access", "n_hex", "base", F.filter(tokens, lambda m: m["match"].rlike("[A-Za-z]")).alias("tokens"))
    odd = F.filter("tokens", lambda m: let(_ratio(m["match"], ratios), lambda r: (r >= LEAST_RATIO) & (r >= LEAST_MEAN * (F.length(m["match"]) - 1))))
    df = df.withColumn("markov", odd)
    return df.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.size("markov").cast("long").alias("n_markov"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        F.array_sort(F.concat("base", _spans(F.col("markov"), "markov"))).alias("spans"),
        "row",
    )


def listed(spans: str = "spans") -> Column:
    """Spans as kind:start:end, joined by commas."""
    return _listed(F.col(spans))


def redacted(docs: DataFrame, table: list[float] | None = None, doc_id: str = "doc_id", text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with ``mark`` in place of each span, and of spans that overlap."""
    whole = F.col("text")

    def cut(spans: Column) -> Column:
        def between(ends: Column) -> Column:
            before = F.concat(F.array(F.lit(0).cast("long")), F.slice(ends, F.lit(1), F.size(ends) - 1))
            kept = F.zip_with(spans, before, lambda s, p: F.when(s["start"] >= p, F.concat(F.substr(whole, (p + 1).cast("int"), (s["start"] - p).cast("int")), F.lit(mark))).otherwise(F.lit("")))
            return F.concat(F.array_join(kept, ""), F.substr(whole, (F.element_at(ends, -1) + 1).cast("int")))

        return let(running_max(F.transform(spans, lambda s: s["end"])), between)

    found = scan(docs, table, doc_id, text).select("row", "spans", F.col(f"row.{text}").alias("text"))
    found = found.withColumn("clean", F.when(F.size("spans") > 0, cut(F.col("spans"))).otherwise(whole))
    return found.select(*(F.col("clean").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns))
