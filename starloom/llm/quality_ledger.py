"""Quality rules as a ledger: every rule is evaluated once, policies and ablations read its bits.

``ledger`` measures each text and stores the measurements and one failure bit for each rule.  A policy is a version and
a mask of the rules that count; ``apply_policy`` is one bitwise and, and each verdict names the policies that keep a text.  ``ablations`` reduces the ledger to its distinct
bit patterns (2 ** rules at most) and asks of each policy and each of its rules what would change without the rule.
All of it is column expressions; nothing is shuffled but the counts of patterns.

Repeated three-word windows are told by 64-bit hashes of their words within one text.

Defined cases: null and empty texts have no words and fail ``few_words``; repeated rows stay; other columns are ignored;
an empty table gives an empty ledger, and ablations with counts of 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.natively import SPACES, count_of, pairs, words
from starloom.llm.runtime import stage

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rules by bit, as conditions on the measurements under which a text fails.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "capitals": "10 * n_capitals > 3 * word_chars",
    "exclamations": "2 * n_exclamations > n_words",
    "long_words": "word_chars > 20 * n_words",
}
BASE_RULES = ("few_words", "repeated_words")


def mask(*rules: str) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


@dataclass(frozen=True)
class Policy:
    version: str
    mask: int


POLICIES = (Policy("base", mask(*BASE_RULES)), Policy("lines", mask(*BASE_RULES, "repeated_lines")), Policy("strict", mask(*RULES)))
DEFAULT = POLICIES[-1]


def measurements(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts of each text."""
    t = F.col("text")
    df = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = df.withColumn("words", F.transform(words(t), lambda w: F.xxhash64(w)))
    df = df.withColumn("lines", F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != ""))
    df = df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        count_of(t, SYMBOLS).alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        count_of(t, CAPITALS).alias("n_capitals"),
        count_of(t, "!?").alias("n_exclamations"),
        _triples(F.col("words")).alias("triples"),
    )
    return df.withColumn("n_repeat_words", _covered(df)).drop("triples")


def _triples(hashes: Column) -> Column:
    short = F.greatest(F.size(hashes) - 2, F.lit(0))
    return F.zip_with(pairs(hashes, lambda a, b: F.xxhash64(a, b)), F.slice(hashes, F.lit(3), short), lambda ab, c: F.xxhash64(ab, c))


def _covered(df: DataFrame) -> Column:
    """Words under the triples that stand twice or more: equal ones are neighbours once they are sorted."""
    triples = F.col("triples")
    # a word more than pairs() gives: the last triple has no third word and is null
    whole = F.slice(triples, F.lit(1), F.greatest(F.size(triples) - 1, F.lit(0)))

    def positions(in_order: Column) -> Column:
        return let_equal(pairs(in_order, lambda a, b: a.h == b.h), in_order)

    def let_equal(equal: Column, in_order: Column) -> Column:
        none = F.array(F.lit(False))
        twice = F.zip_with(F.concat(none, equal), F.concat(equal, none), lambda a, b: a | b)
        found = F.filter(F.zip_with(in_order, twice, lambda s, yes: F.when(yes, s.i)), lambda i: i.isNotNull())
        return F.sort_array(found)

    def covered(at: Column) -> Column:
        gaps = pairs(at, lambda a, b: F.least(b - a, F.lit(3)).cast("long"))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b) + F.when(F.size(at) > 0, 3).otherwise(0)

    from starloom.llm.natively import let

    sorted_ = F.array_sort(F.transform(whole, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(whole)) < F.size(whole)
    return F.when(repeats, let(sorted_, lambda s: let(positions(s), covered))).otherwise(F.lit(0)).cast("long")


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements of each text and ``failed``, the bits of the rules that it fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measurements(docs, doc_id, text).withColumn("failed", total.cast("long"))


def apply_policy(entries: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Ledger entries with the policy's version, the bits that count, and the verdict."""
    counted = F.col("failed").bitwiseAND(F.lit(policy.mask))
    return entries.withColumns({"policy": F.lit(policy.version), "counted": counted, "kept": counted == 0})


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """policy, rule, n_failed, n_only (fail nothing else), n_kept, n_kept_without (the rule), for each policy and rule."""
    patterns = entries.groupBy("failed").agg(F.count("*").alias("n"))
    questions = [
        F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"), F.lit(p.mask).alias("mask"), F.lit(1 << k).alias("bit"))
        for p in policies
        for k, name in enumerate(RULES)
        if p.mask >> k & 1
    ]
    asked = patterns.select("failed", "n", F.explode(F.array(*questions)).alias("q")).select("failed", "n", "q.*")
    counted = F.col("failed").bitwiseAND(F.col("mask"))
    other = counted.bitwiseAND(F.bitwise_not("bit"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias
    return asked.groupBy("policy", "rule").agg(
        total(counted.bitwiseAND(F.col("bit")) != 0)("n_failed"), total(counted == F.col("bit"))("n_only"), total(counted == 0)("n_kept"), total(other == 0)("n_kept_without")
    )


def sole_rule(policy: Policy = DEFAULT) -> Column:
    """The rule that alone rejects a text of ``apply_policy``, null if none or several do."""
    return F.coalesce(*[F.when(F.col("counted") == 1 << k, F.lit(name)) for k, name in enumerate(RULES) if policy.mask >> k & 1])


def kept_by(policies: tuple[Policy, ...] = POLICIES) -> Column:
    """The versions of the policies that keep a text, joined by commas."""
    return F.concat_ws(",", *[F.when(F.col("failed").bitwiseAND(F.lit(p.mask)) == 0, F.lit(p.version)) for p in policies])


def verdicts(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The ledger of ``docs``, written once, under a policy, with the ablation of the rule that decides a text.

    ``sole_rule`` is the rule that alone rejects the text (null: none, or several); ``n_only`` counts the texts that this
    rule alone rejects, ``n_kept_without`` those that the policy would keep without it.
    """
    entries = stage(ledger(docs), "quality-ledger")
    judged = apply_policy(entries, policy).withColumns(
        {"base_failed": F.col("failed").bitwiseAND(F.lit(mask(*BASE_RULES))) != 0, "kept_by": kept_by(), "sole_rule": sole_rule(policy)}
    )
    # one row a rule
    without = ablations(entries, (policy,)).select(F.col("rule").alias("sole_rule"), "n_only", "n_kept_without")
    return judged.join(F.broadcast(without), "sole_rule", "left")
