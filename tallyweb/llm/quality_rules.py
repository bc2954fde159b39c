"""Quality rules as a ledger: every rule is evaluated once and leaves one failure bit
and its measurement; versioned policies are bit masks over the ledger, and ablations are
sums over the few distinct bit patterns.

DataFrame functions only. One pass over the table without a shuffle: all counts of a
text are computed inside its row, so copies and hot sources cost nothing extra.

Defined cases: a null text has no words (it fails the word count); an empty table gives
an empty ledger; repeated rows are judged one by one; columns of the input that clash
with names made here are ignored, since only the id and the text are read. The repeat
count of a text of n words takes O(n log n) time and O(n) memory in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import BLANKS, store, words

#: Rules in bit order. "True" is failure; null never occurs.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "shouting": "2 * n_bangs > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Versions of the policy; a document is kept if no rule of the mask failed.
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["shouting"],
    "v2": sum(BIT.values()),
}
CURRENT = "v2"


def measure(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: bool = False) -> DataFrame:
    """doc_id and the measurements of every document; carry: also the struct _row of all input columns.

    Repeated windows: each 3-word window becomes one long, its hash above its position
    (as many low bits as the text's word count needs), so that a primitive sort brings
    equal windows together and neighbours show which positions repeat. A text of n words
    leaves 64 - log2(n) bits for the hash: some 1e-11 chance of one wrong window at 600 words.
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    own = [F.struct(*[docs[c] for c in docs.columns]).alias("_row")] if carry else []
    df = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"), *own)
    kept = ["doc_id", "_row"] if carry else ["doc_id"]
    df = df.select(
        *kept,
        words(F.col("_text")).alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_lines"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
    )
    df = df.select(
        *kept,
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
        F.size("_w").cast("long").alias("n_words"),
        F.expr("CAST(ceil(log2(size(_w) + 1)) AS INT)").alias("_low"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_bangs",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    rest = [*kept, "n_words", "word_chars", "n_symbols", "n_bangs", "n_lines", "n_dup_lines"]
    df = df.select(
        *rest,
        "_low",
        F.expr(
            """sort_array(transform(slice(_h, 1, greatest(size(_h) - 2, 0)), (x, i) ->
            shiftleft(xxhash64(x, get(_h, i + 1), get(_h, i + 2)), _low) + i))"""
        ).alias("_s"),
    )
    found = F.expr(
        """transform(filter(_s, (x, i) -> shiftright(x, _low) = shiftright(get(_s, i - 1), _low) OR shiftright(x, _low) = shiftright(get(_s, i + 1), _low)),
        x -> x & (shiftleft(1L, _low) - 1L))"""
    )
    df = df.select(*rest, found.alias("_found"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_found", lambda x: F.array(x, x + 1, x + 2)))))
    return df.select(*rest, covered.cast("long").alias("n_repeat_words"))


def _failed_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Measurements and failed_bits (a bit for each rule of RULES that failed), stored as a table.

    Policies read the table: a filter on it must not be pushed into the rules, which
    would then be evaluated once for every reference.
    """
    return store(measure(docs, text, doc_id).withColumn("failed_bits", _failed_bits()), "ledger")


def judge(marks: DataFrame, policy: str | int = CURRENT) -> DataFrame:
    """The ledger with base_failed and kept under a policy (its name or a mask)."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return marks.withColumn("base_failed", F.col("failed_bits").bitwiseAND(F.lit(BASE)) != 0).withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(mask | BASE)) == 0)


def ablation(marks: DataFrame) -> DataFrame:
    """For each policy and each of its rules: rows the rule fails, fails alone, and rows kept without it.

    The ledger shrinks to its distinct bit patterns (2^rules at most) before the policies are applied.
    """
    patterns = marks.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = [(version, rule, mask, BIT[rule]) for version, mask in POLICIES.items() for rule in RULES if mask & BIT[rule]]
    each = patterns.withColumn("case", F.explode(F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit")) for v, r, m, b in cases])))
    hit = F.col("failed_bits").bitwiseAND(F.col("case.mask"))
    return each.groupBy(F.col("case.policy").alias("policy"), F.col("case.rule").alias("rule")).agg(
        F.sum(F.when(hit.bitwiseAND(F.col("case.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("case.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(hit.bitwiseAND(F.bitwise_not(F.col("case.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def keep_rows(docs: DataFrame, policy: str | int = CURRENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of docs that a policy keeps, with all their columns, in one pass without a join."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    marked = measure(docs, text, doc_id, carry=True).withColumn("failed_bits", _failed_bits())
    # A filter would be pushed below the rules and copy them into itself, once for every reference. One on what an
    # outer generator makes isn't pushed, nor is another derived from it.
    judged = marked.select("_row", (F.col("failed_bits").bitwiseAND(F.lit(mask | BASE)) == 0).alias("_kept"))
    once = judged.select("_row", F.explode_outer(F.when(F.col("_kept"), F.array(F.lit(0)))).alias("_one")).where("_one IS NOT NULL")
    return once.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
