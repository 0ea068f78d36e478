"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one long with a
bit per failed rule.  Policies are versioned masks over that ledger, so a new policy or an
ablation ("what if this rule were off?") needs bit operations on stored longs and never reads a
text again.  Bits are stable: a retired rule keeps its bit, a new rule takes the next free one.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name
from tessera.llm.measures import NAMES, measures


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str  # SQL condition over the measurements


#: Ratios are written as integer comparisons, so that nothing rounds.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "upper_case", "100 * n_upper > 30 * word_chars"),
    Rule(5, "exclamations", "100 * n_exclaim > 20 * n_words"),
    Rule(6, "digits", "100 * n_digits > 40 * word_chars"),
    Rule(7, "short_words", "10 * word_chars < 25 * n_words"),
    Rule(8, "long_words", "word_chars > 14 * n_words"),
    Rule(9, "few_distinct_words", "n_words >= 100 AND 100 * n_distinct_words < 8 * n_words"),
    Rule(10, "word_run", "n_words >= 50 AND 100 * longest_run > 10 * n_words AND longest_run >= 10"),
    Rule(11, "no_text", "n_words = 0"),
)
#: Policy versions: the rules that reject.  Versions are never edited, only added.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    3: ("few_words", "repeated_windows", "symbols", "duplicate_lines", "upper_case", "exclamations", "digits",
        "short_words", "long_words", "few_distinct_words", "word_run", "no_text"),
}
CURRENT = 3
BASE = ("few_words", "repeated_windows")


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << r.bit for r in rules}
    return sum({bits[n] for n in names})


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` without its text, with a column for each measurement and fail_bits (long).

    Row by row: null ids and repeated rows stay; a null or empty text measures 0 everywhere and
    fails few_words and no_text.  Columns named like a measurement are replaced."""
    own = {c.lower() for c in (*NAMES, "fail_bits", "text")}
    keep = [c for c in docs.columns if c.lower() not in own]
    at = free_name(docs, "__m")
    m = docs.select(*[F.col(f"`{c}`") for c in keep], measures().alias(at))
    flat = m.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"{at}.{n}").alias(n) for n in NAMES])
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return flat.withColumn("fail_bits", bits)


def passes(version: int = CURRENT, bits: Column | str = "fail_bits") -> Column:
    """Verdict of a policy version over stored failure bits."""
    col = F.col(bits) if isinstance(bits, str) else bits
    return col.bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")) == 0


def ablation(led: DataFrame, version: int = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule of a policy: documents and words that fail it, that fail it alone, and
    that the policy would keep without it.  The ledger is first reduced to one row per distinct
    failure pattern (map-side), all else is bit operations on those rows.  Repeated rows count each, null
    ids like others; an empty ledger gives an empty result; extra columns are ignored."""
    full = mask(POLICIES[version])
    patterns = led.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_words").alias("words"))
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                      for r in rules if r.name in POLICIES[version]])
    each = patterns.select("*", F.explode(names).alias("r")).select("fail_bits", "docs", "words", "r.rule", "r.bit")
    hit = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    inside = F.col("fail_bits").bitwiseAND(F.lit(full).cast("long"))
    alone = inside == F.col("bit")
    kept = inside.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    total = lambda cond, what: F.coalesce(F.sum(F.when(cond, F.col(what))), F.lit(0))
    return each.groupBy("rule").agg(
        total(hit, "docs").alias("failing"), total(alone, "docs").alias("failing_alone"),
        total(kept, "docs").alias("kept_without"), total(kept, "words").alias("words_kept_without"))


def quality_ledger(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """Ledger with the verdicts: base_failed (the two base rules) and kept (not base_failed and
    the policy's verdict)."""
    led = ledger(docs)
    base = F.col("fail_bits").bitwiseAND(F.lit(mask(BASE)).cast("long")) != 0
    return led.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & passes(version))
