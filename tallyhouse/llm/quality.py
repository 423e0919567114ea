"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule;
a policy is a named, versioned mask over those bits, so verdicts under any policy, and what each rule adds to a
policy, come from the stored ledger by bitwise operations, without the texts.

Defined results: a null text counts as empty, an empty text fails `short`; equal rows give equal rows; an empty
table gives an empty ledger (and ablations of zero documents); columns other than the two named ones are ignored, or
kept unchanged by `keep`. Two different 3-word windows of one document are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.words import let, words

#: Up to so many words, a window's place fits into the low bits of a packed sort key.
PLACE_BITS = 24


def _covered(places: Column) -> Column:
    """Words in the 3-word windows that start at these ascending places."""

    def step(state: Column, place: Column) -> Column:
        added = F.least(F.lit(3), place - state["last"])
        return F.struct((state["n"] + added).alias("n"), place.alias("last"))

    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    return F.aggregate(places, start, step, lambda s: s["n"].cast("long"))


def _beside_equal(keys: Column, same) -> Column:
    """Those of a sorted array's elements that equal a neighbour."""
    n = F.size(keys)
    return F.filter(
        keys,
        lambda x, j: ((j > 0) & same(F.get(keys, j - 1), x)) | ((j < n - 1) & same(F.get(keys, j + 1), x)),
    )


def _repeated_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    A sort of longs (high bits: hash, low bits: place) finds the few windows that may repeat; only those are sorted by
    their whole hash. A text too long for the packed key skips the first sort.
    """
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    low = (1 << PLACE_BITS) - 1

    def maybe(w_starts: Column) -> Column:
        packed = F.sort_array(F.transform(w_starts, lambda i: window(i).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        twins = let(packed, lambda p: _beside_equal(p, lambda a, b: F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)))
        return F.transform(twins, lambda x: x.bitwiseAND(F.lit(low)).cast("int"))

    def exact(places: Column) -> Column:
        keys = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("i"))))
        twins = let(keys, lambda p: _beside_equal(p, lambda a, b: a["h"] == b["h"]))
        return F.sort_array(F.transform(twins, lambda x: x["i"]))

    candidates = let(starts, lambda s: F.when(F.size(s) <= low, maybe(s)).otherwise(s))
    return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(_covered(exact(candidates)))


def measurements(text: Column) -> Column:
    """Struct of what the rules look at."""
    given = F.coalesce(text, F.lit(""))

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(given, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(F.regexp_replace(given, r"[^#*$%&|<>]++", "")).cast("long")
    return let(
        words(text),
        lambda w: let(
            let(lines, of_lines),
            lambda of: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                symbols.alias("n_symbols"),
                of["n_dup_lines"].alias("n_dup_lines"),
                _repeated_words(w).alias("n_repeat_words"),
                of["n_lines"].alias("n_lines"),
            ),
        ),
    )


@dataclass(frozen=True)
class Rule:
    """A name, its bit in the ledger and the measured condition under which a document fails it."""

    name: str
    bit: int
    fails: Callable[[Column], Column]


RULES = (
    Rule("short", 0, lambda m: m["n_words"] < 50),
    Rule("repeated_windows", 1, lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", 2, lambda m: 2 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", 3, lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    Rule("word_length_low", 4, lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("word_length_high", 5, lambda m: m["word_chars"] > 20 * m["n_words"]),
)


@dataclass(frozen=True)
class Policy:
    """A version of a verdict: a document is rejected if it fails any of the named rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        return sum(1 << r.bit for r in rules if r.name in self.rules)


BASE = Policy("base", 1, ("short", "repeated_windows"))
STANDARD = Policy("standard", 1, tuple(r.name for r in RULES))


def _bits(m: Column, rules: tuple[Rule, ...]) -> Column:
    """Failure bits of a measurement struct."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(m), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, every measurement, `fail_bits`."""
    full = let(measurements(F.col("text")), lambda m: F.struct(m.alias("m"), _bits(m, rules).alias("fail_bits")))
    rows = docs.select("doc_id", full.alias("q"))
    return rows.select("doc_id", "q.m.*", "q.fail_bits")


def verdict(ledger_rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES, name: str = "kept") -> DataFrame:
    """The ledger with a boolean column: does the document pass this policy?"""
    return ledger_rows.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules))) == 0)


def ablations(ledger_rows: DataFrame, policies: tuple[Policy, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule does to each policy, from the bits alone, in one aggregation.

    policy, version, rule, n_docs, n_rejected (by the policy), n_failing (the rule), n_only (rejected by this rule and
    no other of the policy: what leaving it out would bring back). Rows: every rule of every policy.
    """
    masks = [(p, r, p.mask(rules), 1 << r.bit) for p in policies for r in rules if r.name in p.rules]
    bits = F.col("fail_bits")
    rows = ledger_rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    each = [
        F.struct(
            F.lit(p.name).alias("policy"),
            F.lit(p.version).alias("version"),
            F.lit(r.name).alias("rule"),
            total(F.lit(True)).alias("n_docs"),
            total(bits.bitwiseAND(F.lit(mask)) != 0).alias("n_rejected"),
            total(bits.bitwiseAND(F.lit(bit)) != 0).alias("n_failing"),
            total(bits.bitwiseAND(F.lit(mask)) == bit).alias("n_only"),
        )
        for p, r, mask, bit in masks
    ]
    return rows.agg(F.array(*each).alias("each")).select(F.inline("each"))


def keep(docs: DataFrame, policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass a policy, with all their columns."""
    bits = let(measurements(F.col("text")), lambda m: _bits(m, rules))
    return docs.filter(bits.bitwiseAND(F.lit(policy.mask(rules))) == 0)
