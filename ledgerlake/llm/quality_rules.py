"""Operator 4: host-level quality rules, DataFrame functions only.

Every document gets counts and rule flags inside its own row (no shuffle of
text).  Rule failures are summed per host with map-side combine, the hosts'
failure rates are shrunk towards the corpus rate by a beta prior fitted to all
hosts (moments of the beta-binomial), and the verdict is joined back on the
host:

* ``pass``    shrunk rate up to ``suspect_rate``: only the base rule rejects;
* ``suspect`` above it: the host's documents that fail any rule go too;
* ``reject``  above ``reject_rate``: all of the host's documents go.

Defined cases: NULL text counts as empty (it fails the base rule); a NULL
source belongs to no host, so only the base rule applies; repeated rows count
once each; with no host at all, or no over-dispersion between hosts, every
host gets the corpus rate; an empty table gives an empty result.  Only
``doc_id``, ``text`` and ``source`` are read; other columns never interfere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_PATTERN, staged

STAT_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class HostRules:
    """Thresholds of the document rules and of the host verdicts."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_per_100_words: int = 50
    max_dup_line_pct: int = 30
    min_mean_word: float = 2.0
    max_mean_word: float = 15.0
    suspect_rate: float = 0.5
    reject_rate: float = 0.9
    max_strength: float = 1e6


def _repeat_words(hashes: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs at least twice.

    Sorting (hash, position) puts equal windows side by side; the covered
    length of the marked positions is the sum of min(3, distance to the one
    before).  O(n log n) for any text.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(ps: Column) -> Column:
        marked = F.filter(
            F.transform(
                ps,
                lambda p, k: F.when(
                    (F.get(ps, k - 1)["h"] == p["h"]) | (F.get(ps, k + 1)["h"] == p["h"]), p["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return F.aggregate(
            F.sort_array(marked),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    # the one-element transform names the sorted array, so it is computed once
    return F.get(F.transform(F.array(pairs), covered), F.lit(0))


def document_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus the counts of each whole text, computed in the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(
        *keep,
        text.alias("_t"),
        F.array_remove(F.split(text, SPACE_PATTERN), "").alias("_w"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
    )
    # the words and their two shifted copies side by side: a lambda that named the word
    # array itself would have it split again for every word, should a plan inline it
    n = F.greatest(F.size("_w") - 2, F.lit(0))
    pairs = F.zip_with(F.slice("_w", 1, n), F.slice("_w", 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    grams = F.zip_with(pairs, F.slice("_w", 3, n), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    df = df.select(*keep, "_t", "_w", "_l", grams.alias("_h"))
    return df.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col("_t"), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_lines"),
        F.when(F.size(F.array_distinct("_h")) == F.size("_h"), F.lit(0).cast("long"))
        .otherwise(_repeat_words(F.col("_h")))
        .alias("n_repeat_words"),
    )


def rule_flags(stats: DataFrame, rules: HostRules) -> DataFrame:
    """Add ``base_failed`` and ``any_failed``."""
    n, mean = F.col("n_words"), F.col("word_chars") / F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * n)
    soft = (
        (100 * F.col("n_symbols") > rules.max_symbols_per_100_words * n)
        | (100 * F.col("n_dup_lines") > rules.max_dup_line_pct * F.col("n_lines"))
        | (mean < rules.min_mean_word)
        | (mean > rules.max_mean_word)
    )
    return stats.withColumn("base_failed", base).withColumn(
        "any_failed", F.when(base, True).otherwise(F.coalesce(soft, F.lit(False)))
    )


def host_verdicts(flags: DataFrame, rules: HostRules) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk), verdict; one row per host."""
    hosts = staged(
        flags.filter(F.col("source").isNotNull())
        .groupBy(F.col("source").alias("host"))
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("any_failed").cast("long")).alias("n_failed")),
        "op4-hosts",
    )
    # one row for the whole corpus
    t = hosts.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("q"),
        F.sum(1 / F.col("n_docs")).alias("inv"),
    ).first()
    mean, strength = 0.0, rules.max_strength
    if t["k"]:
        mean = t["f"] / t["n"]
        var = mean * (1 - mean)
        if t["k"] > 1 and var > 0:
            spread = t["k"] * (t["q"] - t["n"] * mean * mean) / ((t["k"] - 1) * t["n"])
            excess = spread - var * t["inv"] / t["k"]
            if excess > 0:
                strength = min(rules.max_strength, max(0.0, (var - spread) / excess))
    rate = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("host_rate", rate).withColumn(
        "verdict",
        F.when(rate > rules.reject_rate, "reject").when(rate > rules.suspect_rate, "suspect").otherwise("pass"),
    )


def judge(flags: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Join the host verdicts back and add ``kept``."""
    v = verdicts.select(F.col("host").alias("source"), "host_rate", F.col("verdict").alias("host_verdict"))
    verdict = F.coalesce(F.col("host_verdict"), F.lit("none"))
    kept = ~F.col("base_failed") & (
        F.when(verdict == "reject", False).when(verdict == "suspect", ~F.col("any_failed")).otherwise(True)
    )
    return flags.join(v, "source", "left").withColumn("host_verdict", verdict).withColumn("kept", kept)


def assess(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """Counts, flags, host rate, host verdict and ``kept`` of every document."""
    flags = staged(rule_flags(document_stats(docs, ["doc_id", "source"]), rules), "op4-stats")
    return judge(flags, host_verdicts(flags, rules))


def keep_good(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns unchanged.

    Rows and flags are written once: the hosts' counts and the filter read them
    there, and no filter on a flag can be pushed below the counting of words.
    """
    row = docs.select(F.struct(*docs.columns).alias("_row"), "text", "source")
    flags = staged(rule_flags(document_stats(row, ["_row", "source"]), rules), "op4-rows")
    judged = judge(flags, host_verdicts(flags.select("source", "any_failed"), rules))
    return judged.filter("kept").select("_row.*")
