"""Quality rules judged by document and by host.

Each rule fails or passes a document. A host's failure rate under a rule is
shrunk towards all hosts' by a beta prior fitted to the hosts by moments, so a
host with few documents is not condemned by chance. A host is rejected when its
shrunk rate lies above the rule's limit by more than ``margin`` posterior
standard deviations; its documents then go, however good each may look.

Counting is an expression on each row, without a shuffle; hosts are summed in
the map tasks first, so a host with a third of all rows is no hot key; the
verdicts are written, and joined back as a broadcast only if their measured size
allows it.

Defined results: a null text has no words and fails for being short; a null host
is no host, so its documents are judged by themselves; repeated rows count and
are judged one by one; columns of ``docs`` named like a count are replaced; an
empty table gives an empty one. Windows are told apart by a 64-bit hash of their
words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import NOT_WORD, WORD, materialize, words_of

SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` of a counted document; a host is rejected when its shrunk failure rate exceeds ``limit``."""

    name: str
    fails: Column
    limit: float


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def production_rules() -> list[Rule]:
    return [
        Rule("base", base_failed(), 0.8),
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words"), 0.8),
        Rule("lines", F.col("n_dup_lines") * 5 > F.col("n_words"), 0.8),
    ]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once wherever the optimiser moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words in windows of three that occur more than once."""
    n = F.size(words)
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
        ),
    )

    def places(ordered: Column) -> Column:
        same = lambda w, k: F.coalesce(F.get(ordered, k)["h"] == w["h"], F.lit(False))
        twice = F.filter(ordered, lambda w, k: same(w, k - 1) | same(w, k + 1))
        return F.sort_array(F.transform(twice, lambda w: w["i"]))

    def covered(at: Column) -> Column:
        # a window covers three words, or fewer where the next one begins earlier
        own = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.coalesce(_let(_let(F.sort_array(windows), places), covered), F.lit(0).cast("long"))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.withColumns(
        {
            "n_words": F.regexp_count(whole, F.lit(WORD)).cast("long"),
            "word_chars": F.char_length(F.regexp_replace(whole, NOT_WORD, "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": _let(words_of(F.col(text)), _repeated_words),
        }
    )


def host_rates(counted: DataFrame, host: str, rules: list[Rule]) -> DataFrame:
    """A row per host: documents, failures of each rule, shrunk rate and its standard deviation."""
    by_host = counted.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
    sums = by_host.agg(
        F.count("*").alias("n"), *[F.sum(F.when(r.fails, 1).otherwise(0)).alias(f"{r.name}_failed") for r in rules]
    )
    sums = materialize(sums, "hosts")
    moments = []
    for r in rules:
        rate = F.col(f"{r.name}_failed") / F.col("n")
        moments += [
            (F.sum(f"{r.name}_failed") / F.sum("n")).alias(f"{r.name}_mean"),
            F.var_samp(rate).alias(f"{r.name}_var"),
        ]
    fitted = sums.agg(*moments).first()
    out = sums
    for r in rules:
        mean, var = (F.lit(fitted[f"{r.name}_{m}"]).cast("double") for m in ("mean", "var"))
        # prior weight in documents: between one and a thousand, a thousand where the hosts don't differ
        fit = F.coalesce(F.try_divide(mean * (1 - mean), var) - 1, F.lit(1000.0))
        weight = F.greatest(F.lit(1.0), F.least(F.lit(1000.0), fit))
        a = F.col(f"{r.name}_failed") + mean * weight
        b = F.col("n") - F.col(f"{r.name}_failed") + (1 - mean) * weight
        out = out.withColumn(f"{r.name}_rate", a / (a + b)).withColumn(
            f"{r.name}_sd", F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
        )
    return out.select("host", "n", *[f"{r.name}_{c}" for r in rules for c in ("failed", "rate", "sd")])


def rejected_hosts(rates: DataFrame, rules: list[Rule], margin: float = 2.0) -> DataFrame:
    """Hosts of which some rule's shrunk rate lies beyond its limit."""
    bad = F.lit(False)
    for r in rules:
        bad = bad | (F.col(f"{r.name}_rate") - margin * F.col(f"{r.name}_sd") > r.limit)
    return rates.filter(bad).select("host")


def judge(counted: DataFrame, host: str, rejected: DataFrame) -> DataFrame:
    """``counted`` with base_failed and kept; ``rejected`` is a written table of hosts."""
    marked = rejected.select(F.col("host").alias("_host"), F.lit(True).alias("_bad"))
    return (
        counted.join(marked, F.col(host) == F.col("_host"), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.col("_bad").isNull())
        .drop("_host", "_bad")
    )


def judge_documents(docs: DataFrame, text: str = "text", host: str = "source", margin: float = 2.0) -> DataFrame:
    """``docs`` with their counts, base_failed and kept."""
    rules = production_rules()
    # counted twice, for the hosts and for the verdicts: writing the texts with their counts takes their size in disk
    counted = with_counts(docs, text)
    rejected = materialize(rejected_hosts(host_rates(counted, host, rules), rules, margin), "rejected-hosts")
    return judge(counted, host, rejected)
