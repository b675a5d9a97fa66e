"""Host-level quality rules, in DataFrame functions only.

Each document is measured once. Rule failures are counted per host (the source column), the
failure rate of every host and rule is shrunk towards the corpus with a beta prior fitted to the
hosts' rates by moments, and hosts whose shrunk rate passes a limit are refused as a whole.

Defined cases: a null or empty text has no words and fails the base rules; a document without a
host is judged by the base rules alone; an empty table gives an empty result; repeated rows are
judged row by row. Columns of the input other than id, text and host are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.state.shared import shared_root, stage

WHITE = "\t\n\x0b\x0c\r"  # with the space itself: what separates words
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A rule fails beyond its limit; a host is refused when a shrunk failure rate passes ``host_rate``."""

    min_words: int = 50
    repeat_percent: int = 50
    symbols_per_100_words: int = 10
    dup_lines: int = 30
    min_word_chars: int = 2
    max_word_chars: int = 15
    host_rate: float = 0.5


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a lambda variable is never inlined)."""
    return F.transform(F.array(value), body)[0]


def _repeated_positions(words: Column) -> Column:
    """How many word positions lie in a three-word window that the text holds twice or more.

    Sorting brings equal windows side by side, so the work is n log n in the text's own length. A
    hash stands in front of a window's words, so that words are only compared where hashes agree.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"),
            words[i].alias("a"), words[i + 1].alias("b"), words[i + 2].alias("c"), i.alias("p"),
        ),
    )

    def covered(s: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            x, y = F.get(s, i), F.get(s, j)
            equal = (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
            return F.coalesce(equal, F.lit(False))

        twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        spans = F.transform(twice, lambda j: _let(s[j]["p"], lambda p: F.array(p, p + 1, p + 2)))
        return F.size(F.array_distinct(F.flatten(spans)))

    return F.when(F.size(words) >= 4, _let(F.sort_array(windows), covered)).otherwise(0)


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """id, host and the base counts of every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")
    solid = F.translate(text, WHITE + " ", "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, WHITE + " ", "") != "")
    counted = _let(
        words,
        lambda w: F.struct(F.size(w).alias("n_words"), _repeated_positions(w).alias("n_repeat_words")),
    )
    line_counts = _let(
        lines,
        lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")),
    )
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(host_col).alias("host"),
            counted.alias("c"),
            line_counts.alias("l"),
            F.length(solid).alias("word_chars"),
            (F.length(solid) - F.length(F.translate(solid, SYMBOLS, ""))).alias("n_symbols"),
        )
        .select("doc_id", "host", "c.*", "l.*", "word_chars", "n_symbols")
        .select("doc_id", "host", *[F.col(c).cast("long").alias(c) for c in COUNTS])
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def rules(limits: Limits) -> dict[str, Column]:
    """Rule name -> whether a measured document fails it. The first two are the base rules."""
    n = F.col("n_words")
    return {
        "few_words": n < limits.min_words,
        "repeats": 100 * F.col("n_repeat_words") > limits.repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > limits.symbols_per_100_words * n,
        "dup_lines": 100 * F.col("n_dup_lines") > limits.dup_lines * F.col("n_lines"),
        "word_length": (F.col("word_chars") < limits.min_word_chars * n)
        | (F.col("word_chars") > limits.max_word_chars * n),
    }


BASE = ["few_words", "repeats"]


def host_rates(measured: DataFrame, folder: str, limits: Limits) -> DataFrame:
    """One row per host: documents, failures and shrunk failure rate of every rule.

    The prior has the mean of the corpus and the variance between hosts that the binomial noise
    does not explain. Its parameters are a handful of sums, the only values brought to the driver.
    """
    failed = rules(limits)
    hosts = stage(
        measured.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), *[F.count_if(fails).alias(f"f_{name}") for name, fails in failed.items()]),
        f"{folder}/hosts",
    )
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("n"),
        *[F.sum(f"f_{name}").alias(f"f_{name}") for name in failed],
        *[F.sum(F.col(f"f_{name}") * F.col(f"f_{name}") / F.col("n")).alias(f"q_{name}") for name in failed],
    ).first()
    rates = []
    for name in failed:
        alpha, beta = beta_prior(sums["hosts"], sums["n"] or 0, sums[f"f_{name}"] or 0, sums[f"q_{name}"] or 0.0)
        rate = (F.col(f"f_{name}") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
        rates.append(rate.alias(f"rate_{name}"))
    return hosts.select("*", *rates)


def beta_prior(hosts: int, n: int, failures: int, squares: float) -> tuple[float, float]:
    """(alpha, beta) by moments; ``squares`` is the sum of failures^2 / documents over hosts.

    Strength is kept between 1 and 1000 pseudo-documents, so that equal hosts do not make it
    infinite and wild ones do not make it vanish.
    """
    if n == 0:
        return 0.5, 0.5
    mean = failures / n
    spread = mean * (1 - mean)
    if spread == 0:
        return mean + 1e-3, 1 - mean + 1e-3
    between = squares / n - mean * mean - spread * hosts / n
    strength = min(1000.0, max(1.0, spread / between - 1)) if between > 0 else 1000.0
    return mean * strength, (1 - mean) * strength


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """The measures of every document with ``base_failed``, ``host_blocked`` and ``kept``."""
    folder = shared_root(docs.sparkSession)
    measured = stage(measure(docs, id_col, text_col, host_col), f"{folder}/measured")
    rates = host_rates(measured, folder, limits)
    failed = rules(limits)
    bad = [F.col(f"rate_{name}") > F.lit(limits.host_rate) for name in failed]
    any_bad = bad[0]
    for other in bad[1:]:
        any_bad = any_bad | other
    # a small written table: broadcast only where Spark sees that it is small
    blocked = stage(rates.filter(any_bad).select("host", F.lit(True).alias("host_blocked")), f"{folder}/blocked")
    base = failed[BASE[0]] | failed[BASE[1]]
    return (
        measured.join(blocked, "host", "left")
        .withColumn("host_blocked", F.coalesce("host_blocked", F.lit(False)))
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_blocked"))
        .drop("host")
    )
