"""Allow and block rules for URLs, found by hash prefixes.

A rule is (host, path, verdict). It fits its host and all subdomains of it when the URL's path
starts with the rule's path. Every URL is expanded into host-suffix and path-prefix expressions,
an equi-join on the first 32 bits of their SHA-256 finds candidate rules, the full digest confirms
them, and the longest confirmed rule decides (block if two equal rules disagree).

Only suffixes with as many labels, and prefixes with as many characters, as some rule has are
expanded: exact for every rule, and bounded however long a host or path is.

Defined cases: a null URL or one without ``://`` has the empty host and path and gets the default
verdict, as does an empty page table's absence of rows; rows that repeat an id and URL are counted
first and returned as often; a rule with a null part never fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL, as literally as possible."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def _digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def hashed_rules(rules: DataFrame) -> DataFrame:
    text = F.concat("host", "path")
    return (
        rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .groupBy(_digest(text).alias("rule_digest"))
        .agg(F.max((F.col("verdict") == "block").cast("long")).alias("blocks"))
        .select(_prefix(F.col("rule_digest")).alias("key"), "rule_digest", "blocks")
    )


def rule_shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Distinct label counts and path lengths of the rules, bounded by their longest host and path."""
    row = rules.agg(
        F.array_sort(F.collect_set(F.size(F.split("host", r"\.")))),
        F.array_sort(F.collect_set(F.length("path"))),
    ).first()
    return list(row[0]), list(row[1])


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """page_id, host, path, rule (or null) and verdict of every row of ``pages``."""
    labels, lengths = rule_shapes(rules)
    counted = pages.groupBy(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).agg(F.count("*").alias("copies"))
    host, path = host_and_path(F.col("url"))
    parts = counted.select("page_id", "url", "copies", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    n_labels = F.size(F.split("host", r"\."))
    shapes = F.array(*[F.struct(F.lit(k).alias("labels"), F.lit(n).alias("chars")) for k in labels for n in lengths])
    fitting = F.filter(shapes, lambda x: (x["labels"] <= n_labels) & (x["chars"] <= F.length("path")))

    def expression(x: Column) -> Column:
        suffix = F.call_function("substring_index", F.col("host"), F.lit("."), -x["labels"])
        digest = _digest(F.concat(suffix, F.substr("path", F.lit(1), x["chars"])))
        return F.struct(
            digest.alias("digest"),
            (F.length(suffix) + x["chars"]).cast("long").alias("size"),
            F.length(suffix).cast("long").alias("host_size"),
        )

    # no rule at all, or none with a fitting shape: the row passes with a null expression
    spread = parts.withColumn("e", F.explode_outer(F.transform(fitting, expression)) if labels and lengths else F.lit(None).cast("struct<digest:string,size:bigint,host_size:bigint>"))
    keyed = spread.select("*", "e.*", _prefix(F.col("e.digest")).alias("key")).drop("e")
    # size, host size and verdict in one number: for one URL the first two name the rule
    rank = F.when(
        F.col("digest") == F.col("rule_digest"),
        F.col("size") * F.lit(1 << 32) + F.col("host_size") * 2 + F.col("blocks"),
    )
    decided = (
        keyed.join(hashed_rules(rules), "key", "left")
        .groupBy("page_id", "url", "copies")
        .agg(F.max(rank).alias("best"))
    )
    host, path = (F.coalesce(x, F.lit("")) for x in host_and_path(F.col("url")))
    size = F.shiftright("best", 32).cast("int")
    host_size = F.shiftright(F.col("best").bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int")
    verdict = F.when(F.col("best").bitwiseAND(F.lit(1)) == 1, "block").otherwise("allow")
    return (
        decided.withColumns({"host": host, "path": path, "rule_host_size": host_size, "rule_size": size})
        .withColumn(
            "rule",
            F.when(
                F.col("best").isNotNull(),
                F.concat(
                    F.substr("host", F.length("host") - F.col("rule_host_size") + 1),
                    F.substr("path", F.lit(1), F.col("rule_size") - F.col("rule_host_size")),
                ),
            ),
        )
        .withColumn("verdict", F.when(F.col("best").isNull(), default).otherwise(verdict))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("page_id", "host", "path", "rule", "verdict")
    )
