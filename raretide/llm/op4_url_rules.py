"""URL filters: host and path rules first, then association rules mined with FP-growth.

Every labelled page (``labels.doc_id`` = ``page_id``; to block: toxic 1 or quality 0) is a transaction of its URL's
tokens and its verdict.  Tokens that occur in the same pages only are one class, mined as one item: a URL of many words of its own adds one
item, not all their combinations, and any token of a class stands for it.  Spark's FP-growth mines the frequent combinations; rules whose
consequence is a verdict are kept if confident, if supported by a share of the pages and ``MIN_PAGES`` of them, and if no shorter block rule is part of
them (it fires wherever they do).  A rule fires when all its classes are met in the URL: by an inverted index from token to rules, or by a join on
each rule's rarest class if there are more than ``MAX_RULES`` to send.  A URL is blocked if a block rule fires, else allowed.

Tokens: host labels with their place from the right, path words (runs of digits as ``#``), the file ending and query
keys, each once.  Null URLs and URLs without ``://`` have empty host and path and no tokens: allowed; so has a URL without a host.  Without
labelled pages there are no rules.  Repeated rows keep a row each; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from raretide.llm.common import table, written

# The explicit rules (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
MIN_SUPPORT, MIN_PAGES, MIN_CONFIDENCE, MAX_RULES = 0.002, 3, 0.5, 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring_index(substring(url, instr(url, '://') + 3), '#', 1)"))
    rest = F.substring_index(rest, "?", 1)
    cut = F.instr(rest, "/")
    host = F.when(cut > 0, F.left(rest, cut - 1)).otherwise(rest)
    path = F.when(cut > 0, F.substring(rest, cut, F.length(rest))).otherwise(F.lit(""))
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(F.when(rest.isNotNull(), path), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null if none)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def tokens(host: str, path: str, url: str) -> list[str]:
    out = {f"host{i}:{label}" for i, label in enumerate(reversed(host.split("."))) if label}
    out |= {"path:" + re.sub(r"\d+", "#", w) for w in re.split(r"[^\w]+", path) if w}
    if "." in path.rsplit("/", 1)[-1]:
        out.add("end:" + path.rsplit(".", 1)[-1])
    query = url.partition("#")[0].partition("?")[2]
    out |= {"query:" + q.partition("=")[0] for q in query.split("&") if q}
    if "#" in url:
        out.add("fragment")
    return sorted(out)


def _tokenised(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [tokens(h, p, u) if u and h else [] for h, p, u in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "url")))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(rows, pa.list_(pa.string()))], names=[*columns, "items"])
    return run


def _shortest(rules: DataFrame) -> DataFrame:
    """The rules (rule, confidence, n) that hold no shorter rule, size by size."""
    rest, kept = written(rules, "url-rules"), None
    while (n := rest.agg(F.min("n")).first()[0]) is not None:
        own = rest.where(F.col("n") == n).select("rule", "confidence")
        kept = own if kept is None else kept.union(own)
        part = own.select(F.col("rule").alias("part"), F.col("rule")[0].alias("token"))
        more = rest.where(F.col("n") > n)
        longer = more.select("rule", F.explode("rule").alias("token")).join(part, "token").where(F.size(F.array_except("part", "rule")) == 0)
        rest = written(more.join(longer.select("rule").distinct(), "rule", "left_anti"), "longer-rules")
    return written(rules.select("rule", "confidence") if kept is None else kept, "shortest-rules")


def _classes(baskets: DataFrame, least: float) -> DataFrame:
    """Every token of at least ``least`` baskets with its class (the least token that is in the same baskets) and the baskets' number."""
    each = baskets.select("basket", F.explode("items").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), *[F.bit_xor(F.xxhash64(F.lit(seed), "basket")).alias(f"x{seed}") for seed in (1, 2)]).where(F.col("n") >= least)
    each = written(each, "url-token-counts")
    named = each.groupBy("n", "x1", "x2").agg(F.min("token").alias("class"))
    return written(each.join(named, ["n", "x1", "x2"]).select("token", "class", "n"), "url-classes")


def mined_rules(pages: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Block rules (rule: its classes, confidence) from labelled pages with ``host`` and ``path``, and the classes (token, class, n); None without any page."""
    from pyspark.ml.fpm import FPGrowth
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), "verdict=block").otherwise("verdict=allow")
    known = labels.select(F.col("doc_id").alias("page_id"), bad.alias("verdict")).groupBy("page_id").agg(F.max("verdict").alias("verdict"))
    baskets = pages.join(known, "page_id").select("host", "path", "url", "verdict").mapInArrow(_tokenised(["verdict"]), "verdict string, items array<string>")
    baskets = written(baskets.withColumn("basket", F.monotonically_increasing_id()), "url-baskets")
    total = baskets.count()
    if not total:
        return None
    support = max(MIN_SUPPORT, min(1.0, MIN_PAGES / total))
    classes = _classes(baskets, support * total)
    merged = baskets.select("basket", F.explode("items").alias("token")).join(classes, "token").groupBy("basket").agg(F.collect_set("class").alias("items"))
    merged = baskets.select("basket", "verdict").join(merged, "basket", "left").select(
        F.array_append(F.coalesce("items", F.array().cast("array<string>")), F.col("verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=MIN_CONFIDENCE).fit(written(merged, "url-merged"))
    rules = _shortest(model.associationRules.where(F.array_contains("consequent", "verdict=block") & ~F.array_contains("antecedent", "verdict=allow"))
                      .select(F.array_sort("antecedent").alias("rule"), "confidence", F.size("antecedent").alias("n")))
    return rules, classes


def _sent(found: tuple[DataFrame, DataFrame] | None) -> tuple[list[tuple[tuple[str, ...], float]], dict[str, str]]:
    """Rules and the class of each token that they ask for."""
    if found is None:
        return [], {}
    rules, classes = found
    asked = rules.select(F.explode("rule").alias("class")).distinct()
    return [(tuple(r["rule"]), r["confidence"]) for r in rules.collect()], {r["token"]: r["class"] for r in classes.join(asked, "class").collect()}


def mine(pages: DataFrame, labels: DataFrame) -> list[tuple[tuple[str, ...], float]]:
    """All block rules (tokens, confidence), on the driver, written out for every token of a class."""
    rules, classes = _sent(mined_rules(pages, labels))
    members: dict[str, list[str]] = defaultdict(list)
    for token, name in classes.items():
        members[name].append(token)
    return [(tuple(sorted(choice)), confidence) for rule, confidence in rules for choice in itertools.product(*(members[c] for c in rule))]


def _joined(pages: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """page_id, host, path, mined by a join of the distinct sets of classes with the rules, each on its rarest class."""
    rows = written(pages.select("page_id", "host", "path", "url").mapInArrow(_tokenised(["page_id", "host", "path"]), "page_id long, host string, path string, items array<string>"), "url-tokens")
    sets = rows.select("items").distinct()
    met = sets.select("items", F.explode("items").alias("token")).join(classes.select("token", "class"), "token").groupBy("items").agg(F.collect_set("class").alias("met"))
    counted = rules.select("rule", F.explode("rule").alias("class")).join(classes.select("class", "n").distinct(), "class")
    rarest = counted.groupBy("rule").agg(F.min_by("class", F.struct("n", "class")).alias("class"))
    fired = (met.select("items", "met", F.explode("met").alias("class")).join(rarest, "class")
             .where(F.size(F.array_except("rule", "met")) == 0).select("items").distinct().withColumn("mined", F.lit("block")))
    return rows.join(fired, "items", "left").select("page_id", "host", "path", F.coalesce("mined", F.lit("allow")).alias("mined"))


def _matched(columns: list[str], rules: list[tuple[tuple[str, ...], float]], classes: dict[str, str]):
    index: dict[str, list[int]] = defaultdict(list)
    for i, (rule, _) in enumerate(rules):
        for c in rule:
            index[c].append(i)
    need = [len(rule) for rule, _ in rules]
    index = dict(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, p, u in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "url"))):
                met: dict[int, int] = defaultdict(int)
                fired = False
                for c in {classes[t] for t in tokens(h, p, u) if t in classes} if u and h else ():
                    for i in index[c]:
                        met[i] += 1
                        fired = fired or met[i] == need[i]
                out.append("block" if fired else "allow")
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(out, pa.string())], names=[*columns, "mined"])
    return run


def _too_many(rules: DataFrame, classes: DataFrame) -> bool:
    """Whether the rules, or the tokens that they ask for, are more than should be sent."""
    asked = rules.select(F.explode("rule").alias("class")).distinct()
    return rules.limit(MAX_RULES + 1).count() > MAX_RULES or classes.join(asked, "class").limit(10 * MAX_RULES + 1).count() > 10 * MAX_RULES


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (the association rules' own verdict) of every page."""
    host, path = host_path(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    found = mined_rules(parsed, labels)
    if found is not None and _too_many(*found):
        out = _joined(parsed, *found)
    else:
        out = parsed.mapInArrow(_matched(["page_id", "host", "path"], *_sent(found)), "page_id long, host string, path string, mined string")
    name, verdict = rule_of(F.col("host"), F.col("path"))
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.col("mined")).alias("verdict"), "mined")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict")
