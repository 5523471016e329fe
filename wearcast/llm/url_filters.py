"""URL filters: fixed host and path rules first, then a path-template tree learnt per host.

1. A path becomes a lexical template: digit runs and hexadecimal names in its segments turn
   into wildcards. Pages become distinct (host, lexical template) rows and labels sums of
   them before anything else is shuffled, so a host with a third of all pages is a few rows.
2. Level by level, down to the last segment, the children of a template node keep their own
   branch only if they have ``SUPPORT`` labels and a labelled rate that differs from their
   siblings' (two-proportion z test); the others are merged into a wildcard branch. Neither
   the host's pages nor the depth of the path count. One round takes a node over all levels
   without a split to its first split, so rounds follow nested splits, not path lengths.
3. A template's purity is its share of good labels, smoothed by its host's, which is
   smoothed by the overall share. Templates of purity below ``LEAST_PURITY`` are rejected.

Labelled pages are ``labels`` rows whose doc_id equals the page_id; quality 1 is good.

Defined cases: a null URL or one without ``://`` has an empty host and path and falls under
the template of the empty host; without labels no template is rejected; several labels of a
page count each; rows that repeat a page_id are judged row by row; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .decontamination import A_Z, a_z

#: Fixed values: (host, path prefix, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
SUPPORT, Z, SMOOTH, LEAST_PURITY = 3, 1.96, 4.0, 0.5
BROADCAST_ROWS = 100_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, F.lit("://")) + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), A_Z, a_z)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest fitting rule (as ``host`` + ``path prefix``) and its verdict; nulls if none fits."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return rule, verdict


def segments(path: Column) -> Column:
    """Segments with digit runs and hexadecimal names as wildcards."""
    hexa = r"(?<![A-Za-z0-9])(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{8,}(?![A-Za-z0-9])"
    flat = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, "^/", ""), hexa, "{h}"), "[0-9]+", "{n}")
    return F.split(flat, "/")


def splits(tree: DataFrame) -> DataFrame:
    """(host, node, level, child): children that keep their own branch at the first level where a node has any.

    Up to that level all rows of a node are merged, so each level can be tested apart.
    """
    cells = (tree.where("marked > 0").select("host", "node", "at", "good", "marked", F.posexplode("lex").alias("level", "child"))
             .where("level >= at").groupBy("host", "node", "level", "child").agg(F.sum("good").alias("c_good"), F.sum("marked").alias("c_marked")))
    all_ = cells.groupBy("host", "node", "level").agg(F.sum("c_good").alias("p_good"), F.sum("c_marked").alias("p_marked"))
    rest = F.col("p_marked") - F.col("c_marked")
    pooled = F.col("p_good") / F.col("p_marked")
    gap = F.col("c_good") / F.col("c_marked") - (F.col("p_good") - F.col("c_good")) / F.nullif(rest, F.lit(0))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("c_marked") + 1 / F.nullif(rest, F.lit(0))))
    own = (cells.where(F.col("c_marked") >= SUPPORT).join(all_.where("p_good > 0 and p_good < p_marked"), ["host", "node", "level"])
           .where(F.abs(gap) >= Z * F.nullif(spread, F.lit(0.0))).select("host", "node", "level", "child"))
    own = C.stored(own, "url-splits")
    return own.join(own.groupBy("host", "node").agg(F.min("level").alias("level")), ["host", "node", "level"]).select("host", "node", "level", "child")


def templates(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, lex, template, purity) of every host and lexical template; ``pages`` has page_id, host, lex."""
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.sum("quality").alias("good"), F.count("*").alias("marked"))
    # templates and label counts are found apart, so that labels are joined with ids only
    found = pages.select("host", "lex").distinct()
    judged = (pages.select("page_id", "host", "lex").join(marks, pages["page_id"] == marks["doc_id"])
              .groupBy("host", "lex").agg(F.sum("good").alias("good"), F.sum("marked").alias("marked")))
    tree = found.join(judged, ["host", "lex"], "left").fillna(0, ["good", "marked"]).withColumns({"node": F.lit(""), "at": F.lit(0)})
    tree, closed = C.stored(tree, "url-templates"), []
    while True:
        own = C.stored(splits(tree), "url-own")
        many = own.count()
        if not many:
            break
        own = own.withColumn("own", F.lit(True))
        first = own.select("host", "node", "level").distinct()
        if many <= BROADCAST_ROWS:
            own, first = F.broadcast(own), F.broadcast(first)
        step = (tree.join(first, ["host", "node"], "left").withColumn("child", F.get("lex", F.col("level")))
                .join(own, ["host", "node", "level", "child"], "left"))
        # paths that end before the split, or in a node without one, are merged to their end
        goes_on = F.col("child").isNotNull()
        merged = F.repeat(F.lit("/*"), F.col("level") - F.col("at"))
        below = F.concat("node", merged, F.lit("/"), F.when(F.col("own"), F.col("child")).otherwise("*"))
        step = C.stored(step.select("host", "lex", "good", "marked", F.when(goes_on, below).otherwise(F.col("node")).alias("node"),
                                    F.when(goes_on, F.col("level") + 1).otherwise(F.col("at")).alias("at"), goes_on.alias("open")), "url-templates")
        closed.append(step.where("not open").drop("open"))
        tree = step.where("open").drop("open")
    tree = reduce(DataFrame.union, closed, tree)
    tree = tree.withColumn("node", F.concat("node", F.repeat(F.lit("/*"), F.size("lex") - F.col("at"))))
    total = tree.agg((F.sum("good") / F.nullif(F.sum("marked"), F.lit(0))).alias("s")).first()["s"]
    prior = 1.0 if total is None else float(total)
    by_host = tree.groupBy("host").agg(((F.sum("good") + SMOOTH * prior) / (F.sum("marked") + SMOOTH)).alias("host_share"))
    by_node = tree.groupBy("host", "node").agg(F.sum("good").alias("g"), F.sum("marked").alias("m"))
    pure = by_node.join(by_host, "host").select("host", "node", ((F.col("g") + SMOOTH * F.col("host_share")) / (F.col("m") + SMOOTH)).alias("purity"))
    return tree.join(pure, ["host", "node"]).select("host", "lex", F.col("node").alias("template"), "purity")


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every page row."""
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("lex", segments(F.col("path")))
    known = C.stored(templates(rows, labels), "url-purity")
    few = known.count() <= BROADCAST_ROWS
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    learnt = F.when(F.col("purity") < LEAST_PURITY, "block").otherwise("allow")
    return (rows.join(F.broadcast(known) if few else known, ["host", "lex"], "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"), "template", "purity"))


def op8_url_filters(spark, sf_dir):
    return judge(C.table(spark, sf_dir, "pages"), C.table(spark, sf_dir, "labels"))
