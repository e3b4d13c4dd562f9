"""URL filters: pattern rules indexed by their rarest literal token.

A rule is judged on a target string, host + path or the whole URL with its host in lower
case, by a regular expression. Its literal tokens are the runs of letters and digits that every matching
target must hold as whole tokens. The rule is filed under the one of them that fewest URLs
hold; a URL's tokens then fetch the few rules whose expression is worth running.
"""

import json
import re

from pyspark.sql import DataFrame, functions as F

from shopflow.sources import stage

INDEX_BYTES = 4 << 20  # a larger index is joined, not sent along as a literal

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_rule(action: str, pattern: str) -> dict:
    """A rule ``host/path``: fits the host, its subdomains, and paths that start with it."""
    host, slash, path = pattern.partition("/")
    regex = r"(?s)^(?:[^/]*\.)?" + re.escape(host) + re.escape(slash + path)
    # The host's labels end at a dot or the slash; a path's last run may go on.
    closed = re.findall("[a-z0-9]+", host)
    closed += re.findall("[A-Za-z0-9]+(?=[^A-Za-z0-9])", slash + path)
    return {"rule": pattern, "action": action, "regex": regex, "tokens": closed,
            "length": len(pattern), "layer": 1}


def wildcard_rule(action: str, pattern: str) -> dict:
    """A rule over the whole URL, which may match anywhere.

    ``*`` stands for anything; ``|`` for the edge of a word: an end of the URL, or a sign
    that is neither a letter nor a digit.
    """
    edge = r"(?:\A|[^A-Za-z0-9]|\z)"
    regex = "(?s)" + ".*".join(edge.join(re.escape(x) for x in part.split("|")) for part in pattern.split("*"))
    closed = re.findall("(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", pattern)
    return {"rule": pattern, "action": action, "regex": regex, "tokens": closed,
            "length": len(pattern), "layer": 0}


def rule_index(urls: DataFrame, rules: list) -> DataFrame:
    """(token, rule...) for every rule; the token '' holds rules without a literal token.

    ``urls`` needs the column ``tokens``. How many URLs hold a token is counted over all of
    them, with a row per token and task in the shuffle. The rules come from the driver; the
    words of up to INDEX_BYTES travel as a literal, so no other token is counted.
    """
    spark = urls.sparkSession
    schema = ("rule string, action string, regex string, tokens array<string>, "
              "length int, layer int, number int")
    frame = spark.createDataFrame([r | {"number": i} for i, r in enumerate(rules)], schema)
    literal = frame.select("number", F.explode("tokens").alias("token"))
    words = sorted({t for r in rules for t in r["tokens"]})
    tokens = F.col("tokens")
    if sum(map(len, words)) <= INDEX_BYTES:
        tokens = F.array_intersect(tokens, F.from_json(F.lit(json.dumps(words)), "array<string>"))
    held = urls.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literal.join(held, "token", "left").groupBy("number")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    return frame.drop("tokens").join(rarest, "number", "left").withColumn(
        "token", F.coalesce("token", F.lit("")))


def parts(url):
    """(host, path, target, tokens) of a URL column; host and path are '' without ``://``."""
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, URL_PARTS, 1), UPPER, LOWER)
    path = F.regexp_extract(known, URL_PARTS, 2)
    tokens = F.array_distinct(F.filter(
        F.split(F.concat_ws(" ", known, host, F.lit("")), "[^A-Za-z0-9]+"), lambda t: t != ""))
    return host, path, tokens


def target(url):
    """The URL with its host in lower case; '' for null."""
    known = F.coalesce(url, F.lit(""))
    before = F.regexp_extract(known, r"(?s)^(.*?://)[^/?#]*", 1)
    host = F.translate(F.regexp_extract(known, URL_PARTS, 1), UPPER, LOWER)
    rest = F.substring(known, F.length(before) + F.length(host) + 1, F.length(known))
    return F.when(before == "", known).otherwise(F.concat(before, host, rest))


def judge(urls: DataFrame, rules: list, url_col: str = "url", default: str = "allow",
          index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``urls`` plus ``host``, ``path``, ``rule``, ``verdict`` and ``decided_by``.

    Host rules win over wildcard rules, longer ones over shorter, block over allow, then
    the first listed. ``rule`` names a host rule; with none it is null and the verdict is
    the best wildcard rule's, or else ``default``. ``decided_by`` names the rule of either
    kind, null where the default holds. A null, empty or odd URL has an empty
    host and path and still meets the wildcard rules. Every row stays; columns of ``urls``
    that bear the new names give way.

    An index of up to ``index_bytes`` travels as a literal and no row moves. A larger one is
    joined by token: distinct URLs, their candidate rules, and back to the rows.
    """
    added = ("host", "path", "rule", "verdict", "decided_by")
    host, path, tokens = parts(F.col("url"))
    rows = urls.select(F.struct("*").alias("row"), F.col(url_col).cast("string").alias("url"))
    index = stage.table(
        rule_index(rows.select(tokens.alias("tokens")), rules), "url-rules")
    size = index.agg(F.coalesce(F.sum(
        F.length("rule") + F.length("regex") + F.length("token") + 64), F.lit(0)).alias("n")).first().n

    def fits(c):
        target = F.when(c["layer"] == 1, F.concat("host", "path")).otherwise(F.col("target"))
        return F.regexp_like(target, c["regex"])

    def rank(c):
        return F.struct(c["layer"].alias("layer"), c["length"].alias("length"),
                        (c["action"] == "block").alias("block"), (-c["number"]).alias("first"),
                        c["rule"].alias("rule"), c["action"].alias("action"))

    def verdict(best):
        return [F.when(best["layer"] == 1, best["rule"]).alias("rule"),
                F.coalesce(best["action"], F.lit(default)).alias("verdict"), best["rule"].alias("decided_by")]

    if size <= index_bytes:
        by_token = {}
        for r in index.collect():
            by_token.setdefault(r.token, []).append(r.asDict())
        known = F.from_json(F.lit(json.dumps(by_token)), (
            "map<string,array<struct<rule:string,action:string,regex:string,length:int,"
            "layer:int,number:int>>>"))
        split = rows.select("row", target(F.col("url")).alias("target"), host.alias("host"), path.alias("path"),
                            F.concat(tokens, F.array(F.lit(""))).alias("tokens"))
        fetched = F.flatten(F.filter(F.transform("tokens", lambda t: F.try_element_at(known, t)),
                                     lambda x: x.isNotNull()))
        best = F.array_max(F.transform(F.filter(fetched, fits), rank))
        judged = split.select("row", "host", "path", best.alias("best"))
    else:
        distinct = rows.select("url").distinct().select(
            "url", host.alias("host"), path.alias("path"), tokens.alias("tokens"))
        candidates = distinct.select("url", target(F.col("url")).alias("target"), "host", "path", F.explode(
            F.concat("tokens", F.array(F.lit("")))).alias("token"))
        fitting = (
            candidates.join(index.select("token", F.struct("*").alias("c")), "token")
            .where(fits(F.col("c")))
            .groupBy("url").agg(F.max(rank(F.col("c"))).alias("best"))
        )
        judged = (
            rows.join(fitting.withColumnRenamed("url", "known"),
                      F.col("url").eqNullSafe(F.col("known")), "left")
            .select("row", host.alias("host"), path.alias("path"), "best")
        )
    return judged.select(*[F.col("row")[c].alias(c) for c in urls.columns if c not in added],
                         "host", "path", *verdict(F.col("best")))
