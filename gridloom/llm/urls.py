"""URL filter: a broadcast trie over reversed host labels and path segments, longest match first."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules with up to so many characters in all are broadcast as a trie; more of them are joined with the urls.
MAX_RULE_CHARS = 50_000_000
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path.  Without ``://`` both are empty."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in (rest.find(c) for c in "?#") if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    return (rest.translate(_LOWER), "") if slash < 0 else (rest[:slash].translate(_LOWER), rest[slash:])


class RuleTrie:
    """Nodes are dicts: host labels from the right, then, below the key "/", whole path segments.

    A rule's last segment need not be whole: it is kept as a tail at the node of the segments before it, with the
    sizes of all tails there, and fits every segment run that starts with it.  A rule without a path is kept below "*".  More host labels win over fewer, then longer paths over
    shorter ones, then block over allow.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]], root: dict | None = None) -> None:
        self.root: dict = {} if root is None else root
        for host, path, verdict in rules:
            node = self.root
            for label in reversed([x for x in host.translate(_LOWER).split(".") if x]):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})
            if not path:
                if node.get("*", ("", "allow"))[1] != "block":
                    node["*"] = (f"{host.translate(_LOWER)}/", verdict)
                continue
            *whole, tail = (path[1:] if path.startswith("/") else path).split("/")
            for segment in whole:
                node = node.setdefault("/" + segment, {})
            tails = node.setdefault("", {})
            if len(tail) not in (sizes := node.setdefault("#", [])):
                sizes.append(len(tail))
            if tails.get(tail, ("", "allow"))[1] != "block":
                tails[tail] = (f"{host.translate(_LOWER)}/{path.removeprefix('/')}", verdict)

    @staticmethod
    def _longest(node: dict | None, path: str) -> tuple[str, str] | None:
        found, at = node.get("*") if node else None, 1
        while node is not None:
            if tails := node.get(""):
                fits = max((n for n in node["#"] if path[at : at + n] in tails and at + n <= len(path)), default=None)
                if fits is not None:
                    found = tails[path[at : at + fits]]
            end = path.find("/", at)
            if end < 0:
                return found
            node, at = node.get("/" + path[at:end]), end + 1
        return found

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits, or None."""
        found, node = None, self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.get(label)
            if node is None:
                break
            found = self._longest(node.get("/"), path) or found
        return found


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``; columns of those names are replaced.

    ``rules`` are (host, path, "allow" or "block").  A rule fits its host and all subdomains if the url's path
    starts with the rule's.  A null url or one without ``://`` has an empty host and path, which no rule fits;
    ``default`` is the verdict without a rule.  A rule with the path "/" fits no url without a path; one with an
    empty path fits every url of its hosts.
    Repeated rows and rules change nothing; urls of any length are judged whole, and an empty table gives an empty
    one.  Rules beyond ``MAX_RULE_CHARS`` are joined instead of broadcast, with the same verdicts.
    """
    rules = sorted({(h, p, v) for h, p, v in rules})
    for h, p, v in rules:
        if v not in ("allow", "block") or not h:
            raise ValueError(f"not a rule: {(h, p, v)!r}")
    rest = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    if sum(len(h) + len(p) for h, p, _ in rules) > MAX_RULE_CHARS:
        return _joined(pages, pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"), max(p.count("/") for _, p, _ in rules), default, url).select(*rest, "_judged.*")
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules).root)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = RuleTrie((), trie.value)
        for urls in parts:
            rows = []
            for u in urls:
                host, path = split_url(u)
                rows.append((host, path, *(t.match(host, path) or (None, default))))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return pages.withColumn("_judged", judge(url)).select(*rest, "_judged.*")


def _joined(pages: DataFrame, rules: DataFrame, deepest: int, default: str, url: str) -> DataFrame:
    """``pages`` with ``_judged``: each distinct url meets the rules of its host suffixes and of the folders above its path, as deep as rules go."""
    lower = lambda c: F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    folder = lambda c: F.regexp_extract(c, r"(?s)\A(.*/)", 1)
    trimmed = lambda c: F.array_join(F.array_remove(F.split(c, r"\."), ""), ".")
    rules = rules.select(lower(trimmed(F.col("host"))).alias("_h"), lower("host").alias("_shown"), F.col("path").alias("_p"), folder(F.col("path")).alias("_f"), F.col("verdict").alias("_v"))
    at = F.instr(F.coalesce(F.col("_u"), F.lit("")), "://")
    rest = F.when(at > 0, F.regexp_extract(F.substr(F.col("_u"), at + 3), r"(?s)\A([^?#]*)", 1)).otherwise("")
    known = pages.select(F.col(url).alias("_u")).distinct().withColumn("_rest", rest)
    known = known.select("_u", lower(F.regexp_extract("_rest", r"(?s)\A([^/]*)", 1)).alias("host"), F.regexp_extract("_rest", r"(?s)\A[^/]*(/.*)\z", 1).alias("path"))
    labels, steps = F.split("host", r"\."), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.lit(1 << 30)), "."))
    folders = F.transform(F.sequence(F.lit(0), F.least(F.size(steps) - 1, F.lit(deepest))), lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/"))))
    asked = known.select("*", F.explode(hosts).alias("_h")).select("*", F.explode(folders).alias("_f"))
    rank = F.struct(F.size(F.split("_h", r"\.")), F.length("_p"), F.col("_v") == "block", F.concat("_shown", F.lit("/"), F.regexp_replace("_p", r"\A/", "")).alias("rule"), F.col("_v").alias("verdict"))
    best = asked.join(rules, ["_h", "_f"]).filter(F.startswith("path", "_p")).groupBy("_u").agg(F.max(rank).alias("_b")).withColumnRenamed("_u", "_w")
    judged = known.join(best, F.col("_u") == F.col("_w"), "left").select("_u", F.struct("host", "path", F.col("_b.rule").alias("rule"), F.coalesce("_b.verdict", F.lit(default)).alias("verdict")).alias("_judged"))
    return pages.join(judged, pages[url].eqNullSafe(judged["_u"]), "left").drop("_u")
