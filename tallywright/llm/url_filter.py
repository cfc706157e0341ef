"""URL filter: a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(host.translate(str.maketrans(UPPER, UPPER.lower())), slash + path, verdict)

    @property
    def text(self) -> str:
        return self.host + self.path


class Trie:
    """Nodes are dicts of reversed host labels; each holds a trie of path segments.

    A rule's path ends inside a segment ("/en/" ends in the empty one after its last
    slash), so the last piece is matched as a prefix of the URL's segment there.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {"labels": {}, "paths": None}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node["labels"].setdefault(label, {"labels": {}, "paths": None})
            if node["paths"] is None:
                node["paths"] = {"next": {}, "ends": {}}
            *whole, last = rule.path.split("/")
            place = node["paths"]
            for segment in whole:
                place = place["next"].setdefault(segment, {"next": {}, "ends": {}})
            # Of equal rules the first listed stays.
            place["ends"].setdefault(last, rule)

    def match(self, host: str, path: str) -> Rule | None:
        """The rule with the most host labels, then the longest path; None if none fits."""
        node, nodes = self.root, [self.root]
        for label in reversed(host.split(".")) if host else ():
            node = node["labels"].get(label)
            if node is None:
                break
            nodes.append(node)
        segments = path.split("/")
        for node in reversed(nodes):
            place, best = node["paths"], None
            for segment in segments:
                if place is None:
                    break
                fits = [end for end in place["ends"] if segment.startswith(end)]
                if fits:
                    best = place["ends"][max(fits, key=len)]
                place = place["next"].get(segment)
            if best is not None:
                return best
        return None


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    default: str = "allow",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, replacing columns of these names.

    The longest rule wins: most host labels, then longest path, then first listed.
    Where no rule fits, ``rule`` is null and ``verdict`` is ``default``. A null URL, an
    empty one or one without ``://`` has an empty host and path. Rows are never dropped
    or merged, so repeated rows give repeated rows and an empty table an empty result.
    The trie goes to the executors with the function; that takes rules whose size was
    counted. Beyond ``max_broadcast_bytes`` rules are a table, joined on host suffixes.
    """
    added = ("host", "path", "rule", "verdict")
    base = pages.drop(*[c for c in added if c != url]).withColumns(
        {"__host": url_host(pages[url]), "__path": url_path(pages[url])}
    )
    if sum(len(r.text.encode()) + 64 for r in rules) <= max_broadcast_bytes:
        trie = Trie(rules)

        @F.pandas_udf("rule string, verdict string")
        def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
            found = [trie.match(h, p) for h, p in zip(host, path, strict=True)]
            return pd.DataFrame(
                {"rule": [r and r.text for r in found], "verdict": [r.verdict if r else default for r in found]},
                dtype=object,
            )

        out = base.withColumn("__hit", judge("__host", "__path"))
        hit = {"rule": F.col("__hit.rule"), "verdict": F.col("__hit.verdict")}
        out = out.withColumns({"host": F.col("__host"), "path": F.col("__path"), **hit})
        return out.drop("__hit", "__host", "__path")
    return _joined(base, rules, default)


def _joined(base: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """The same verdicts by a join of each host's suffixes with the rules' hosts."""
    spark = base.sparkSession
    listed = spark.createDataFrame(
        [(r.host, r.path, r.verdict, i) for i, r in enumerate(rules)], "r_host string, r_path string, r_verdict string, r_no long"
    )
    keyed = base.select("__host", "__path").distinct()
    labels = F.split("__host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    # A rule without host is a suffix of every host.
    keyed_suffix = keyed.withColumn("__suffix", F.explode(F.array_union(suffixes, F.array(F.lit("")))))
    fits = keyed_suffix.join(listed, F.col("__suffix") == F.col("r_host")).where(F.col("__path").startswith(F.col("r_path")))
    labels_of = F.when(F.col("r_host") == "", 0).otherwise(F.size(F.split("r_host", r"\.")))
    best = fits.groupBy(F.col("__host").alias("k_host"), F.col("__path").alias("k_path")).agg(
        F.max_by(
            F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")),
            F.struct(labels_of.alias("n"), F.length("r_path").alias("m"), -F.col("r_no")),
        ).alias("best")
    )
    return (
        base.join(best, (F.col("__host") == F.col("k_host")) & (F.col("__path") == F.col("k_path")), "left")
        .withColumns(
            {
                "host": F.col("__host"),
                "path": F.col("__path"),
                "rule": F.col("best.rule"),
                "verdict": F.coalesce("best.verdict", F.lit(default)),
            }
        )
        .drop("__host", "__path", "k_host", "k_path", "best")
    )
