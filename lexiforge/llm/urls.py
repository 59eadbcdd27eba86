"""URL filters: rules by host and path, and boosted trees on lexical features for the URLs that no rule decides."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiforge.llm.boosting import BoostedTrees

#: (verdict, rule): host and path prefix in one string, cut at the first slash.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Labelled URLs that the model learns from at most, chosen by hash.
TRAINING_ROWS = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; empty for null or where there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits a host or a domain above it and the start of the path; else nulls."""
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: -len(r[1])):
        domain, _, prefix = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _parts(url: str, host: str, path: str) -> tuple[list[float], list[str]]:
    query = url.partition("#")[0].partition("?")[2]
    n = max(len(url), 1)
    counts = Counter(url)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    digits = sum(c.isdigit() for c in url)
    segments = [s for s in path.split("/") if s]
    numbers = [
        len(url), len(host), len(path), len(segments), host.count("."), digits / n, sum(c.isdigit() for c in host), entropy,
        query.count("=") if query else 0, len(query), url.count("-"), host.count("-"), url.count("%"), float("#" in url),
        float(path.endswith("/")), max(map(len, segments), default=0), float(url.startswith("https")), sum(not c.isalnum() for c in url) / n,
    ]
    labels = host.split(".")
    last = segments[-1] if segments else ""
    suffixes = ["host:" + labels[-1], "domain:" + ".".join(labels[-2:]), "first:" + (segments[0] if len(segments) > 1 else ""), "file:" + (last.rpartition(".")[2] if "." in last else "")]
    return [float(x) for x in numbers], suffixes


class UrlModel:
    """Probability that a URL is to be blocked."""

    def __init__(self, urls: list[tuple[str, str, str]], blocked: list[int]):
        seen, bad = Counter(), Counter()
        parts = [_parts(*u) for u in urls]
        for (_, suffixes), y in zip(parts, blocked):
            for s in suffixes:
                seen[s] += 1
                bad[s] += y
        self.prior = sum(blocked) / len(blocked) if blocked else 0.0
        #: Of suffixes that several training rows share: how often, and the smoothed share that is blocked.
        self.known = {s: (math.log1p(n), (bad[s] + 4 * self.prior) / (n + 4)) for s, n in seen.items() if n >= 3}
        self.trees = BoostedTrees().fit(self._table(parts), np.array(blocked, float)) if len(set(blocked)) > 1 else None

    def _table(self, parts) -> np.ndarray:
        return np.array([numbers + [v for s in suffixes for v in self.known.get(s, (0.0, self.prior))] for numbers, suffixes in parts])

    def score(self, urls: list[tuple[str, str, str]]) -> np.ndarray:
        if not self.trees or not urls:
            return np.full(len(urls), self.prior)
        return self.trees.score(self._table([_parts(*u) for u in urls]))


def filtered_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] | None = None, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row.

    The verdict is the longest fitting rule's, with a null score; without one, the model's: block from a score of 0.5. The model learns from URLs that a
    rule decides: at most ``training_rows`` different ones, chosen by hash. With no such URL, or only one verdict among them, the
    score is that verdict's share (none: allow). Null and empty URLs have empty host and path and are scored as empty.
    Repeated rows and null ids each give a row; an empty table gives an empty result; other columns are not read.
    """
    url = F.col(url_col).cast("string")
    cut = pages.select(F.col(id_col).alias("page_id"), F.coalesce(url, F.lit("")).alias("u"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), RULES if rules is None else rules)
    cut = cut.withColumns({"rule": rule, "says": verdict})
    learn = cut.where("rule is not null").select("u", "host", "path", "says").distinct().orderBy(F.xxhash64("u"), "u").limit(training_rows).collect()
    model = UrlModel([(r.u, r.host, r.path) for r in learn], [int(r.says == "block") for r in learn])

    @F.arrow_udf("double")
    def score(u: pa.Array, host: pa.Array, path: pa.Array) -> pa.Array:
        left = [k for k, x in enumerate(u.is_valid().to_pylist()) if x]
        out = np.full(len(u), np.nan)
        out[left] = model.score(list(zip(*(c.take(pa.array(left, pa.int64())).to_pylist() for c in (u, host, path)))))
        return pa.array(out, pa.float64(), mask=np.isnan(out))

    undecided = F.when(F.col("rule").isNull(), F.col("u"))
    scored = cut.withColumn("score", score(undecided, "host", "path"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("says", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
