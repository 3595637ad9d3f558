"""URL filter: host and path rules first, then logistic regression on hashed character
n-grams of host and path, trained here from a small labelled URL table."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, map_rows

#: Rules of the registered query: (verdict, host, path). Longest fitting rule wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# What unwanted and ordinary hosts are about, in plain English.
UNWANTED = "casino poker roulette jackpot lottery betting slots gambling pills pharmacy viagra steroids xxx porn adult escort webcam nude payday loans bitcoin jackpots spam clickbait popup adserver ads banner tracking malware warez cracked replica".split()
ORDINARY = "library museum newspaper university school gardening weather cooking history science council travel music recipes forum maps health hospital theatre painting astronomy chemistry football cycling pottery knitting archive station journal village harbour forest".split()
BEFORE, AFTER, ENDS = ("best", "my", "all", "new"), ("online", "world", "site", "daily"), ("test", "invalid", "example")
PATHS = ("", "/", "/index.html", "/a/1", "/page/204.html", "/2020/05/7")


def labelled_urls() -> tuple[tuple[str, str, int], ...]:
    """The labelled URL table (host, path, 1 = block), from the two lists by a rule: a subject alone,
    after and before other words, under names reserved for tests. Paths are dealt alike to both
    kinds, so they say nothing. An address without host and path is ordinary."""
    rows = [("", "", 0)] * 8
    for block, subjects in ((1, UNWANTED), (0, ORDINARY)):
        for i, x in enumerate(subjects):
            names = (x, f"{BEFORE[i % 4]}-{x}", f"{x}-{AFTER[i % 4]}", f"www.{x}{AFTER[(i + 1) % 4]}", f"m.{BEFORE[(i + 2) % 4]}{x}")
            rows += [(f"{n}.{ENDS[(i + j) % 3]}", PATHS[(i + j) % 6], block) for j, n in enumerate(names)]
    return tuple(rows)


LABELLED_URLS = labelled_urls()


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path by the contract's rule; both empty for null or no ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.translate(str.maketrans(UPPER, LOWER)), rest[:cut]


def features(host: str, path: str, sizes: tuple[int, int], slots: int) -> np.ndarray:
    """Slots of the n-grams of ^host$ and of the path, which have their own prefixes."""
    grams = set()
    for kind, text in (("h", f"^{host}$"), ("p", path)):
        for n in range(sizes[0], sizes[1] + 1):
            grams.update(kind + text[i : i + n] for i in range(len(text) - n + 1))
    return np.array([xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass"), 7) % slots for g in grams], dtype=np.int64)


def train(rows=LABELLED_URLS, sizes=(3, 5), slots=1 << 16, epochs=200, rate=0.5, l2=3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient descent from zero, so the same on every run."""
    xs, y = [features(h, p, sizes, slots) for h, p, _ in rows], np.array([r[2] for r in rows], float)
    lengths = np.array([max(1, len(x)) for x in xs])
    row, col = np.repeat(np.arange(len(xs)), [len(x) for x in xs]), np.concatenate(xs)
    value = 1 / np.sqrt(lengths)[row]
    w, b = np.zeros(slots), 0.0
    for _ in range(epochs):
        z = np.bincount(row, w[col] * value, len(xs)) + b
        g = 1 / (1 + np.exp(-z)) - y
        w -= rate * (np.bincount(col, g[row] * value, slots) / len(xs) * len(xs) ** 0.5 + l2 * w)
        b -= rate * g.mean()
    return w, b


def judge_urls(pages: DataFrame, rules=RULES, labelled=LABELLED_URLS, sizes=(3, 5), slots=1 << 16, id_col="page_id", url_col="url") -> DataFrame:
    """page_id, host, path, rule, verdict, block_score of every row.

    A rule (verdict, host, path) fits its host and all subdomains if the path starts with
    its own; of several the longest wins. Without a rule the classifier decides: block if
    its probability is 0.5 or more. Null urls have empty host and path and go to the
    classifier like others. Ids may repeat or be null. The weights have a fixed size
    (slots), whatever the data.
    """
    spark = pages.sparkSession
    weights, bias = train(labelled, sizes, slots)
    model = spark.sparkContext.broadcast((weights.astype(np.float32), bias))
    ordered = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r))

    def run(cols: dict) -> dict:
        w, b = model.value
        hosts, paths, found, verdicts, scores = [], [], [], [], []
        for url in cols["url"].to_pylist():
            host, path = split_url(url)
            x = features(host, path, sizes, slots)
            score = float(1 / (1 + np.exp(-(w[x].sum() / max(1, len(x)) ** 0.5 + b))))
            rule = next((r for r in ordered if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])), None)
            hosts.append(host)
            paths.append(path)
            found.append(rule[1] + rule[2] if rule else None)
            verdicts.append(rule[0] if rule else "block" if score >= 0.5 else "allow")
            scores.append(score)
        return {"page_id": cols["page_id"], "host": hosts, "path": paths, "rule": found, "verdict": verdicts, "block_score": scores}

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    return map_rows(rows, f"page_id {dict(rows.dtypes)['page_id']}, host string, path string, rule string, verdict string, block_score double", run)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score (the classifier's probability of block, for
    every row) of every row of pages."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
