"""Toxicity by class-conditional Kneser-Ney models.

Each class c (toxic, ordinary) has a bigram model with the largest discounts that modified
Kneser-Ney allows (1, 2 and 3 for counts of one, two and more; so least(count, 3)):

    P_c(w | v) = max(n_c(v w) - 3, 0) / n_c(v) + back_c(v) * P_c(w)
    P_c(w)     = max(u_c(w) - 3, 0) / U_c      + back_c    * S(w)

n_c counts the class's texts that hold a pair of neighbouring words, u_c(w) the different
words that precede w in the class, and the weights back_* are the discounted mass. S, the
last backoff, is shared by the classes: the continuation counts over both. So an expression
that neither class knows well says the same for both. The first word follows a mark.

A text is scored by the difference of its toxic and ordinary log-likelihoods divided by its
length, beside the mean of its two strongest words (a long text may hold few toxic
expressions); a logistic curve fitted on a fold that the counts have not seen turns both
into a probability.

As in n-gram files, log P_c(w | v) is a sum of entries found by key: the word's, the backoff
weight of the word before, and for pairs beyond the discount an excess. So the model is a
table of entries (64-bit hashes of words and pairs) that grows with the corpus, joined to
the texts' expressions. The HOT most frequent entries and a bit filter of all keys are
broadcast, both of fixed size: expressions that these settle are summed where the text is
read, the others meet their entries in the join. The result does not depend on either size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_filter, may_hold, process_memory, release, small_batches, stash, unstash

DISCOUNT = 3.0
#: Labelled rows of the calibration fold that the curve is fitted on at most, by a hash of the id.
CALIBRATION_ROWS = 20_000
#: Entries that are broadcast, and bits of the broadcast filter of all keys (powers of two).
HOT, FILTER_BITS = 1 << 20, 1 << 26
#: Passes over the counted texts, each for its share of the pairs; the disk that pairs take is divided by it.
SLICES = 2
#: Strongest words that are averaged.
STRONGEST = 2
#: Words, and hashes of texts, that a worker remembers; pairs that a task adds up before they are sent.
MEMORY, PAIRS = 1 << 18, 1 << 19
#: What the first word of a text follows.
START = 0x51ED270B7F3A9C45
WORDS = re.compile(r"[^\W_]+").findall


def fold(id_col: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % 5


class _Hashes(dict):
    """Words to hashes."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 3)
        return h


def hashes(text: str | None) -> np.ndarray:
    """Hash of every word of the whole text, in its order."""
    known = process_memory("words").setdefault("toxic", _Hashes())
    words = WORDS((text or "").lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def before(h: np.ndarray) -> np.ndarray:
    """What each word follows."""
    return np.concatenate([np.array([START], np.uint64), h[:-1]])[: len(h)]


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Key of a pair of neighbours; both are hashes already, so turning one tells the order."""
    return (v << np.uint64(21) | v >> np.uint64(43)) ^ w


def _pair_key(v: Column, w: Column) -> Column:
    return F.shiftleft(v, 21).bitwiseOR(F.shiftrightunsigned(v, 43)).bitwiseXOR(w)


def count_pairs(labelled: DataFrame, part: int = 0, parts: int = 1, flush: int = PAIRS) -> DataFrame:
    """(v, w, a, b): ordinary and toxic texts that hold the neighbours v w, for the pairs of one
    of ``parts`` parts (a power of two). labelled: (text, toxic). A task adds up its rows
    before it sends them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> pa.RecordBatch:
            v, w, c = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            _, first, at = np.unique(pair_key(v, w), return_index=True, return_inverse=True)
            b = np.bincount(at, c, len(first)).astype(np.int64)
            a = np.bincount(at, minlength=len(first)) - b
            order = np.lexsort((v[first], w[first]))  # equal words side by side take less room
            first = first[order]
            return pa.RecordBatch.from_pydict({"v": v[first].view(np.int64), "w": w[first].view(np.int64), "a": a[order], "b": b[order]})

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = hashes(text)
                if not len(w):
                    continue
                v = before(w)
                keys, first = np.unique(pair_key(v, w), return_index=True)
                first = first[keys >> np.uint64(40) & np.uint64(parts - 1) == part] if parts > 1 else first
                held.append((v[first], w[first], np.full(len(first), toxic, np.int64)))
            if sum(len(x[0]) for x in held) >= flush:
                yield out()
        if sum(len(x[0]) for x in held):
            yield out()

    small_batches(labelled.sparkSession)
    rows = labelled.select("text", "toxic").mapInArrow(run, "v long, w long, a long, b long")
    return rows.groupBy("v", "w").agg(F.sum("a").cast("int").alias("a"), F.sum("b").cast("int").alias("b"))


def gather(labelled: DataFrame, discount: float = DISCOUNT, parts: int = SLICES, flush: int = PAIRS) -> tuple[DataFrame, DataFrame]:
    """(words, pairs), stored: of every word x the sums that the formulas need (ca, cb: counts
    before any word, ma, mb: the discounted part of them, ua, ub, n: different words that
    precede it, by class and in all), and (v, w, a, b) of the pairs beyond the discount."""
    least = lambda c: F.least(F.col(c).cast("double"), F.lit(discount))
    zero, null, none = F.lit(0), F.lit(None).cast("long"), F.lit(0.0)
    names = ("x", "y", "ca", "cb", "ma", "mb", "ua", "ub", "n")
    row = lambda *v: F.struct(*(c.alias(x) for c, x in zip(v, names, strict=True)))
    a, b = F.col("a"), F.col("b")
    both = F.array(row(F.col("v"), null, a, b, least("a"), least("b"), zero, zero, zero), row(F.col("w"), null, zero, zero, none, none, (a > 0).cast("int"), (b > 0).cast("int"), F.lit(1)))
    pair = F.array(row(F.col("v"), F.col("w"), a, b, none, none, zero, zero, zero))
    found = []
    for i in range(parts):
        counts = count_pairs(labelled, i, parts, flush)
        rows = counts.select(F.inline(F.when((a > discount) | (b > discount), F.concat(both, pair)).otherwise(both)))
        found.append(stash(rows.groupBy("x", "y").agg(*(F.sum(c).alias(c) for c in names[2:])), f"toxic-counts-{i}"))
        release(labelled.sparkSession)
    every = found[0]
    for x in found[1:]:
        every = every.union(x)
    words = stash(every.where("y IS NULL").groupBy("x").agg(*(F.sum(c).alias(c) for c in names[2:])), "toxic-words")
    pairs = stash(every.where("y IS NOT NULL").select(F.col("x").alias("v"), F.col("y").alias("w"), F.col("ca").alias("a"), F.col("cb").alias("b")), "toxic-pairs")
    unstash(*found)
    return words, pairs


def entries(words: DataFrame, pairs: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, float]:
    """(key, low, back, n) of every word and pair that a class has beyond the discount, stored,
    and the ``low`` of all other words.

    A word's low is log P_toxic(w) - log P_ordinary(w), its back that of the weights behind it;
    a pair's low is what its log-likelihoods differ by beyond those two. n orders by frequency.
    """
    least = lambda c: F.least(F.col(c).cast("double"), F.lit(discount))
    sums = words.agg(F.count_if(F.col("n") > 0).alias("size"), *(F.coalesce(x, F.lit(0)).cast("double").alias(n) for n, x in {"n": F.sum("n"), "a": F.sum("ua"), "b": F.sum("ub"), "la": F.sum(least("ua")), "lb": F.sum(least("ub"))}.items())).first()
    back0 = {c: sums[f"l{c}"] / sums[c] if sums[c] else 1.0 for c in "ab"}
    shared = (F.col("n") + 1 / max(sums["size"], 1)) / (sums["n"] + 1)

    def low(c: str) -> Column:
        return F.greatest(F.col(f"u{c}") - discount, F.lit(0.0)) / max(sums[c], 1.0) + back0[c] * shared

    def back(c: str) -> Column:
        return F.when(F.col(f"c{c}") > 0, F.col(f"m{c}") / F.col(f"c{c}")).otherwise(1.0)

    known = words.select("x", "ua", "ub", "ca", "cb", low("a").alias("pa"), low("b").alias("pb"), back("a").alias("ba"), back("b").alias("bb"))
    differ = (F.log("pb") - F.log("pa")).alias("low"), (F.log("bb") - F.log("ba")).alias("back")
    beyond = (F.col("ua") > discount) | (F.col("ub") > discount) | (F.col("ba") < 1) | (F.col("bb") < 1)
    one = known.where(beyond).select(F.col("x").alias("key"), *differ, (F.col("ca") + F.col("cb")).alias("n"))
    both = pairs.join(known.select(F.col("x").alias("w"), "pa", "pb"), "w").join(known.select(F.col("x").alias("v"), "ca", "cb", "ba", "bb"), "v")
    p = lambda c: F.greatest(F.col(c) - discount, F.lit(0.0)) / F.greatest(F.col(f"c{c}"), F.lit(1)) + F.col(f"b{c}") * F.col(f"p{c}")
    excess = F.log(p("b")) - F.log(p("a")) - (F.log("pb") - F.log("pa")) - (F.log("bb") - F.log("ba"))
    two = both.select(_pair_key(F.col("v"), F.col("w")).alias("key"), excess.alias("low"), F.lit(0.0).alias("back"), (F.col("a") + F.col("b")).alias("n"))
    return stash(one.union(two), "toxic-model"), float(np.log(back0["b"]) - np.log(back0["a"]))


class Model:
    """The table of entries, the broadcast parts and the curve's weights."""

    def __init__(self, table: DataFrame, other: float, hot: int = HOT, bits: int = FILTER_BITS):
        spark = table.sparkSession
        self.table, self.other, self.weights = table.select("key", "low", "back"), other, np.array([0.0, 0.0, -1.0])
        top = table.orderBy(F.desc("n"), "key").limit(hot).select("key", "low", "back").toArrow()  # at most ``hot`` rows
        known = bit_filter(table.select("key"), bits)
        key = top.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        self.shared = spark.sparkContext.broadcast((key[order], top.column("low").to_numpy()[order], top.column("back").to_numpy()[order], known))


def _batch(texts: list, marks: list, model: tuple, other: float, strongest: int) -> dict:
    """Rows of features(): one base row (kind 0) for each text, one (1: word, 2: pair) for each
    expression that the broadcast parts don't settle."""
    hot, low, back, known = model
    sets = [hashes(t) for t in texts]
    n = np.array([len(s) for s in sets], np.int64)
    w = np.concatenate(sets)
    v = np.concatenate([before(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), n)
    total, top = np.zeros(len(sets)), [[] for _ in sets]
    rows: list[tuple[np.ndarray, ...]] = []

    def found(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(hot):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
        return at, hot[at] == keys

    maybe = lambda keys: may_hold(known, keys)

    def rest(kind: int, keys: np.ndarray, of: np.ndarray, c: np.ndarray, d: np.ndarray) -> None:
        order = np.lexsort((keys, of))
        keys, of, c, d = keys[order], of[order], c[order], d[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])])) if len(keys) else np.zeros(0, np.int64)
        if len(first):
            rows.append((np.full(len(first), kind), keys[first], of[first], np.add.reduceat(c, first), np.add.reduceat(d, first)))

    at, hit = found(w)
    gain = np.where(hit, low[at] if len(hot) else 0.0, other)
    tail = ~hit & maybe(w)
    total += np.bincount(doc[~tail], gain[~tail], len(sets))
    strong = np.flatnonzero(hit & (gain > other))
    for i, x in sorted(set(zip(doc[strong].tolist(), at[strong].tolist(), strict=True))):
        top[i].append(float(low[x]) - other)
    at_v, hit_v = found(v)
    total += np.bincount(doc[hit_v], back[at_v[hit_v]], len(sets)) if hit_v.any() else 0
    tail_v = ~hit_v & maybe(v)
    keys, of = np.concatenate([w[tail], v[tail_v]]), np.concatenate([doc[tail], doc[tail_v]])
    ones = np.arange(len(keys)) < tail.sum()
    rest(1, keys, of, ones.astype(np.int64), (~ones).astype(np.int64))
    pair = pair_key(v, w)
    at, hit = found(pair)
    total += np.bincount(doc[hit], low[at[hit]], len(sets)) if hit.any() else 0
    tail = ~hit & maybe(pair)
    rest(2, pair[tail], doc[tail], np.ones(tail.sum(), np.int64), np.zeros(tail.sum(), np.int64))
    base = np.flatnonzero(n)
    marks = np.array(marks, np.int64)
    kind, key, of, c, d = (np.concatenate(x) for x in zip((np.zeros(len(base), np.int64), marks[base].view(np.uint64), base, np.zeros(len(base), np.int64), np.zeros(len(base), np.int64)), *rows, strict=True))
    blank = np.zeros(len(kind) - len(base))
    tops = [sorted(top[i], reverse=True)[:strongest] for i in base] + [None] * len(blank)
    return {"t": marks[of], "kind": kind.astype(np.int8), "key": key.view(np.int64), "c": c.astype(np.int32), "d": d.astype(np.int32), "n": np.concatenate([n[base], blank.astype(np.int64)]), "total": np.concatenate([total[base], blank]), "top": tops}


def features(docs: DataFrame, model: Model, text_col: str = "text", strongest: int = STRONGEST) -> DataFrame:
    """(t: hash of the text, mean, top) of every different text that has words: the difference of
    the log-likelihoods divided by the number of words, and the mean of what the strongest
    different words differ by beyond an unknown one (none: 0).

    A task reads equal texts once; if others read them too, sums and lengths grow alike.
    """
    shared, other = model.shared, model.other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            new = {}
            for t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t not in seen and text:
                    new[t] = text
            if len(seen) + len(new) > MEMORY:
                seen.clear()
            seen.update(new)
            if new:
                out = _batch(list(new.values()), list(new), shared.value, other, strongest)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in kinds], schema=kinds)

    kinds = pa.schema([("t", pa.int64()), ("kind", pa.int8()), ("key", pa.int64()), ("c", pa.int32()), ("d", pa.int32()), ("n", pa.int64()), ("total", pa.float64()), ("top", pa.list_(pa.float64()))])
    small_batches(docs.sparkSession)
    rows = docs.select(F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text")).mapInArrow(run, "t long, kind byte, key long, c int, d int, n long, total double, top array<double>")
    table = model.table.withColumnRenamed("key", "k")
    met = rows.join(table, (F.col("key") == F.col("k")) & (F.col("kind") > 0), "left")
    low = F.coalesce("low", F.when(F.col("kind") == 1, F.lit(other)).otherwise(0.0))
    gain = F.when(F.col("kind") == 0, F.col("total")).otherwise(F.col("c") * low + F.col("d") * F.coalesce("back", F.lit(0.0)))
    strong = F.when((F.col("kind") == 1) & (F.col("c") > 0) & (low > other), F.struct((low - other).alias("g"), F.col("key").alias("k")))
    out = met.groupBy("t").agg(F.sum(gain).alias("gain"), F.sum("n").alias("n"), F.max(F.when(F.col("kind") == 0, F.col("top"))).alias("top"), F.collect_set(strong).alias("set"))  # a text's words that speak for toxic
    tops = F.slice(F.sort_array(F.concat(F.coalesce("top", F.array().cast("array<double>")), F.transform("set", lambda x: x["g"])), asc=False), 1, strongest)
    return out.select("t", (F.col("gain") / F.col("n")).alias("mean"), (F.aggregate(tops, F.lit(0.0), lambda x, y: x + y) / strongest).alias("top"))


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, discount: float = DISCOUNT, rows: int = CALIBRATION_ROWS, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, bits: int = FILTER_BITS) -> Model:
    """The model, from labelled rows that are not held out.

    Folds 1 to 3 are counted, all of them; fold 4 calibrates. Equal texts count once, with
    the label that most of them have, so a group of copies doesn't speak for itself alone.
    Labels other than 0 and 1 and null ids are passed over; of several labels of one id 1 wins.
    Without labelled rows of both kinds the model knows nothing: every score is below 0.5.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where((fold() != 0) & F.col("text").isNotNull())
    texts = texts.select("doc_id", "text", F.xxhash64("text").alias("h"))
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold() != 0).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = texts.select("doc_id", "h", F.xxhash64(F.reverse(F.substring("text", 1, 1000)), F.length("text")).alias("g")).join(known, "doc_id")
    once = stash(marks.groupBy("h", "g").agg(F.min("doc_id").alias("doc_id"), F.round(F.avg("toxic")).cast("int").alias("toxic")), "toxic-labels").drop("g")
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(bit_filter(once.select(F.col("h").alias("key")), bits))

    @F.pandas_udf("boolean")
    def labelled(h: pd.Series) -> pd.Series:
        return pd.Series(may_hold(held.value, h.to_numpy(np.int64).view(np.uint64)))

    # only texts that the filter lets through are moved; never a broadcast, as labels grow with the corpus
    rest = texts.where((fold() != 4) & labelled("h")).join(once.where(fold() != 4).hint("merge"), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    rest = stash(rest.select("text", "toxic"), "toxic-texts")
    release(spark)
    words, pairs = gather(rest, discount)
    table, other = entries(words, pairs, discount)
    unstash(rest, words, pairs)
    release(spark)
    model = Model(table, other, hot, bits)
    ids = once.where(fold() == 4).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    few = stash(texts.join(F.broadcast(ids), ["doc_id", "h"]).select("text", "toxic", "h"), "toxic-curve")  # at most ``rows`` ids
    found = few.dropDuplicates(["h"]).join(features(few, model).withColumnRenamed("t", "h"), "h", "left").na.fill(0.0, ["mean", "top"])
    sample = found.select("mean", "top", F.col("toxic").cast("double").alias("toxic")).toArrow()  # at most ``rows`` rows
    unstash(few)
    y = sample.column("toxic").to_numpy()
    if len(np.unique(y)) > 1:
        model.weights = fit_curve(np.stack([sample.column(c).to_numpy() for c in ("mean", "top")], axis=1), y)
    return model


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds score double (0 to 1) from the whole text; null texts and texts without words get the
    score of no evidence. Repeated rows stay. Other columns stay and are no inputs."""
    w = model.weights
    rest = [c for c in docs.columns if c != score_col]
    found = stash(features(docs, model, text_col), "toxic-features")
    release(docs.sparkSession)
    found = found.select(F.col("t").alias("__t"), F.col("mean").alias("__mean"), F.col("top").alias("__top"))
    z = F.coalesce("__mean", F.lit(0.0)) * float(w[0]) + F.coalesce("__top", F.lit(0.0)) * float(w[1]) + float(w[2])
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return docs.select(*rest, F.xxhash64(text_col).alias("__t")).join(found, "__t", "left").select(*rest, score.alias(score_col))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 if score is
    0.5 or more) of every row of documents; see score_texts() for null and empty texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score_texts(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
