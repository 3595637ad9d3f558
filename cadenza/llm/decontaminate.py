"""Benchmark decontamination over a distributed positional inverted index.

Postings of training tokens (term, document, position) are stored for the rarest term of
every benchmark window; which term that is follows from counts over the whole corpus. A
posting carries the terms around its position, so the offset-adjusted intersection with the
lists of the next-rarest terms, and at last of all terms of the window, is made where the
posting lies, without moving another list. What passes is an exact phrase match; terms that
are only near each other are a proximity match. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, stash, unstash

WINDOW = 13
SPLITTER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in one block of a document; a block also holds the words around it.
BLOCK = 128


def _pieces(text: Column) -> Column:
    """Words with an empty string at an end where the text begins or ends with other characters."""
    return F.split(lower_ascii(text), SPLITTER)


def words(text: Column) -> Column:
    """Lower-case (A-Z) words of digits, letters and all characters from U+0080 on."""
    return F.filter(_pieces(text), lambda w: w != "")


def _count(p: Column) -> Column:
    return F.size(p) - (p[0] == "").cast("int") - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, w: array of words): windows of each item; fewer words than a window are one."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))))
    return items.select("item_id", "words", at.alias("i")).select("item_id", F.slice("words", F.col("i"), F.least(F.size("words"), F.lit(window))).alias("w")).distinct()


def _blocks(docs: DataFrame, reach: int) -> DataFrame:
    """(key, hash, lo, skip, block, p): blocks of BLOCK words, with up to ``reach`` words on both
    sides, so no row grows with its document's length."""
    d = docs.select("doc_id", F.xxhash64("text").alias("hash"), _pieces(F.col("text")).alias("p"))
    d = d.select("doc_id", "hash", "p", (F.col("p")[0] == "").cast("int").alias("skip"))
    d = d.select("doc_id", "hash", "skip", "p", F.explode(F.sequence(F.lit(0), F.greatest(F.size("p") - 1, F.lit(0)), F.lit(BLOCK))).alias("lo"))
    before = F.least(F.col("lo"), F.lit(reach))
    return d.select("doc_id", "hash", "skip", "lo", before.alias("before"), F.slice("p", F.col("lo") - before + 1, before + BLOCK + reach).alias("block"))


def index(docs: DataFrame, windows: DataFrame, reach: int = WINDOW - 1) -> tuple[DataFrame, DataFrame]:
    """(postings, anchored windows), both stored.

    postings: doc_id, hash (of the text), pos (from 0), term, around (the terms from
    ``reach`` before to ``reach`` after it), at (its place in around, from 1). anchored: item_id,
    w, term (the rarest of w; of equals the first in order), off (its offset in w), next (the
    offsets of the others, rarest first).
    """
    terms = stash(windows.select(F.explode("w").alias("term")).distinct(), "test-terms")
    tokens = docs.select(F.explode(_pieces(F.col("text"))).alias("term"))
    counts = tokens.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))
    freq = stash(terms.join(counts, "term", "left").na.fill(0, ["n"]), "term-counts")
    spots = windows.select("item_id", "w", F.posexplode("w").alias("off", "term")).join(freq, "term")
    ranked = spots.groupBy("item_id", "w").agg(F.sort_array(F.collect_list(F.struct("n", "term", "off"))).alias("r"))  # one window's terms
    # a window with a term that no document holds can't occur
    anchored = stash(ranked.where("r[0].n > 0").select("item_id", "w", F.col("r")[0]["term"].alias("term"), F.col("r")[0]["off"].alias("off"), F.slice("r.off", F.lit(2), F.size("r")).alias("next")), "test-windows")
    anchors = stash(anchored.select("term").distinct(), "anchors")
    b = _blocks(docs, reach)
    here = F.posexplode(F.slice("block", F.col("before") + 1, F.lit(BLOCK)))
    t = b.select("doc_id", "hash", "skip", "lo", "before", "block", here.alias("i", "term")).join(anchors, "term")
    first = F.greatest(F.col("before") + F.col("i") + 1 - reach, F.lit(1))
    postings = t.select(
        "doc_id", "hash", (F.col("lo") + F.col("i") - F.col("skip")).alias("pos"), "term",
        F.slice("block", first, F.col("before") + F.col("i") + 2 - first + reach).alias("around"), (F.col("before") + F.col("i") + 2 - first).alias("at"),
    )
    stored = stash(postings, "postings")
    unstash(terms, freq, anchors)
    return stored, anchored


def phrase_matches(postings: DataFrame, anchored: DataFrame) -> DataFrame:
    """doc_id, hash, item_id, start, stop (one past the end): every occurrence of a window."""
    both = postings.join(anchored, "term")
    lo = F.col("at") - F.col("off")  # where the window would begin in around
    inside = (lo >= 1) & (lo + F.size("w") - 1 <= F.size("around"))
    rarest = F.expr("size(next) = 0 OR around[at - off + next[0] - 1] = w[next[0]]")
    same = F.slice("around", lo, F.size("w")) == F.col("w")
    start = F.col("pos") - F.col("off")
    return both.where(F.when(inside, F.when(rarest, same).otherwise(False)).otherwise(False)).select("doc_id", "hash", "item_id", start.alias("start"), (start + F.size("w")).alias("stop"))


def proximity_matches(postings: DataFrame, anchored: DataFrame, terms: int = 3) -> DataFrame:
    """doc_id, item_id, pos: places of a window's rarest term with its next-rarest terms
    (``terms`` in all) anywhere within the index's reach."""
    rest = F.expr(f"forall(slice(next, 1, {int(terms) - 1}), o -> array_contains(around, w[o]))")
    return postings.join(anchored, "term").where(rest).select("doc_id", "item_id", "pos").distinct()


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, terms: int = 3) -> tuple[DataFrame, DataFrame]:
    """(phrases, near): phrase_matches() and proximity_matches() of every document and item.

    phrases: doc_id, hash, item_id, start, stop of each occurrence of a window of an item. near:
    doc_id, item_id, pos of each place of a window's rarest term that has the window's next-rarest
    terms (``terms`` in all, or as many as it has) within ``window`` - 1 words on either side, in any
    order. Null and empty texts and items match nothing.
    """
    full = docs.select("doc_id", "text").where("text IS NOT NULL")
    postings, anchored = index(full, stash(benchmark_windows(benchmark, window), "windows"), window - 1)
    return phrase_matches(postings, anchored), proximity_matches(postings, anchored, terms)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """doc_id, hash, n_words, n_hit, items (sorted as strings), contaminated of every row.

    A word is hit inside any occurrence of a window; a document is contaminated if it has a
    hit and ``share`` * n_hit >= n_words. Null and empty texts have no words; null items and
    items without words have no windows; an empty benchmark hits nothing. Repeated rows
    stay and get equal values, also those with a null doc_id. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    full = docs.where("text IS NOT NULL")
    windows = stash(benchmark_windows(benchmark, window), "windows")
    postings, anchored = index(full, windows, window - 1)
    found = phrase_matches(postings, anchored).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    spans = found.groupBy("key", "hash").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("s"), F.collect_set("item_id").alias("items"))  # as many as a text has places, or items
    state = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    hit = F.aggregate("s", state, lambda a, x: F.struct((a["n"] + F.greatest(x["stop"] - F.greatest(x["start"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], x["stop"]).alias("end")))
    hits = spans.select("key", "hash", hit["n"].cast("long").alias("n_hit"), F.sort_array(F.transform("items", lambda i: i.cast("string"))).alias("items"))
    base = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("key"), F.xxhash64("text").alias("hash"), F.coalesce(_count(_pieces(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    out = base.join(hits, ["key", "hash"], "left").na.fill(0, ["n_hit"])
    return out.select("doc_id", "hash", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without the contaminated ones."""
    bad = contamination(docs, benchmark).where("contaminated").select("doc_id", "hash").distinct()
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    return hashed.join(bad, hashed["doc_id"].eqNullSafe(bad["doc_id"]) & (hashed["__hash"] == bad["hash"]), "left_anti").drop("__hash")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of documents; see
    contamination() for nulls, empty texts and repeated rows."""
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
