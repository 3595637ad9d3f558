"""Line dedup: fuzzy lines by MinHash.

Equal lines are one node. A line's signature has the least element of its hashed character
shingles under each of a number of orders (the distance by exclusive or to a fixed point,
so an order costs one operation on a shingle); bands of it bring similar lines together
with high recall; pairs are verified by the exact Jaccard similarity of their shingles;
verified links form components by distributed union-find, and each component keeps its
first line. DataFrame functions only.

Within a band's bucket not all pairs are made. Every line is compared with the bucket's
most copied line; components are formed; after that only lines of one bucket that are still
in different components are compared, all of them. So no link between components is lost,
and a bucket of thousands of versions of one line costs a comparison for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, one_file_shuffles, release, stash, unstash

SHINGLE, THRESHOLD = 8, 0.8
#: Least elements in a signature, as a square of GRID x GRID; bands are its rows, columns and
#: diagonals (lines of the affine plane of order 4: no two bands share more than one value).
#: A pair is missed only if all bands are hit by a difference: about once in a hundred times
#: at similarity 0.8, once in several thousand at 0.9.
GRID, CLASSES = 4, 4
#: Words of 64 bits in a sketch; a power of two.
WORDS = 32
#: Shingles reduced at once before they reach a line's signature.
TOGETHER = 8
#: First bits that a shingle shares with an order's point if it counts as near. A cell without a near shingle
#: holds what its row's diagonal cell holds, so of most shingles it is only asked whether they are near: a guess that
#: processors get right, unlike which of a few shingles is the nearest. Simulated, pairs are missed as often as without.
NEAR_BITS = 4
#: What a blank line may hold.
BLANK = " \t\r\x0b\x0c"
#: Bits of line_id below its count of copies.
ID_BITS = 53


def _points(n: int) -> list[int]:
    """Fixed points of the orders, spread evenly by their first bits."""
    out, x = [], 0x9E3779B97F4A7C15
    for i in range(n):
        x = (x * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64)
        y = ((i << 58) * 64 // max(n, 1) % (1 << 64)) ^ (x >> 6)
        out.append(y - (1 << 64) if y >= 1 << 63 else y)
    return out


def _units(line: Column) -> Column:
    return F.encode(line, "UTF-16BE")


def _shingle(units: Column, i: Column, k: int) -> Column:
    """Hash of the k UTF-16 units from the i-th (from 1) on."""
    return F.xxhash64(F.substring(units, 2 * i - 1, F.lit(2 * k)))


def let(value: Column, use) -> Column:
    """use(value) with value computed once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), use)[0]


def shingles(units: Column, k: int = SHINGLE) -> Column:
    """Shingles of a line, repeats included. Only the hashing is in a lambda."""
    last = lambda u: F.greatest(F.octet_length(u) - (2 * k - 1), F.lit(1))
    return let(units, lambda u: F.transform(F.sequence(F.lit(1), last(u), F.lit(2)), lambda i: F.xxhash64(F.substring(u, i, F.lit(2 * k)))))


def shingle_set(units: Column, k: int = SHINGLE) -> Column:
    """Different shingles of a line: compiled, with sets of longs that need no objects."""
    return F.array_distinct(shingles(units, k))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of different values."""
    return let(a, lambda x: let(b, lambda y: let(F.size(F.array_intersect(x, y)), lambda n: n / (F.size(x) + F.size(y) - n))))


def band_cells(grid: int = GRID, classes: int = CLASSES) -> list[list[int]]:
    """Cells of each band: rows, columns, then lines of other slopes (in GF(4) for grid 4)."""
    times = lambda a, b: [0, 0, 0, 0, 0, 1, 2, 3, 0, 2, 3, 1, 0, 3, 1, 2][4 * a + b] if grid == 4 else a * b % grid
    plus = lambda a, b: a ^ b if grid == 4 else (a + b) % grid
    out = [[grid * x + y for y in range(grid)] for x in range(grid)] if classes else []
    for slope in range(classes - 1):
        out += [[grid * x + plus(times(slope, x), c) for x in range(grid)] for c in range(grid)]
    return out


def _band_bits(count: int) -> int:
    """Lowest bits of a band that tell which of a line's bands it is."""
    return (count - 1).bit_length()


def _lines(docs: DataFrame) -> DataFrame:
    """Lines of the texts, which are not null. Outer, as the optimizer would split every text once more to ask for a size above 0.
    The hash is a step of its own: what stands beside an explode is computed for every row that it makes."""
    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").select("doc_id", "hash", F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))


def _key(line: Column) -> list[Column]:
    """128 bits of a line as two numbers, so that what is grouped by them needs no sort."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def _filled(line: Column) -> Column:
    """Whether a line has more than spaces, tabs, carriage returns, vertical tabs and form feeds."""
    return F.ltrim(line, F.lit(BLANK)) != ""  # up to the first other character; trim would also look for the end


def signatures(docs: DataFrame, k: int = SHINGLE, grid: int = GRID, classes: int = CLASSES) -> DataFrame:
    """(line_id, k1, k2, first: struct<none, doc_id, hash, pos>, copies, bands: array<long>) of every
    different line that is not blank, stored. A smaller line_id has more copies.

    Equal lines meet in one shuffle; the shingles are made and reduced where they met, in a hash
    map whose keys and values all have a fixed width.
    """
    place = ("none", "doc_id", "hash", "pos")
    lines = _lines(docs).where(_filled(F.col("line")))
    once = lines.groupBy(*_key(F.col("line"))).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "pos")).alias("first"), F.any_value("line").alias("line"), F.count("*").alias("copies"))
    s = once.select("k1", "k2", *(F.col(f"first.{c}").alias(c) for c in place), "copies", _units(F.col("line")).alias("u"))
    # some shingles at a time, as an update of the hash map costs more than a shingle; the last one fills up.
    # What a line has once is part of the key, or it would be updated too
    last = F.greatest((F.octet_length("u") / 2).cast("int") - (k - 1), F.lit(1))
    s = s.select("*", last.alias("last")).select("*", F.explode_outer(F.sequence(F.lit(1), F.col("last"), F.lit(TOGETHER))).alias("i"))
    some = [f"h{m}" for m in range(TOGETHER)]
    s = s.select("k1", "k2", *place, "copies", *(_shingle(F.col("u"), F.least(F.col("i") + m, F.col("last")), k).alias(h) for m, h in enumerate(some)))
    near, diagonal = F.lit((1 << 64 - NEAR_BITS) - (1 << 63)), [j // grid * (grid + 1) for j in range(grid * grid)]
    least = s.groupBy("k1", "k2", *place, "copies").agg(*(F.min(F.least(*[near] * (diagonal[j] != j), *(F.col(h).bitwiseXOR(F.lit(p)) for h in some))).alias(f"s{j}") for j, p in enumerate(_points(grid * grid))))
    least = least.select("k1", "k2", *place, "copies", *(F.when(F.col(f"s{j}") < near, F.col(f"s{j}")).otherwise(F.col(f"s{d}")).alias(f"s{j}") for j, d in enumerate(diagonal)))
    cells = band_cells(grid, classes)
    bits = _band_bits(len(cells))
    bands = F.array(*(F.shiftleft(F.xxhash64(F.lit(b), *(f"s{c}" for c in own)), bits) + F.lit(b) for b, own in enumerate(cells)))
    rank = F.shiftleft(1023 - F.least("copies", F.lit(1023)), ID_BITS)
    return stash(least.select((rank + F.monotonically_increasing_id()).alias("line_id"), "k1", "k2", F.struct(*place).alias("first"), "copies", bands.alias("bands")), "line-signatures", dictionary=False)


def texts_of(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """(line_id, line) of the lines, read from their first places, stored."""
    at = lines.select("line_id", "first.doc_id", "first.hash", "first.pos")
    key = lambda c: F.coalesce(c, F.lit(-(1 << 63)).cast("long")).alias("k")
    places = at.groupBy(key(F.col("doc_id")), "hash").agg(F.collect_list(F.struct("line_id", "pos")).alias("p"))  # as many as a text has lines
    found = docs.select(key(F.col("doc_id").cast("long")), F.xxhash64("text").alias("hash"), "text").join(places.hint("shuffle_hash"), ["k", "hash"])
    picked = found.select(let(F.split("text", "\n"), lambda parts: F.transform("p", lambda x: F.struct(x["line_id"].alias("line_id"), F.get(parts, x["pos"]).alias("line")))).alias("t"))
    return stash(picked.select(F.inline("t")).dropDuplicates(["line_id"]), "line-texts")


def verify(pairs: DataFrame, text: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs (u, v) of line_ids whose lines are similar enough."""
    a = pairs.join(text.select(F.col("line_id").alias("u"), _units(F.col("line")).alias("a")), "u")
    both = a.join(text.select(F.col("line_id").alias("v"), _units(F.col("line")).alias("b")), "v")
    # not let(): plain expressions are compiled, and what they have in common is computed once
    x, y = shingles(F.col("a"), k), shingles(F.col("b"), k)  # both array functions leave repeats out
    union = F.size(F.array_union(x, y))
    # with repeats the sets' sizes are no smaller, so by the union alone most of the others are certain not to be links
    may = union * (1 + threshold) <= F.size(x) + F.size(y) + 0.000001
    return both.where(F.when(may, F.size(F.array_intersect(x, y)) / union) >= threshold).select("u", "v")


def sketches(text: DataFrame, k: int = SHINGLE, words: int = WORDS) -> DataFrame:
    """(line_id, n, w0, w1, ...: long): the number of different shingles of each line, and one
    bit of 64 * words set for each by its hash. Columns, not an array: the join on them then
    compiles to a few plain operations."""
    s = text.select("line_id", _units(F.col("line")).alias("u")).select("line_id", shingle_set(F.col("u"), k).alias("s"))
    s = s.select("line_id", F.size("s").alias("n"), F.explode_outer("s").alias("h"))  # never empty; see _lines
    at, bit = F.expr(f"cast(shiftright(h, 6) & {words - 1} AS int)"), F.expr("shiftleft(1L, cast(h & 63 AS int))")
    return s.groupBy("line_id", "n").agg(*(F.coalesce(F.bit_or(F.when(at == j, bit).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long")).alias(f"w{j}") for j in range(words)))


#: Whether a band is the first that two lines share: bands of one place are compared.
FIRST_SHARED = "array_position(zip_with(ba, bb, (p, q) -> p = q), true) = nr + 1"


def across(members: DataFrame, sketch: DataFrame, threshold: float, words: int = WORDS, first_shared: str = FIRST_SHARED) -> DataFrame:
    """(u, v): pairs of one band and different roots that may be similar enough, each from the
    first of the bands it shares (only there, so the rows are not made once for each band), stored.

    Bits in which two sketches differ each stand for a shingle that only one line has, so
    they are no more than the sets' symmetric difference, which similarity t bounds by
    (1 - t) / (1 + t) of both sizes. What is left out is certain not to be a link.
    """
    m = stash(members.join(sketch, "line_id"), "sketched-buckets", dictionary=False)
    # a set number of tasks: by their bytes alone small tables would be one task, whatever the pairs
    m, stored = m.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "band"), m
    a = m.select("band", F.col("root").alias("ra"), F.col("line_id").alias("x"), F.col("n").alias("na"), "nr", F.col("bands").alias("ba"), *(F.col(f"w{j}").alias(f"a{j}") for j in range(words)))
    b = m.select("band", F.col("root").alias("rb"), F.col("line_id").alias("y"), F.col("n").alias("nb"), F.col("bands").alias("bb"), *(F.col(f"w{j}").alias(f"b{j}") for j in range(words)))
    most = f"{1 - threshold}D * (na + nb) + 0.000001D"
    differ = " + ".join(f"bit_count(a{j} ^ b{j})" for j in range(words))
    both = a.join(b, (a["band"] == b["band"]) & F.expr(f"ra < rb AND {1 + threshold}D * abs(na - nb) <= {most} AND {1 + threshold}D * ({differ}) <= {most} AND {first_shared}"))
    pairs = stash(both.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")), "cross-pairs")
    unstash(stored)
    release(members.sparkSession)
    return pairs


def joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(line_id, root) after further links (u, v) between components: these are joined by their
    roots, so that lines already in a component are not gone through again."""
    named = lambda c: roots.select(F.col("line_id").alias(c), F.col("root").alias(f"r{c}"))
    ends = more.join(named("u"), "u", "left").join(named("v"), "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    over = connected_components(ends, "line-cc-2").select(F.col("node").alias("line_id"), F.col("root").alias("over"))
    moved = roots.join(over.withColumnRenamed("line_id", "root"), "root", "left").select("line_id", F.coalesce("over", "root").alias("root"))
    return moved.union(over.join(roots, "line_id", "left_anti").select("line_id", F.col("over").alias("root")))


def shared_bands(b: DataFrame) -> DataFrame:
    """The rows (band, line_id) of b whose band another line has, too. Most bands have one line: that is seen
    sooner by looking for another one than by counting all bands in two hash maps. One exchange serves
    both sides, as long as neither is dealt out by repartition()."""
    other = b.alias("other").hint("shuffle_hash")
    return b.alias("own").join(other, F.expr("own.band = other.band AND own.line_id <> other.line_id"), "left_semi").select("own.band", "own.line_id")


def similar_lines(lines: DataFrame, docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(line_id, root): lines in a component with another one, by the component's least line_id; and the
    rows of the lines that share a band, all those among them, without their bands, stored."""
    spark = lines.sparkSession
    count = len(band_cells())
    shared = stash(shared_bands(lines.select("line_id", F.explode("bands").alias("band"))), "shared-bands")
    release(spark)
    stats = shared.groupBy("band").agg(F.count("*").alias("n"), F.min("line_id").alias("hub"))
    nr = F.col("band").bitwiseAND(F.lit((1 << _band_bits(count)) - 1)).cast("int").alias("nr")
    live = stash(shared.join(stats.hint("shuffle_hash"), "band").select("band", nr, "line_id", "n", "hub"), "line-buckets")
    unstash(shared)
    release(spark)
    pairs = live.where("line_id <> hub").select(F.col("hub").alias("u"), F.col("line_id").alias("v")).distinct()
    met = stash(lines.drop("bands").join(live.select("line_id").distinct().hint("shuffle_hash"), "line_id", "left_semi"), "met-lines")
    release(spark)
    text = texts_of(met, docs)
    release(spark)
    links = stash(verify(pairs, text, k, threshold), "star-links")
    release(spark)
    roots = connected_components(links, "line-cc").select(F.col("node").alias("line_id"), "root")
    rest = live.where("n > 2").join(roots, "line_id", "left").select("band", "nr", "line_id", F.coalesce("root", "line_id").alias("root"), "hub")
    split = rest.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("band")
    open_ = stash(rest.join(split, "band"), "open-buckets")
    unstash(live)
    release(spark)
    ids = open_.select("line_id").distinct()
    # lines of different components share open bands only, so the others may be null
    bands = open_.groupBy("line_id").agg(*(F.max(F.when(F.col("nr") == j, F.col("band"))).alias(f"b{j}") for j in range(count)))
    drawn = sketches(text.join(ids, "line_id", "left_semi"), k).join(bands.select("line_id", F.array(*(f"b{j}" for j in range(count))).alias("bands")), "line_id")
    maybe = across(open_.where("line_id <> hub").drop("hub"), drawn, threshold)
    more = stash(verify(maybe, text, k, threshold), "cross-links")
    unstash(text, open_, maybe)
    release(spark)
    return roots if more.isEmpty() else joined(roots, more), met


def removed_lines(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, hash, removed: array of line numbers from 0): lines that are not the first of
    their component, for every text that has any."""
    docs = docs.select("doc_id", "text").where("text IS NOT NULL")
    lines = signatures(docs, k)
    release(docs.sparkSession)
    roots, met = similar_lines(lines, docs, k, threshold)
    release(docs.sparkSession)
    # lines of one copy matter in components only, so the others of them need not be dealt out
    some = stash(lines.drop("bands").where("copies > 1").union(met.where("copies = 1").select(*lines.drop("bands").columns)), "some-lines")
    named = some.join(roots.hint("shuffle_hash"), "line_id", "left").where("copies > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "line_id"))
    firsts = named.groupBy("root").agg(F.min("first").alias("kept"), F.sum("copies").alias("all")).where("all > 1")
    marks = stash(named.join(firsts, "root").select("k1", "k2", F.col("kept.doc_id").alias("kd"), F.col("kept.hash").alias("kh"), F.col("kept.pos").alias("kp")), "line-marks")
    unstash(lines, met, some)
    release(docs.sparkSession)
    here = _lines(docs).where(_filled(F.col("line"))).select("doc_id", "hash", "pos", *_key(F.col("line")))
    gone = here.join(marks.hint("shuffle_hash"), ["k1", "k2"]).where(~(F.col("doc_id").eqNullSafe(F.col("kd")) & (F.col("hash") == F.col("kh")) & (F.col("pos") == F.col("kp"))))
    return gone.groupBy("doc_id", "hash").agg(F.collect_set("pos").alias("removed"))  # as many as a text has lines


def dedup_lines(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs with text reduced to its kept lines, and n_lines, n_removed.

    Lines are what line feeds separate. A line is a near-duplicate of another if the Jaccard
    similarity of their sets of k-character shingles (UTF-16 units; a shorter line is one
    shingle) is ``threshold`` or more; of each component of such lines the first one in the
    order of doc_id and place stays (null ids last, of equal ids by a hash of the text).
    Blank lines (nothing but space, tab, carriage return, vertical tab, form feed) are kept as
    they are; a line's carriage return is part of it. Null texts stay null with no lines, an empty text has
    one blank line. Equal rows are one document: they keep the same lines. A document all
    of whose lines go stays with an empty text.
    """
    one_file_shuffles(docs.sparkSession)
    gone = removed_lines(docs, k, threshold)
    gone = gone.select(F.col("doc_id").alias("__d"), F.col("hash").alias("__h"), F.col("removed").alias("__gone"))
    base = docs.drop("n_lines", "n_removed").withColumn("__t", F.xxhash64("text"))
    out = base.join(gone.hint("shuffle_hash"), base["doc_id"].eqNullSafe(gone["__d"]) & (base["__t"] == gone["__h"]), "left")
    out, parts = out.withColumn("__parts", F.split("text", "\n")), F.col("__parts")  # a step of its own: split once
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    cols = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(parts))
    return out.select(*cols, n.cast("long").alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text of the kept lines, n_lines and n_removed of every row of documents."""
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
