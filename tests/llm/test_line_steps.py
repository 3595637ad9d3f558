"""op7: what is computed once for a text is not computed again for each of its lines."""

from pyspark.sql import functions as F

from cadenza.llm import line_dedup


def test_a_text_is_hashed_before_it_is_cut_into_lines(spark):
    rows = spark.createDataFrame([(1, "a\nb"), (2, "")], "doc_id long, text string")
    plan = line_dedup._lines(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("xxhash64(")  # a plan's first step is its last line; before, the hash stood above


def test_a_text_is_split_once_where_lines_are_taken_out(spark):
    rows = spark.createDataFrame([(1, "one line\n\nof two"), (2, "one line\n\nsome other"), (3, None), (4, "")], "doc_id long, text string")
    out = line_dedup.dedup_lines(rows)
    top = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert top.count("split(") == 1  # before, three times
    assert sorted(map(tuple, out.collect())) == [(1, "one line\n\nof two", 3, 0), (2, "\nsome other", 3, 1), (3, None, 0, 0), (4, "", 1, 0)]


def test_repeated_shingles_count_once(spark):
    pairs, text = spark.createDataFrame([(1, 2), (1, 3)], "u long, v long"), spark.createDataFrame([(1, "abababababab"), (2, "abababab"), (3, "babababa")], "line_id long, line string")
    got = lambda t: sorted(map(tuple, line_dedup.verify(pairs, text, 2, t).collect()))
    assert got(1.0) == [(1, 2), (1, 3)]
    assert sorted(map(tuple, line_dedup.verify(pairs, text, 7, 1.0).collect())) == [(1, 2), (1, 3)]
    assert sorted(map(tuple, line_dedup.verify(pairs, text, 8, 0.5).collect())) == [(1, 2), (1, 3)] and line_dedup.verify(pairs, text, 8, 0.51).count() == 0


def test_cells_without_a_near_shingle_hold_the_diagonal_one(spark):
    """By definition, from the shingles' hashes; before, each cell held its own nearest shingle."""
    lines = ["-" * 300, "abc" * 99, "short", "".join(chr(97 + i * i % 23) for i in range(500)), "".join(chr(97 + i * i * i % 25) for i in range(40))]
    rows = line_dedup.signatures(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).collect()
    text = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    sets = {r.k1: r.s for r in text.select(*line_dedup._key(F.col("line"))[:1], line_dedup.shingle_set(line_dedup._units(F.col("line"))).alias("s")).collect()}
    n, near = line_dedup.GRID, (1 << 60) - (1 << 63)
    want = []
    for r in rows:
        own = [min(h ^ p for h in sets[r.k1]) for p in line_dedup._points(n * n)]
        want.append((r.k1, *(own[j] if own[j] < near else own[j // n * (n + 1)] for j in range(n * n))))
    cells = spark.createDataFrame(want, "k1 long, " + ", ".join(f"s{j} long" for j in range(n * n)))
    bands = [(F.shiftleft(F.xxhash64(F.lit(b), *(f"s{c}" for c in own)), 4) + F.lit(b)).alias(f"b{b}") for b, own in enumerate(line_dedup.band_cells())]
    assert {r.k1: r.bands for r in rows} == {r[0]: list(r[1:]) for r in cells.select("k1", *bands).collect()} and len(rows) == len(lines)


def test_long_lines_of_few_shingles_are_found(spark):
    lines = ["-" * 300, "ab" * 99, "-" * 310, "ab" * 140, "=" * 300, "-" * 9]
    got = line_dedup.dedup_lines(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).first()
    assert got.text.split("\n") == [lines[0], lines[1], lines[4]]
