"""op7: bands that several lines have."""

from cadenza.llm.line_dedup import shared_bands


def test_shared_bands_are_all_found(spark):
    rows = [(1, 10), (2, 10), (3, 10), (1, 20), (4, 30), (5, -30), (5, 40), (6, 40)]
    found = shared_bands(spark.createDataFrame(rows, "line_id long, band long"))
    assert sorted(map(tuple, found.collect())) == [(10, 1), (10, 2), (10, 3), (40, 5), (40, 6)]
    assert shared_bands(spark.createDataFrame([], "line_id long, band long")).count() == 0
