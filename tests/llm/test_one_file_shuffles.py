"""op7: its shuffles write one file a task, also where Spark's default number of partitions would make many."""

from cadenza.llm import line_dedup


def test_line_dedup_leaves_the_writer_of_many_files(spark):
    rows = spark.createDataFrame([(1, "one line\nof two"), (2, "one line")], "doc_id long, text string")
    key = "spark.sql.shuffle.partitions"
    was, most = spark.conf.get(key), int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    try:
        spark.conf.set(key, str(most))
        got = sorted((r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(rows).collect())
        assert int(spark.conf.get(key)) > most
    finally:
        spark.conf.set(key, was)
    assert got == [(1, "one line\nof two", 0), (2, "", 1)]


def test_other_numbers_of_partitions_stay(spark):
    from cadenza.llm.common import one_file_shuffles

    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    try:
        for n in ("4", "100", "500"):
            spark.conf.set(key, n)
            one_file_shuffles(spark)
            assert spark.conf.get(key) == n
    finally:
        spark.conf.set(key, was)
