"""Registered queries of the speech quality engine and their SQL.

The driver's tables stand in for speech data: turns for segments and recognitions, events
of a user for unit timestamps and attempts, embeddings for short sample arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions import text as X
from cadenza.operators import acoustic, alignment, evaluate, selection, silence
from cadenza.operators import assembly as assembly_
from cadenza.sources import segments as S

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
LEVEL = 0.05
NORMAL = "lower(regexp_replace(coalesce({}, ''), '[^A-Za-z0-9㐀-鿿]', '', 'g'))"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def us(col: str = "ts"):
    return F.unix_micros(F.col(col).cast("timestamp"))


def six(c):
    return F.round(c, 6)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = turns(spark, sf_dir).select("conv_id", "turn", "text", F.lead("text").over(w).alias("next"))
    return t.where("next IS NOT NULL")


@query(f"""
WITH t AS (SELECT conv_id, turn, {NORMAL.format('text')} AS a, {NORMAL.format('lead(text) OVER (PARTITION BY conv_id ORDER BY turn)')} AS b,
                  lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
SELECT conv_id, turn, CAST(levenshtein(a, b) AS INTEGER) AS distance, round(levenshtein(a, b) / greatest(length(a), 1), 6) AS cer FROM t
WHERE n IS NOT NULL AND length(a) <= 240 AND length(b) <= 240""")
def cer_adjacent_turns(spark, sf_dir):
    t = _pairs(spark, sf_dir).select("conv_id", "turn", X.normalized_text(F.col("text")).alias("a"), X.normalized_text(F.col("next")).alias("b")).where("length(a) <= 240 AND length(b) <= 240")
    return t.select("conv_id", "turn", F.levenshtein("a", "b").alias("distance"), six(X.error_rate(F.col("a"), F.col("b"))).alias("cer"))


@query(f"""
WITH t AS (SELECT conv_id, turn, {NORMAL.format('text')} AS a, {NORMAL.format('lead(text) OVER (PARTITION BY conv_id ORDER BY turn)')} AS b,
                  lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
SELECT conv_id, turn, CAST(levenshtein(a, b) AS INTEGER) AS distance, round(levenshtein(a, b) / greatest(length(a), 1), 6) AS cer FROM t
WHERE n IS NOT NULL""")
def cer_all_adjacent_turns(spark, sf_dir):
    """Every pair, however long: cer_adjacent_turns has only the rows its SQL asks for."""
    t = _pairs(spark, sf_dir).select("conv_id", "turn", X.normalized_text(F.col("text")).alias("a"), X.normalized_text(F.col("next")).alias("b"))
    return t.select("conv_id", "turn", F.levenshtein("a", "b").alias("distance"), six(X.error_rate(F.col("a"), F.col("b"))).alias("cer"))


@query(f"SELECT doc_id, CAST(length({NORMAL.format('text')}) AS INTEGER) AS n, md5({NORMAL.format('text')}) AS digest FROM documents")
def normalized_text(spark, sf_dir):
    n = X.normalized_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(n).alias("n"), F.md5(n.cast("binary")).alias("digest"))


@query("""SELECT conv_id, turn, CAST(length(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9㐀-鿿]', '', 'g')) AS INTEGER) AS lexical,
CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]+|[㐀-鿿]')) AS INTEGER) AS timed FROM conversations""")
def unit_counts(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", "turn", F.size(X.lexical_units(F.col("text"))).alias("lexical"), F.size(X.timestamp_units(F.col("text"))).alias("timed"))


@query("SELECT conv_id, turn, CAST(length(text) AS INTEGER) AS n FROM conversations WHERE length(text) > 240")
def oversized_segments(spark, sf_dir):
    return S.oversized(turns(spark, sf_dir)).select("conv_id", "turn", F.length("text").alias("n"))


@query("SELECT CAST(min(length(text)) AS INTEGER) AS shortest, CAST(max(length(text)) AS INTEGER) AS longest, count(*) AS segments FROM conversations")
def segment_length_stats(spark, sf_dir):
    return turns(spark, sf_dir).agg(F.min(F.length("text")).alias("shortest"), F.max(F.length("text")).alias("longest"), F.count("*").alias("segments"))


LINES_SQL = r"""
WITH l AS (SELECT conv_id, turn, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no, string_split(text, chr(10)) AS parts FROM conversations),
k AS (SELECT conv_id, turn, no, regexp_replace(parts[no], '^\s+|\s+$', '', 'g') AS text FROM l),
s AS (SELECT conv_id, turn, no, text FROM k WHERE text <> '')
"""


@query(LINES_SQL + """SELECT conv_id, turn, CAST(row_number() OVER w AS INTEGER) AS seq, printf('S%03d', row_number() OVER w) AS segment_id,
md5(text) AS digest, coalesce(lead(no) OVER w > no + 1, true) AS paragraph_after FROM s WINDOW w AS (PARTITION BY conv_id, turn ORDER BY no)""")
def paragraph_flags(spark, sf_dir):
    s = S.reviewed_segments(turns(spark, sf_dir), ["conv_id", "turn"])
    return s.select("conv_id", "turn", "seq", "segment_id", F.md5(F.col("text").cast("binary")).alias("digest"), "paragraph_after")


@query(r"""
WITH u AS (SELECT conv_id, turn, unnest(regexp_extract_all(coalesce(text, ''), '(?:[A-Za-z]+|[0-9]+|[㐀-鿿])([^A-Za-z0-9㐀-鿿]*)', 1)) AS sep FROM conversations)
SELECT conv_id, turn, count(*) FILTER (regexp_matches(sep, '[。！？!?；;\n]')) AS sentences,
       count(*) FILTER (NOT regexp_matches(sep, '[。！？!?；;\n]') AND regexp_matches(sep, '[，,、：:]')) AS commas FROM u GROUP BY conv_id, turn""")
def punctuation_kind(spark, sf_dir):
    k = turns(spark, sf_dir).select("conv_id", "turn", F.explode(X.unit_separators(F.col("text"))).alias("sep")).select("conv_id", "turn", X.punctuation_kind(F.col("sep")).alias("kind"))
    return k.groupBy("conv_id", "turn").agg(F.count_if(F.col("kind") == "sentence").alias("sentences"), F.count_if(F.col("kind") == "comma").alias("commas"))


@query(LINES_SQL + r""", j AS (SELECT conv_id, turn, string_agg(regexp_replace(text, '\s+', '', 'g'), '' ORDER BY no) AS joined FROM s GROUP BY conv_id, turn)
SELECT conv_id, turn, joined = regexp_replace(c.text, '\s+', '', 'g') AS preserved FROM j JOIN conversations c USING (conv_id, turn)""")
def text_preservation(spark, sf_dir):
    t = turns(spark, sf_dir)
    joined = S.reviewed_segments(t, ["conv_id", "turn"]).groupBy("conv_id", "turn").agg(S.joined_text(F.col("seq"), F.col("text")).alias("joined"))
    return joined.join(t, ["conv_id", "turn"]).select("conv_id", "turn", (F.col("joined") == X.strip_space(F.col("text"))).alias("preserved"))


GAPS_SQL = """
WITH g AS (SELECT user_id, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events),
m AS (SELECT user_id, median(CAST(gap AS DOUBLE)) AS med FROM g WHERE gap IS NOT NULL GROUP BY user_id),
d AS (SELECT g.user_id, event_id, gap, med, abs(gap - med) AS dev FROM g JOIN m ON g.user_id = m.user_id WHERE gap IS NOT NULL),
a AS (SELECT user_id, any_value(med) AS med, median(dev) AS mad, count(*) AS n FROM d GROUP BY user_id)
"""


def _gaps(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    g = e.select("user_id", "event_id", (us() - F.lag(us()).over(w)).alias("gap")).where("gap IS NOT NULL")
    m = g.groupBy("user_id").agg(F.median("gap").alias("med"))
    d = g.join(m, "user_id").withColumn("dev", F.abs(F.col("gap") - F.col("med")))
    return d, d.groupBy("user_id").agg(F.any_value("med").alias("med"), F.median("dev").alias("mad"), F.count("*").alias("n"))


@query(GAPS_SQL + "SELECT user_id, n, med AS median_us, mad AS mad_us, greatest(280000.0, med + 4.0 * mad) AS threshold_us FROM a")
def gap_median_mad(spark, sf_dir):
    a = _gaps(spark, sf_dir)[1]
    return a.select("user_id", "n", F.col("med").alias("median_us"), F.col("mad").alias("mad_us"), F.greatest(F.lit(280000.0), F.col("med") + 4.0 * F.col("mad")).alias("threshold_us"))


@query(GAPS_SQL + "SELECT d.user_id, d.event_id, d.gap FROM d JOIN a ON d.user_id = a.user_id WHERE d.gap > greatest(280000.0, a.med + 4.0 * mad)")
def abnormal_gaps(spark, sf_dir):
    d, a = _gaps(spark, sf_dir)
    return d.join(a.select("user_id", "mad"), "user_id").where(F.col("gap") > F.greatest(F.lit(280000.0), F.col("med") + 4.0 * F.col("mad"))).select("user_id", "event_id", "gap")


RATES_SQL = """
WITH r AS (SELECT user_id, event_id, row_number() OVER o AS i, first_value(epoch_us(ts)) OVER f AS t0, last_value(epoch_us(ts)) OVER f AS t1, count(*) OVER f AS k FROM events
           WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id), f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
v AS (SELECT user_id, i, CASE WHEN t1 > t0 THEN 6 / ((t1 - t0) / 1e6) ELSE 0.0 END AS rate FROM r WHERE k = 6),
m AS (SELECT user_id, median(rate) AS med FROM v WHERE rate > 0 GROUP BY user_id),
x AS (SELECT v.user_id, i, rate, CASE WHEN rate > 0 THEN rate / med ELSE 0.0 END AS ratio FROM v LEFT JOIN m ON v.user_id = m.user_id)
"""


def _rates(spark, sf_dir):
    o = Window.partitionBy("user_id").orderBy("ts", "event_id")
    f = o.rowsBetween(0, 5)
    r = table(spark, sf_dir, "events").select("user_id", F.row_number().over(o).alias("i"), F.first(us()).over(f).alias("t0"), F.last(us()).over(f).alias("t1"), F.count("*").over(f).alias("k")).where("k = 6")
    v = r.select("user_id", "i", F.when(F.col("t1") > F.col("t0"), 6 / ((F.col("t1") - F.col("t0")) / 1e6)).otherwise(F.lit(0.0)).alias("rate"))
    m = v.where("rate > 0").groupBy("user_id").agg(F.median("rate").alias("med"))
    return v.join(m, "user_id", "left").withColumn("ratio", F.when(F.col("rate") > 0, F.col("rate") / F.col("med")).otherwise(F.lit(0.0)))


@query(RATES_SQL + "SELECT user_id, CAST(count(*) AS BIGINT) AS windows, round(median(rate) FILTER (rate > 0), 6) AS median_rate, round(max(ratio), 6) AS max_ratio FROM x GROUP BY user_id")
def speed_windows(spark, sf_dir):
    return _rates(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("windows"), six(F.median(F.when(F.col("rate") > 0, F.col("rate")))).alias("median_rate"), six(F.max("ratio")).alias("max_ratio"))


@query(RATES_SQL + """, c AS (SELECT user_id, sum(CASE WHEN ratio > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS run FROM x)
SELECT user_id, max(run) = 2 AS failed FROM c GROUP BY user_id""")
def speed_consecutive(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("i").rowsBetween(-1, 0)
    c = _rates(spark, sf_dir).select("user_id", F.sum((F.col("ratio") > 3).cast("int")).over(w).alias("run"))
    return c.groupBy("user_id").agg((F.max("run") == 2).alias("failed"))


@query("""
WITH s AS (SELECT vec_id, embedding AS e, list_transform(embedding, lambda x: CAST(CAST(x AS FLOAT) * CAST(x AS FLOAT) AS DOUBLE)) AS q FROM embeddings)
SELECT vec_id, round(len(e) / 48000, 9) AS duration_seconds, round(CAST(list_max(list_transform(e, lambda x: abs(x))) AS DOUBLE), 6) AS peak,
round(sqrt(list_sum(q) / len(e)), 6) AS rms, round(20 * log10(greatest(sqrt(list_sum(q) / len(e)), 1e-12)), 6) AS rms_db FROM s""")
def sample_stats(spark, sf_dir):
    s = table(spark, sf_dir, "embeddings").select("vec_id", acoustic.sample_stats(F.col("embedding")).alias("s"))
    return s.select("vec_id", F.round("s.duration_seconds", 9).alias("duration_seconds"), six(F.col("s.peak")).alias("peak"), six(F.col("s.rms")).alias("rms"), six(F.col("s.rms_db")).alias("rms_db"))


@query(f"""
WITH u AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) AS n FROM embeddings),
a AS (SELECT vec_id, any_value(n) AS n, min(i) FILTER (abs(x) >= CAST({LEVEL} AS FLOAT)) AS f, max(i) FILTER (abs(x) >= CAST({LEVEL} AS FLOAT)) AS l FROM u GROUP BY vec_id)
SELECT vec_id, round(coalesce(f, n) * 1000.0 / 48000, 6) AS leading_ms, round(coalesce(n - 1 - l, n) * 1000.0 / 48000, 6) AS trailing_ms FROM a""")
def leading_trailing_silence(spark, sf_dir):
    s = table(spark, sf_dir, "embeddings").select("vec_id", acoustic.sample_stats(F.col("embedding"), active=LEVEL).alias("s"))
    return s.select("vec_id", six(F.col("s.leading_silence_ms")).alias("leading_ms"), six(F.col("s.trailing_silence_ms")).alias("trailing_ms"))


ISLANDS_SQL = f"""
WITH u AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) AS n FROM embeddings),
q AS (SELECT vec_id, n, i, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS g FROM u WHERE abs(CAST(x AS DOUBLE)) < {LEVEL}),
s AS (SELECT vec_id, n, min(i) AS start, max(i) + 1 AS "end" FROM q GROUP BY vec_id, n, g HAVING count(*) >= 2),
e AS (SELECT vec_id, n, start AS start_frame, "end" AS end_frame, start + 2 AS ds, "end" AS de FROM s WHERE "end" - start > 2)
"""


def _islands(spark, sf_dir):
    """Clips in a row each: no shuffle."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").alias("n_frames"), F.explode(silence.array_islands(F.transform("embedding", lambda x: x.cast("double")), LEVEL, 2)).alias("s"))
    return e.select("vec_id", "n_frames", "s.start", "s.end")


@query(ISLANDS_SQL + 'SELECT vec_id, start, "end" FROM s')
def silence_islands(spark, sf_dir):
    return _islands(spark, sf_dir).select("vec_id", "start", "end")


@query(ISLANDS_SQL + 'SELECT vec_id, start, "end" FROM s')
def silence_islands_by_sample(spark, sf_dir):
    u = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.transform("embedding", lambda x: x.cast("double"))).alias("i", "x"))
    return silence.islands(u, "vec_id", "i", "x", LEVEL, 2)


@query(ISLANDS_SQL + "SELECT vec_id, start_frame, end_frame, ds AS delete_start_frame, de AS delete_end_frame, de - ds AS deleted_frames FROM e")
def silence_compress(spark, sf_dir):
    e = silence.silence_edits(_islands(spark, sf_dir), "vec_id", rate=1000, threshold_ms=2, target_ms=2)
    return e.select("vec_id", "start_frame", "end_frame", "delete_start_frame", "delete_end_frame", "deleted_frames")


@query(ISLANDS_SQL + """, c AS (SELECT vec_id, unnest([0, 1, 2, 3]) AS seq, n FROM (SELECT vec_id, len(embedding) AS n FROM embeddings)),
g AS (SELECT vec_id, seq, seq * 16 AS a, (seq + 1) * 16 AS b FROM c)
SELECT g.vec_id, CAST(seq AS INTEGER) AS seq, greatest(0, ds - a) AS local_start, least(b, de) - a AS local_end FROM g JOIN e ON g.vec_id = e.vec_id AND ds < b AND de > a""")
def segment_deletions(spark, sf_dir):
    e = silence.silence_edits(_islands(spark, sf_dir), "vec_id", rate=1000, threshold_ms=2, target_ms=2).select("vec_id", F.col("delete_start_frame").alias("start"), F.col("delete_end_frame").alias("end"))
    parts = table(spark, sf_dir, "embeddings").select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("seq")).select("vec_id", "seq", (F.col("seq") * 16).alias("start_frame"), ((F.col("seq") + 1) * 16).alias("end_frame"))
    return silence.segment_deletions(parts, e, "vec_id")


ATTEMPTS_SQL = """
WITH a AS (SELECT user_id, event_id, event_type <> 'error' AS passed, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS round_index FROM events)
"""


def _attempts(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") != "error").alias("passed"), "value", (F.row_number().over(w) - 1).alias("round_index"))
    return e.withColumn("score", F.array(F.lit(0.0), F.col("value").cast("double")))


@query(ATTEMPTS_SQL + """SELECT user_id, event_id, CAST(round_index AS INTEGER) AS round_index FROM (
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, round_index) AS k FROM a WHERE passed) WHERE k = 1""")
def select_best(spark, sf_dir):
    return selection.select_best(_attempts(spark, sf_dir), ["user_id"]).select("user_id", "event_id", "round_index")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_anti_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("segment_id"), "source")
    return selection.pending(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("segment_id"))).select(F.col("segment_id").alias("doc_id"), "source")


@query("""SELECT d.doc_id, quality, CASE WHEN l.doc_id IS NULL THEN 'ASR worker did not return this segment' END AS error
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def worker_left_join(spark, sf_dir):
    s = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("segment_id"), F.lit("").alias("text"))
    r = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("segment_id"), "quality", F.lit(None).cast("string").alias("error"))
    return selection.with_results(s, r, "quality").select(F.col("segment_id").alias("doc_id"), "quality", "error")


@query("""
WITH p AS (SELECT conv_id, turn, lead(turn) OVER w AS nt, length(text) % 97 + lead(length(text) % 89) OVER w AS gap, length(text) % 97 AS t, lead(length(text) % 89) OVER w AS l
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
b AS (SELECT conv_id, turn, nt, gap, CASE WHEN gap < 60 OR l >= t THEN nt ELSE turn END AS victim FROM p WHERE nt IS NOT NULL AND NOT gap BETWEEN 60 AND 120)
SELECT conv_id, victim AS turn, min(turn) AS pair_turn, CAST(arg_min(gap, turn) AS DOUBLE) AS gap_ms FROM b GROUP BY conv_id, victim""")
def boundary_failures(spark, sf_dir):
    t = turns(spark, sf_dir).select("conv_id", F.col("turn").alias("seq"), F.col("turn").alias("segment_id"), (F.length("text") % 89).cast("double").alias("leading_ms"), (F.length("text") % 97).cast("double").alias("trailing_ms"))
    q = evaluate.Quality(cross_segment_gap_min_ms=60, cross_segment_gap_max_ms=120)
    return selection.boundary_issues(t, ["conv_id"], q).select("conv_id", F.col("segment_id").alias("turn"), F.col("pair_seq").alias("pair_turn"), F.col("boundary_issue.gap_ms").alias("gap_ms"))


@query("""SELECT conv_id, turn, CAST(coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_frame,
CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS end_frame, round(length(text) / 48000, 6) AS duration_seconds FROM conversations""")
def timeline(spark, sf_dir):
    t = selection.timeline(turns(spark, sf_dir).select("conv_id", F.col("turn").alias("seq"), F.length("text").alias("frames")), ["conv_id"])
    return t.select("conv_id", F.col("seq").alias("turn"), "start_frame", "end_frame", six(F.col("duration_seconds")).alias("duration_seconds"))


@query("""
WITH e AS (SELECT vec_id, label, CAST(list_max(embedding) AS DOUBLE) AS c FROM embeddings),
m AS (SELECT label, median(c) FILTER (c > 0) AS med FROM e GROUP BY label)
SELECT vec_id, round((0.4 + coalesce(med, 0.4)) / 2, 6) AS baseline, round(c / ((0.4 + coalesce(med, 0.4)) / 2), 6) AS centroid_ratio,
       c < 0.75 * ((0.4 + coalesce(med, 0.4)) / 2) AND c < 0.65 * 0.4 AS dark FROM e LEFT JOIN m ON e.label IS NOT DISTINCT FROM m.label""")
def muffle_baseline(spark, sf_dir):
    c = F.array_max("embedding").cast("double")
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.array().cast("array<string>").alias("hard_failures"), F.array().cast("array<string>").alias("warnings"), F.struct(c.alias("spectral_centroid_hz"), c.alias("high_frequency_ratio_4khz")).alias("acoustic"), F.struct(*(F.lit(None).cast("double").alias(n) for n in ("cer", "maximum_speed_ratio", "maximum_internal_gap_ms"))).alias("metrics"))
    e = e.withColumn("label", F.coalesce("label", F.lit(-1)))
    out = selection.muffle_warnings(e, {"spectral_centroid_hz": 0.4, "high_frequency_ratio_4khz": 0.4}, ["label"])
    return out.select("vec_id", six((F.lit(0.4) + F.col("muffle.batch_centroid_median_hz")) / 2).alias("baseline"), six(F.col("muffle.centroid_ratio")).alias("centroid_ratio"), (F.size("warnings") > 0).alias("dark"))


@query(ATTEMPTS_SQL + """SELECT record_type, user_id, CAST(count(*) AS BIGINT) AS n, max(rounds) AS last_round FROM (
SELECT 'candidate' AS record_type, user_id, CAST(round_index AS INTEGER) AS rounds FROM a UNION ALL
SELECT 'selection', user_id, NULL FROM (SELECT DISTINCT user_id FROM a WHERE passed)) GROUP BY record_type, user_id""")
def metrics_union(spark, sf_dir):
    a = _attempts(spark, sf_dir)
    c = a.select(F.col("user_id").alias("segment_id"), "round_index", F.lit("").alias("audio_path"), F.lit(0).alias("seed"), "passed", "score", F.col("round_index").alias("rounds"))
    records = selection.metric_records(c, selection.select_best(c))
    return records.groupBy("record_type", F.col("segment_id").alias("user_id")).agg(F.count("*").alias("n"), F.max("rounds").alias("last_round"))


@query(ATTEMPTS_SQL + """, s AS (SELECT user_id, count(*) - 1 AS r, bool_or(round_index = 0 AND NOT passed) AS i, NOT bool_or(passed) AS f FROM a GROUP BY user_id)
SELECT count(*) AS segments, CAST(count(*) FILTER (i) AS BIGINT) AS initially_failed, CAST(count(*) FILTER (f) AS BIGINT) AS finally_failed, CAST(sum(r) AS BIGINT) AS regenerations FROM s""")
def report_counts(spark, sf_dir):
    return selection.report_totals(selection.attempts(_attempts(spark, sf_dir), ["user_id"]))


@query("""WITH m AS (SELECT doc_id, n_chars * 137 AS ms FROM documents)
SELECT doc_id, CASE WHEN ms >= 3600000 THEN printf('%02d:', ms // 3600000) ELSE '' END || printf('%02d:%02d.%03d', ms % 3600000 // 60000, ms % 60000 // 1000, ms % 1000) AS told FROM m""")
def audio_time_format(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.audio_time(F.col("n_chars") * 137 / 1000).alias("told"))


@query("SELECT event_id, CAST(20235791 + (event_id % 3) * 104729 AS BIGINT) AS seed FROM events")
def seeds_by_round(spark, sf_dir):
    from cadenza.sources.worker import seed_of_round

    return table(spark, sf_dir, "events").select("event_id", seed_of_round(F.col("event_id") % 3).alias("seed"))


@query("""
WITH i AS (SELECT user_id, epoch_us(ts) // 1000000 AS a, epoch_us(ts) // 1000000 + 3600 + CAST(event_id % 7200 AS BIGINT) AS b FROM events),
n AS (SELECT user_id, a, b, CASE WHEN a > max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM i),
g AS (SELECT user_id, a, b, sum(new) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM n)
SELECT user_id, min(a) AS start, max(b) AS "end" FROM g GROUP BY user_id, g""")
def interval_union(spark, sf_dir):
    s = F.floor(us() / 1000000).cast("long")
    i = table(spark, sf_dir, "events").select("user_id", s.alias("start"), (s + 3600 + F.col("event_id") % 7200).cast("long").alias("end"))
    return silence.coalesce_intervals(i, "user_id", "start", "end")


def _stand_in(spark, sf_dir) -> DataFrame:
    """Worker results: a turn read as the recognition of the one before, with even timestamps."""
    p = _pairs(spark, sf_dir)
    n = F.size(X.timestamp_units(F.col("next")))
    stamps = F.transform(F.sequence(F.lit(0), n), lambda i: F.array(i * 200, i * 200 + 150 + i % 7 * 10))
    keep = {"sample_rate": "48000", "channels": "1", "duration_seconds": "CAST(turn AS DOUBLE)", "clipping_fraction": "0.0D", "rms_db": "-22.0D"}
    ac = F.from_json(F.to_json(F.struct(*(F.expr(v).alias(k) for k, v in keep.items()))), evaluate.ACOUSTIC)
    return p.select(
        F.format_string("%d-%d", "conv_id", "turn").alias("segment_id"), F.col("text").alias("target_text"), F.lit("").alias("audio_path"), F.lit(0).cast("long").alias("seed"),
        F.col("next").alias("recognized_text"), stamps.alias("timestamps_ms"), ac.alias("acoustic"), F.lit(None).cast("string").alias("raw"),
        F.when(F.col("turn") % 11 == 3, "failed").alias("error"), F.lit(None).cast("string").alias("traceback"),
    )


@query()
def rules_vector(spark, sf_dir):
    c = evaluate.evaluate(_stand_in(spark, sf_dir))
    return c.select("segment_id", "hard_failures", "warnings", "passed", "score")


@query()
def failure_details(spark, sf_dir):
    c = evaluate.evaluate(_stand_in(spark, sf_dir))
    return c.select("segment_id", evaluate.failure_details(F.col("hard_failures"), F.col("metrics"), F.lit(None).cast("struct<left_segment_id:string,right_segment_id:string,gap_ms:double>")).alias("details"))


@query()
def opcode_span(spark, sf_dir):
    p = _pairs(spark, sf_dir).select("conv_id", "turn", alignment.alignment(X.timestamp_units(F.col("text")), X.timestamp_units(F.col("next"))).alias("a"))
    return p.select("conv_id", "turn", F.size("a.opcodes").alias("blocks"), alignment.changed_span(F.col("a.opcodes")).alias("span"))


@query()
def known_substitution(spark, sf_dir):
    q = evaluate.Quality(known_asr_substitutions={"the": "and", "on": "in"})
    return evaluate.evaluate(_stand_in(spark, sf_dir), q).select("segment_id", "warnings", F.col("metrics.recognized_normalized").alias("recognized"))


@query()
def spectral_summary(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", acoustic.spectra(F.col("embedding"), 16000).alias("s")).select("vec_id", "s.*")


# Units of a made-up recognition: one CJK character and maybe a mark for each event of a user. Some
# users speak too fast for a while, have no recognized text, half of the stamps, or odd audio.
UNITS_SQL = """
WITH e AS (SELECT user_id, event_id, row_number() OVER o - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
d AS (SELECT user_id, i, n, user_id % 10 AS u, user_id,
      CASE WHEN event_id % 7 = 0 THEN 'sentence' WHEN event_id % 5 = 0 THEN 'comma' END AS kind,
      CASE WHEN user_id % 10 = 2 AND i BETWEEN 3 AND 12 THEN 30 ELSE 90 + event_id % 40 END AS held,
      CASE WHEN user_id % 10 = 2 AND i BETWEEN 3 AND 12 THEN 5 WHEN event_id % 29 = 0 THEN 950 WHEN event_id % 31 = 0 THEN 1700 ELSE 20 + event_id % 60 END AS gap FROM e),
t AS (SELECT *, coalesce(sum(held + gap) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, CASE WHEN u = 0 THEN n // 2 ELSE n END AS m FROM d),
s AS (SELECT *, a + held AS b, i < m AS stamped, i < m AND u <> 7 AS mapped FROM t),
"""


def _spoken(spark, sf_dir) -> DataFrame:
    """Worker results of the same, with the reference's rate in ref."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.row_number().over(w) - 1).alias("i"))
    u, k = F.col("user_id") % 10, F.col("event_id")
    fast = (u == 2) & F.col("i").between(3, 12)
    gap = F.when(fast, 5).when(k % 29 == 0, 950).when(k % 31 == 0, 1700).otherwise(20 + k % 60)
    unit = F.decode(F.unhex(F.hex(F.lit(19968) + k % 2000)), "UTF-16BE")
    mark = F.when(k % 7 == 0, "。").when(k % 5 == 0, "，").otherwise("")
    d = e.select("user_id", "i", unit.alias("unit"), mark.alias("mark"), F.when(fast, 30).otherwise(90 + k % 40).cast("int").alias("held"), gap.cast("int").alias("gap"))
    d = d.withColumn("a", F.coalesce(F.sum(F.col("held") + F.col("gap")).over(Window.partitionBy("user_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    c = d.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("i", "unit", "mark", "a", (F.col("a") + F.col("held")).alias("b")))).alias("x"))  # one segment's units
    stamps = F.transform("x", lambda r: F.array(r["a"], r["b"]))
    half = lambda n, c, h, r: {n: F.struct(r.alias("rms_db"), c.alias("spectral_centroid_hz"), h.alias("high_frequency_ratio_4khz"))}
    dark = u == 6
    halves = half("first_half", F.lit(2000.0), F.lit(0.2), F.lit(-20.0)) | half("second_half", F.when(dark, 1000.0).otherwise(1900.0), F.when(dark, 0.05).otherwise(0.19), F.when(u == 8, -35.0).otherwise(-21.0))
    plain = {"sample_rate": F.when(u == 1, 44100).otherwise(48000), "channels": F.when(u == 9, 2).otherwise(1), "duration_seconds": F.when(u == 3, 0.2).when(u == 4, 3.0).otherwise(6.0), "clipping_fraction": F.when(u == 5, 0.002).otherwise(0.0)}
    ac = F.from_json(F.to_json(F.struct(*(v.alias(n) for n, v in (plain | halves).items()))), evaluate.ACOUSTIC)
    return c.select(
        F.col("user_id").cast("string").alias("segment_id"), F.array_join(F.transform("x", lambda r: F.concat(r["unit"], r["mark"])), "").alias("target_text"), F.lit("").alias("audio_path"),
        F.lit(0).cast("long").alias("seed"), F.when(u == 7, "").otherwise(F.array_join(F.transform("x", lambda r: r["unit"]), "")).alias("recognized_text"),
        F.when(u == 0, F.slice(stamps, F.lit(1), F.floor(F.size("x") / 2).cast("int"))).otherwise(stamps).alias("timestamps_ms"), ac.alias("acoustic"), F.lit(None).cast("string").alias("error"),
        (1.0 + F.col("user_id") % 5).alias("ref"),
    )


RULES_SQL = UNITS_SQL + """
p AS (SELECT user_id, kind, held, greatest(0, lead(a) OVER w - b) AS gap, mapped AND coalesce(lead(mapped) OVER w, false) AS ok FROM s WINDOW w AS (PARTITION BY user_id ORDER BY i)),
g AS (SELECT user_id, median(gap) AS med FROM p WHERE ok AND kind IS NULL GROUP BY user_id),
h AS (SELECT p.user_id, any_value(med) AS med, median(abs(gap - med)) AS mad, max(gap) AS longest FROM p JOIN g USING (user_id) WHERE ok AND kind IS NULL GROUP BY p.user_id),
x AS (SELECT user_id, held, gap, kind, ok, kind IS NOT NULL AND gap < (CASE kind WHEN 'sentence' THEN 100 ELSE 40 END) AND held + gap < 240 AS short, gap > (CASE kind WHEN 'sentence' THEN 1600 ELSE 900 END) AS long FROM p),
y AS (SELECT s.user_id, count(*) FILTER (ok AND x.kind IS NULL AND gap > greatest(280.0, coalesce(med, 0) + 4.0 * coalesce(mad, 0))) AS odd,
      count(*) FILTER (ok AND x.kind IS NOT NULL AND short) AS short, count(*) FILTER (ok AND x.kind IS NOT NULL AND NOT short AND long) AS long,
      coalesce(any_value(med), 0.0) AS med, coalesce(any_value(mad), 0.0) AS mad, coalesce(any_value(longest), 0.0) AS longest
      FROM (SELECT DISTINCT user_id FROM s) s LEFT JOIN x ON s.user_id = x.user_id LEFT JOIN h ON s.user_id = h.user_id GROUP BY s.user_id),
f AS (SELECT user_id, i, count(*) OVER k AS size, bool_and(mapped) OVER k AS whole, a, last_value(b) OVER k AS e FROM s WINDOW k AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
v AS (SELECT user_id, i, CASE WHEN whole AND e > a THEN 6 / ((e - a) / 1000.0) ELSE 0.0 END AS rate FROM f WHERE size = 6),
vm AS (SELECT user_id, median(rate) FILTER (rate > 0) AS med FROM v GROUP BY user_id),
r AS (SELECT v.user_id, i, CASE WHEN rate > 0 THEN rate / med ELSE 0.0 END AS ratio FROM v JOIN vm USING (user_id)),
c AS (SELECT user_id, max(ratio) AS fastest, bool_or(two) AS twice FROM (SELECT user_id, ratio, ratio > 1.45 AND lag(ratio) OVER (PARTITION BY user_id ORDER BY i) > 1.45 AS two FROM r) GROUP BY user_id),
z AS (SELECT user_id, any_value(u) AS u, any_value(n) AS n, count(*) FILTER (mapped) / any_value(n) AS coverage, CASE WHEN any_value(u) = 7 THEN 1.0 ELSE 0.0 END AS cer,
      CASE WHEN count(*) FILTER (stamped) >= 2 THEN count(*) FILTER (stamped) / ((max(b) FILTER (stamped) - min(a) FILTER (stamped)) / 1000.0) ELSE 0.0 END AS rate FROM s GROUP BY user_id),
q AS (SELECT z.*, 1.0 + z.user_id % 5 AS ref, y.* EXCLUDE (user_id), coalesce(c.fastest, 0.0) AS fastest, coalesce(c.twice, false) AS twice,
      CASE u WHEN 3 THEN 0.2 WHEN 4 THEN 3.0 ELSE 6.0 END AS seconds FROM z JOIN y USING (user_id) LEFT JOIN c USING (user_id)),
w AS (SELECT *, list_filter([
      CASE WHEN coverage < 0.70 THEN '逐字时间戳覆盖不足' END, CASE WHEN odd > 0 THEN '句内异常停顿' END, CASE WHEN short > 0 THEN '标点停顿过短' END, CASE WHEN long > 0 THEN '标点停顿过长' END,
      CASE WHEN twice THEN '局部语速异常' END, CASE WHEN cer > 0.12 THEN '转写差异过大' END, CASE WHEN u = 7 AND n >= 2 THEN '存在连续漏字、错字或重复' END, CASE WHEN seconds < 0.35 THEN '音频为空或过短' END,
      CASE WHEN u IN (1, 9) THEN '音频格式异常' END, CASE WHEN u = 5 THEN '音频削波' END, CASE WHEN rate > 0 AND (rate < 2 OR rate > 7) THEN '整体语速异常' END,
      CASE WHEN rate > 0 AND rate / ref > 1.5 THEN '整体语速明显快于参考' END, CASE WHEN seconds >= 4 AND u = 6 THEN '后半段频谱明显变暗' END, CASE WHEN seconds >= 4 AND u = 8 THEN '后半段响度异常下降' END], lambda t: t IS NOT NULL) AS failures FROM q)
"""


@query(RULES_SQL + """SELECT CAST(user_id AS VARCHAR) AS segment_id, array_to_string(failures, '|') AS failures, len(failures) = 0 AS passed, CAST(cer AS DOUBLE) AS cer, round(coverage, 6) AS coverage, round(med, 6) AS gap_median, round(mad, 6) AS gap_mad,
round(greatest(280.0, med + 4.0 * mad), 6) AS gap_limit, CAST(longest AS DOUBLE) AS longest_gap, round(fastest, 6) AS fastest, round(rate, 6) AS rate FROM w""")
def rules_on_events(spark, sf_dir):
    """evaluate() as a whole: its fourteen rules on a candidate's own row, and their figures."""
    s = _spoken(spark, sf_dir)
    m = lambda n: F.col(f"metrics.{n}")
    return evaluate.evaluate(s, reference_rate=F.col("ref")).select(
        "segment_id", F.array_join("hard_failures", "|").alias("failures"), "passed", m("cer").alias("cer"), six(m("timestamp_coverage")).alias("coverage"), six(m("internal_gap_median_ms")).alias("gap_median"),
        six(m("internal_gap_mad_ms")).alias("gap_mad"), six(m("internal_gap_threshold_ms")).alias("gap_limit"), m("maximum_internal_gap_ms").cast("double").alias("longest_gap"), six(m("maximum_speed_ratio")).alias("fastest"), six(m("overall_speech_rate")).alias("rate"),
    )


@query(RULES_SQL + """SELECT CAST(user_id AS VARCHAR) AS segment_id, CAST(odd AS INTEGER) AS abnormal, CAST(short AS INTEGER) AS short, CAST(long AS INTEGER) AS long,
CAST(len(failures) AS DOUBLE) AS first_score, round(fastest, 6) AS fourth_score FROM w""")
def pause_rules_on_events(spark, sf_dir):
    """The pauses that evaluate() lists, by kind, and the score's parts that depend on them."""
    c = evaluate.evaluate(_spoken(spark, sf_dir), reference_rate=F.col("ref"))
    size = lambda n: F.size(F.col(f"metrics.{n}"))
    return c.select("segment_id", size("abnormal_gaps").alias("abnormal"), size("short_punctuation_gaps").alias("short"), size("long_punctuation_gaps").alias("long"), F.col("score")[0].alias("first_score"), six(F.col("score")[3]).alias("fourth_score"))


ASSEMBLY_SQL = f"""
WITH c AS (SELECT coalesce(label, -1) AS label, vec_id, len(embedding) AS n, embedding AS x FROM embeddings WHERE embedding IS NOT NULL),
l AS (SELECT label, vec_id, n, x, CAST(coalesce(sum(n) OVER (PARTITION BY label ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a FROM c),
u AS (SELECT label, vec_id, n, a, unnest(x) AS v, unnest(range(n)) AS i FROM l)
"""


def _clips(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL")
    return e.select(F.coalesce("label", F.lit(-1)).alias("label"), F.col("vec_id").alias("seq"), F.col("vec_id").alias("segment_id"), F.col("embedding").alias("samples"))


@query(ASSEMBLY_SQL + f"""SELECT label, vec_id, a AS start_frame, a + n AS end_frame, true AS kept,
CAST(coalesce(sum(CASE WHEN abs(v) >= CAST({LEVEL} AS FLOAT) THEN a + i ELSE 0 END), 0) AS BIGINT) AS loud_places FROM u GROUP BY label, vec_id, a, n""")
def assembly(spark, sf_dir):
    """Clips laid end to end, each held against the whole recording; loud_places sums the places of
    loud samples in the recording."""
    line = assembly_.assemble(_clips(spark, sf_dir), ["label"])
    seen = assembly_.verify_assembly(line, assembly_.join_clips(_clips(spark, sf_dir), ["label"]), ["label"])
    loud = F.aggregate(F.transform("samples", lambda x, i: F.when(F.abs(x) >= F.lit(LEVEL).cast("float"), F.col("start_frame") + i).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s + x)
    return seen.select("label", F.col("seq").alias("vec_id"), "start_frame", "end_frame", "kept", loud.alias("loud_places"))


@query(ASSEMBLY_SQL + """, d AS (SELECT label, a + 5 + CAST(vec_id % 40 AS BIGINT) AS s, a + 5 + CAST(vec_id % 40 AS BIGINT) + 1 + CAST(vec_id % 90 AS BIGINT) AS e FROM l WHERE vec_id % 3 = 0),
g AS (SELECT label, vec_id, n, a, i, EXISTS (SELECT 1 FROM d WHERE d.label = u.label AND a + i >= s AND a + i < e) AS gone FROM u),
k AS (SELECT label, vec_id, a, any_value(n) AS n, count(*) FILTER (NOT gone) AS left_ FROM g GROUP BY label, vec_id, a)
SELECT label, vec_id, a AS original_start_frame, a + n AS original_end_frame, CAST(left_ AS BIGINT) AS frames,
CAST(coalesce(sum(left_) OVER (PARTITION BY label ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_frame FROM k""")
def post_edit_timeline(spark, sf_dir):
    """The timeline after deletions that may overlap and reach into the next clip."""
    line = assembly_.assemble(_clips(spark, sf_dir), ["label"])
    a = F.col("start_frame") + 5 + F.col("seq") % 40
    cuts = line.where("seq % 3 = 0").select("label", a.cast("long").alias("start"), (a + 1 + F.col("seq") % 90).cast("long").alias("end"))
    return assembly_.after_edits(line, cuts, "label").select("label", F.col("seq").alias("vec_id"), "original_start_frame", "original_end_frame", "frames", "start_frame")


@query("""
WITH i AS (SELECT user_id, epoch_us(ts) // 1000000 % 500000 AS a, epoch_us(ts) // 1000000 % 500000 + 900 + CAST(event_id % 7200 AS BIGINT) AS b FROM events),
d AS (SELECT user_id, a + 1000 AS a, least(b, 500000) AS b FROM i WHERE least(b, 500000) - a > 1200),
n AS (SELECT user_id, a, b, coalesce(max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM d),
k AS (SELECT user_id, done AS start, a AS "end" FROM n WHERE a > done UNION ALL SELECT user_id, max(b), 500000 FROM d GROUP BY user_id HAVING max(b) < 500000)
SELECT user_id, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM k""")
def kept_ranges(spark, sf_dir):
    """What is left of a recording of 500,000 frames after overlapping silences were cut."""
    s = F.floor(us() / 1000000).cast("long") % 500000
    i = table(spark, sf_dir, "events").select("user_id", F.lit(500000).alias("n_frames"), s.alias("start"), (s + 900 + F.col("event_id") % 7200).alias("end"))
    e = silence.silence_edits(i, "user_id", rate=1000, threshold_ms=1200, target_ms=1000)
    lists = e.groupBy("user_id").agg(F.collect_list(F.struct(F.col("delete_start_frame").alias("start"), F.col("delete_end_frame").alias("end"))).alias("d"))  # one recording's edits
    return lists.select("user_id", F.inline(silence.kept_ranges(F.col("d"), F.lit(500000))))


@query("""
WITH t AS (SELECT conv_id, turn, text, length(text) AS n, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM conversations)
SELECT conv_id, turn, CASE WHEN turn % 4 = 1 THEN printf('edited/%d-%d.wav', conv_id, turn) ELSE printf('round/%d-%d.wav', conv_id, turn) END AS audio_path, CAST(20235791 + (turn % 3) * 104729 AS BIGINT) AS seed,
CAST(turn % 3 AS INTEGER) AS round_index, CAST(n AS BIGINT) AS frames, CAST(a AS BIGINT) AS start_frame, true AS postprocessed FROM t""")
def review_list(spark, sf_dir):
    """Segments with their selected clips, edited clips first, and their places."""
    from cadenza.sources.worker import seed_of_round

    t = turns(spark, sf_dir).select("conv_id", "turn", F.col("turn").alias("seq"), "text")
    name = lambda f: F.format_string(f, "conv_id", "turn").alias("audio_path")
    r = (F.col("turn") % 3).cast("int")
    chosen = t.select("conv_id", "turn", name("round/%d-%d.wav"), seed_of_round(r).alias("seed"), r.alias("round_index"))
    line = selection.timeline(t.select("conv_id", "turn", "seq", F.length("text").alias("frames")), ["conv_id"]).withColumn("sample_sha256", F.lit(""))
    edited = t.where("turn % 4 = 1").select("conv_id", "turn", name("edited/%d-%d.wav"))
    out = assembly_.review_rows(t, chosen, line, edited, ("conv_id", "turn"))
    return out.select("conv_id", "turn", "audio_path", "seed", "round_index", F.rint(F.col("duration_seconds") * 48000).cast("long").alias("frames"), F.rint(F.col("final_start_seconds") * 48000).cast("long").alias("start_frame"), "postprocessed")
