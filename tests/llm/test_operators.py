import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, html_extract, line_dedup, nearest, pieces, simhash, substring_dedup, token_store, toxicity, url_filter
from cadenza.llm.queries import ORACLE_SQL, QUERIES
from tests.helpers import SF, by_spark, by_sql


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op6_nearest_neighbours", "op9_decontamination"])
def test_against_sql(spark, name):
    assert by_spark(QUERIES[name](spark, SF)) == by_sql(ORACLE_SQL[name])


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, hash string")


EDGES = [(1, None), (2, ""), (3, " \n "), (4, "a"), (5, "word " * 3000), (5, "word " * 3000), (None, "lost id here"), (6, "Ünïcode 文字 ok")]


def test_edge_rows_and_empty_tables(spark):
    d, none = docs(spark, EDGES), docs(spark, [])
    bench = spark.createDataFrame([(1, None), (2, "word word")], "item_id long, text string")
    for f in (simhash.near_duplicates, substring_dedup.remove_repeats, line_dedup.dedup_lines, lambda x: decontaminate.contamination(x, bench)):
        assert f(d).count() == len(EDGES)
        assert f(none).count() == 0
    path = pieces.default_model()
    both = pieces.decode(pieces.encode(d, path), path)
    assert all((r.text or "") == r.decoded for r in both.collect()) and "hash" in both.columns


def test_html():
    page = (
        '<html><head><title>T</title></head><body><header><a href="/">Home</a></header><nav><ul><li><a>x</a></ul></nav><div class="sidebar"><p>Side, bar text that is long enough.</p></div>'
        "<div id='main'><h1>Head</h1><p>First, a   paragraph &amp; more text, long enough to count.<p>Second\n<b>bold</b> one<br>next.</div>"
        '<div class="comments"><p>I liked this, very much, thanks a lot.</p></div><form><p>Sign up</p></form><script>var a="<p>no</p>";</script><footer>(c)</footer></body></html>'
    )
    assert html_extract.main_text(page) == "Head\n\nFirst, a paragraph & more text, long enough to count.\n\nSecond bold one next."
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<nav>x</nav>") == ""
    assert html_extract.main_text("<article><p>cut off &l") == "cut off &l"


def test_url_model_on_hosts_it_has_not_seen():
    w, b = url_filter.train()
    score = lambda host, path="/x": 1 / (1 + np.exp(-(w[x := url_filter.features(host, path, (3, 5), 1 << 16)].sum() / len(x) ** 0.5 + b)))
    known = {h for h, _, _ in url_filter.LABELLED_URLS}
    rows = [(f"{a}{x}.test", y) for y, xs in ((1, url_filter.UNWANTED), (0, url_filter.ORDINARY)) for x in xs for a in ("the-", "big", "www.our-")]
    rows += [("wikipedia.test", 0), ("github.test", 0), ("viagra-shop.test", 1), ("slots-city.test", 1), ("blog.poetry.test", 0)]
    assert not known & {h for h, _ in rows}
    assert np.mean([(score(h) >= 0.5) == y for h, y in rows]) > 0.95


def test_proximity_by_brute_force(spark):
    rng = random.Random(14)
    rows = [(i, " ".join(rng.choices("abcdefghij", k=rng.randrange(0, 30)))) for i in range(30)]
    items = [(i, " ".join(rng.choices("abcdefghijk", k=rng.randrange(1, 8)))) for i in range(8)]
    bench = spark.createDataFrame([*items, (99, None)], "item_id long, text string")
    d = docs(spark, [*rows, (50, None)])
    count = {t: sum(x.split().count(t) for _, x in rows) for t in "abcdefghijk"}
    phrases, near = set(), set()
    for item, t in items:
        w = t.split()
        for j in range(max(1, len(w) - 4)):
            v = w[j : j + 5]
            ranked = sorted(range(len(v)), key=lambda o: (count[v[o]], v[o], o))
            for doc, x in rows:
                x = x.split()
                phrases |= {(doc, item, i, i + len(v)) for i in range(len(x) - len(v) + 1) if x[i : i + len(v)] == v}
                near |= {(doc, item, i) for i, y in enumerate(x) if y == v[ranked[0]] and all(v[o] in x[max(0, i - 4) : i + 5] for o in ranked[1:3])}
    a, b = decontaminate.find_matches(d, bench, 5)
    assert {(r.doc_id, r.item_id, r.start, r.stop) for r in a.collect()} == phrases
    assert {(r.doc_id, r.item_id, r.pos) for r in b.collect()} == near and near


def test_url_rules_and_model(spark):
    rows = [(1, "http://A.Example.ORG/es/1"), (2, "https://x.example.org/en/12?q"), (3, "http://y.org"), (4, "https://shop.com/de/#x"), (5, None), (6, "nothing"), (7, "http://cheap-pills.example.net/en/1"), (8, "http://b.org/q")]
    out = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (out[2].path, out[2].rule) == ("/en/12", "example.org/en/1") and (out[3].path, out[3].rule) == ("", None)
    assert (out[4].rule, out[4].verdict, out[8].rule) == ("com/de/", "block", "org/")
    assert out[5].host == out[6].path == "" and out[7].rule is None and out[7].verdict == "block"
    assert out[5].verdict == out[6].verdict == "allow"


def test_streaming_search_is_the_library_s():
    m = pieces.PieceModel(open(pieces.default_model(), "rb").read())
    rng = random.Random(1)
    texts = ["", " ", "  a  b ", "x" * 900, "".join(rng.choices("theandr ", k=5000)), "".join(rng.choices("abcdefghij", k=9000)), "日本語 テキスト 🎉", "a\tb\n\n c", "<s> <0x41>"]
    for t in texts:
        assert m.encode(t) == m.sp.encode(t)
        assert m.decode(m.encode(t)) == t


def unigram_model(path):
    """A unigram model file of made-up pieces and scores (nothing is trained)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    rng = random.Random(12)
    units = ["\u2581", *"abcdef"]
    pieces_ = ["<unk>", *units, *sorted({"".join(rng.choices(units[1:], k=rng.randrange(2, 6))) for _ in range(60)}), *sorted({"\u2581" + "".join(rng.choices(units[1:], k=rng.randrange(1, 4))) for _ in range(40)})]
    for i, p in enumerate(pieces_):
        x = m.pieces.add()
        x.piece, x.score, x.type = p, -rng.uniform(1, 9) - 3 * (len(p) == 1), 2 if i == 0 else 1
    m.trainer_spec.model_type, m.trainer_spec.vocab_size = 1, len(pieces_)
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = "identity", True, False, True
    path.write_bytes(m.SerializeToString())
    return str(path)


def test_unigram_streams_find_the_best_sum(tmp_path):
    pytest.importorskip("google.protobuf")
    m = pieces.PieceModel(open(unigram_model(tmp_path / "u.model"), "rb").read())
    assert not m.bpe
    rng = random.Random(13)
    for n in (1, 5, 40, 400, 3000):
        t = "".join(rng.choices("abcdef ", k=n)).strip() or "a"
        ids = m.encode(t)
        best = lambda x: sum(m.sp.get_score(i) for i in x)
        assert m.decode(ids) == t and abs(best(ids) - best(m.sp.encode(t))) < 1e-2
        assert m.packed_all([t, t])[1] == m.packed(t)


def test_op2_is_the_library_s_on_the_whole_table(spark):
    m = pieces.PieceModel(open(pieces.default_model(), "rb").read())
    got = {r.doc_id: r for r in QUERIES["op2_sentencepiece"](spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(table)
    for doc_id, text in table:
        assert got[doc_id].ids == m.sp.encode(text or "") and got[doc_id].n_tokens == len(got[doc_id].ids) and got[doc_id].round_trip


def test_golay_keys_meet_within_two_bits():
    rng = random.Random(2)
    for _ in range(60):
        x = rng.getrandbits(22)
        y = x ^ (1 << rng.randrange(22)) ^ (1 << rng.randrange(22))
        a, b = simhash.codeword_indices(np.array([x, y]), 22)
        assert set(a) & set(b)


@pytest.mark.parametrize("paired", [1, 48])
def test_simhash_links(spark, paired):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(6)} | set(base))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = [(r.u, r.v) for r in simhash.link_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), paired).collect()]

    def classes(pairs):
        root = {f: f for f in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        return {frozenset(x for x in signed if find(x) == find(y)) for y in signed}

    want = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert classes(links) == classes(want)


@pytest.mark.parametrize("shard", [1, 256])
def test_repeats_by_brute_force(spark, shard):
    rng = random.Random(5)
    words = lambda n: [rng.choice(["a", "b", "cc"]) + str(rng.randrange(40)) for _ in range(n)]
    shared = [words(70) for _ in range(3)]
    rows = [(i, " ".join(words(rng.randrange(40)) + rng.choice(shared)[rng.randrange(12) :] + words(rng.randrange(40)))) for i in range(30)] + [(30, "same " * 200), (31, "same " * 120)]
    first: dict = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    want = {}
    for i, t in rows:
        w = t.split()
        gone = {p for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for p in range(j, j + 50)}
        want[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(docs(spark, rows), shard=shard).collect()}
    assert got == want


def test_fuzzy_lines_by_brute_force(spark):
    rng = random.Random(6)
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(30))
    base = [line() for _ in range(8)]
    edit = lambda t: t[:100] + rng.choice("xyz") + t[101:]
    rows = [(i, "\n".join([edit(b) if rng.random() < 0.7 else b for b in rng.sample(base, 4)] + ["", line()])) for i in range(20)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    seen: list[set] = []
    for i, t in rows:
        kept = []
        for x in t.split("\n"):
            s = {x[j : j + 8] for j in range(max(1, len(x) - 7))}
            if not x or not any(len(s & o) / len(s | o) >= 0.8 for o in seen):
                kept.append(x)
            if x:
                seen.append(s)
        assert got[i] == "\n".join(kept)


def test_blank_lines_stay(spark):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(spark, [(1, "a b\r\n\r\nc\n \t\n\t"), (2, "a b\r\n\r\nd\n\t"), (3, "a b"), (4, "\n\n")])).collect()}
    assert got[1].text == "a b\r\n\r\nc\n \t\n\t" and got[2].text == "\r\nd\n\t" and got[3].text == "a b" and got[4].text == "\n\n"
    assert [got[i].n_removed for i in (1, 2, 3, 4)] == [0, 1, 0, 0]


def test_signatures_do_not_depend_on_what_is_reduced_at_once(spark, monkeypatch):
    """Lines of every number of shingles around one and two blocks."""
    rng = random.Random(12)
    rows = docs(spark, [(n, "".join(rng.choices("abcdef ", k=n - 1)) + "z") for n in range(1, 2 * line_dedup.TOGETHER + 12)])
    take = lambda: sorted((r.k1, r.k2, r.copies, tuple(r.bands)) for r in line_dedup.signatures(rows).collect())
    together = take()
    monkeypatch.setattr(line_dedup, "TOGETHER", 2)
    assert len(together) == len({r.text for r in rows.collect()}) and together == take()


def test_token_store_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    long = " ".join("".join(rng.choices("etaoin", k=5)) for _ in range(4000))
    odd = " lead, it's x\ny.\nZ end\n\n q \n\t r!! ünï—c, don't! 12 a1 ### é\u0301 \ufdd0 b\xa0c d"
    rows = [(3, "a  b\n c's"), (1, None), (2, long), (9, long), (7, "<|endoftext|> x "), (8, odd), (10, odd.replace("\ufdd0", "") * 50), (11, " "), (12, "\n"), (13, "Word. Word,\nWord; "), (None, "no id")]
    token_store.write_store(docs(spark, rows), str(tmp_path / "s"), token_store.default_tokenizer())
    lib = Tokenizer.from_file(token_store.default_tokenizer())
    start, want = 0, {}
    assert 50256 in lib.encode("<|endoftext|> x ", add_special_tokens=False).ids
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r)):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want[i] = (start, ids)
        start += len(ids)
    assert {r.doc_id: (r.start, r.ids) for r in token_store.read_ids(spark, str(tmp_path / "s")).collect()} == want
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_digests(spark, str(tmp_path / "s")).collect()}
    assert got == {i: (s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, (s, x) in want.items()}
    chunks = spark.read.parquet(str(tmp_path / "s/chunks"))
    assert all(hashlib.sha256(r.ids).digest() == r.key for r in chunks.collect()) and chunks.count() == chunks.select("key").distinct().count()
    assert {r.doc_id for r in token_store.read_ids(spark, str(tmp_path / "s"), "doc_id > 8").collect()} == {9, 10, 11, 12, 13}
    token_store.write_store(docs(spark, []), str(tmp_path / "e"), token_store.default_tokenizer())
    assert token_store.read_ids(spark, str(tmp_path / "e")).count() == 0 and token_store.read_digests(spark, str(tmp_path / "e")).count() == 0
    tree, keys = token_store.Tree(), [bytes([i]) for i in range(21)]
    for i, k in enumerate(keys):
        assert tree.root() == token_store.merkle(keys[:i])
        tree.add(k)


@pytest.mark.parametrize("table,where", [("recipes", "doc_id <> 3"), ("recipes", "n_tokens > 8"), ("chunks", "length(ids) > 60"), ("manifest", "part > 0"), ("chunks", None)])
def test_a_store_that_changed_raises(spark, tmp_path, table, where):
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    token_store.write_store(docs(spark, [(i, f"text number {i} of some" + " more" * i) for i in range(40)]), src, token_store.default_tokenizer())
    for t in ("chunks", "recipes", "manifest", "top"):
        x = spark.read.parquet(f"{src}/{t}")
        if t == table:
            x = x.where(where) if where else x.withColumn("ids", F.concat("ids", F.lit(b"\x01\x02")))
        x.write.parquet(f"{dst}/{t}")
    for f in (token_store.read_digests, token_store.read_ids):
        assert f(spark, src).count() == 40
        with pytest.raises(Exception):  # noqa: B017
            f(spark, dst).count()


def test_nearest_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, float("nan")]), (3, None), (4, [0.0, 0.0]), (5, [-1.0, 1.0]), (6, [1.0, None])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in nearest.nearest(v, v, 2).collect())
    wide = spark.createDataFrame([(i, [float((i * j) % 7 - 3) for j in range(1500)]) for i in range(12)], "vec_id long, embedding array<float>")
    near, m = nearest.nearest(wide, wide, 3).collect(), {r.vec_id: np.array(r.embedding, float) for r in wide.collect()}
    for i in range(1, 12):
        want = sorted((-float(m[i] @ m[j]), j) for j in range(12) if j != i)[:3]
        assert [(r.vec_id, r.score) for r in sorted(near, key=lambda r: r["rank"]) if r.query_id == i] == [(j, -x) for x, j in want]
    assert nearest.nearest(v.limit(0), v.limit(0)).count() == 0
    assert got == [(0, 1, 1, 1.0), (0, 2, 5, -1.0), (1, 1, 0, 1.0), (1, 2, 5, -1.0), (5, 1, 0, -1.0), (5, 2, 1, -1.0)]


def test_toxicity_held_out(spark):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        w = ["".join(rng.choices("abcdefgh", k=2)) for _ in range(60)] + (["awful", "nasty"] if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    d, labels = docs(spark, [*rows, (9000, None)]), spark.createDataFrame(marks, "doc_id long, toxic int")
    out = toxicity.score_texts(d, toxicity.train(d, labels)).collect()
    held = [(r.score >= 0.5) == (r.doc_id % 4 == 0) for r in out if r.doc_id < 9000 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(held) / len(held) > 0.95 and all(0 <= r.score <= 1 for r in out)
    unknown = toxicity.score_texts(d, toxicity.train(d, labels.limit(0))).collect()
    assert all(r.score < 0.5 for r in unknown)


def test_sketches_leave_out_no_similar_pair(spark):
    rng, words = random.Random(5), [f"w{i}x{i * 7 % 13}" for i in range(60)]
    base = [rng.choice(words) for _ in range(50)]
    lines = [" ".join(rng.choice(words) if rng.random() < i / 300 else w for w in base) for i in range(60)] + ["", "ab", "ab ab ab ab ab ab"]
    sets = [{x[i : i + 8] for i in range(max(len(x) - 7, 1))} for x in lines]
    text = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    bands = F.array(F.col("line_id") + 100, F.lit(1).cast("long"), F.lit(2).cast("long"))
    members = text.select("line_id", F.col("line_id").alias("root"), F.posexplode(bands).alias("nr", "band"))
    rows = line_dedup.across(members, line_dedup.sketches(text).join(text.select("line_id", bands.alias("bands")), "line_id"), 0.8).collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    pairs = {(i, j) for j in range(len(lines)) for i in range(j)}
    similar = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert similar and similar <= found and len(found) < len(pairs)


def test_a_band_tells_its_number_and_verified_pairs_are_exact(spark):
    rng = random.Random(14)
    lines = ["".join(rng.choices("ab ", k=rng.choice([3, 8, 9, 40]))) + "z" for _ in range(30)] + ["aaaaaaaa", "aaaaaaaaa", "é" * 12 + "😀ab", "é" * 12 + "😀abc"]
    rows = line_dedup.signatures(docs(spark, [(1, "\n".join(lines))])).collect()
    assert len(rows) == len(set(lines)) and all([b & 15 for b in r.bands] == list(range(16)) for r in rows)
    units = [x.encode("utf-16-be") for x in lines]
    sets = [{u[i : i + 16] for i in range(0, max(len(u) - 14, 1), 2)} for u in units]
    pairs = [(i, j) for j in range(len(lines)) for i in range(j)]
    text = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    got = {tuple(r) for r in line_dedup.verify(spark.createDataFrame(pairs, "u long, v long"), text, 8, 0.3).collect()}
    want = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.3 * len(sets[i] | sets[j])}
    assert got == want and (30, 31) in want and (32, 33) in want


def test_components_joined_by_later_links(spark):
    roots = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (7, 7), (8, 7)], "line_id long, root long")
    more = spark.createDataFrame([(2, 6), (3, 8), (10, 11), (6, 2)], "u long, v long")
    got = sorted(tuple(r) for r in line_dedup.joined(roots, more).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (5, 1), (6, 1), (7, 3), (8, 3), (10, 10), (11, 10)]
