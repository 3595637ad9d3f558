import math
import random
from collections import Counter

import pytest

from cadenza.llm import toxicity


def brute(rows, discount=3.0):
    """log P_toxic(w | v) - log P_ordinary(w | v), and that of the words alone, by definition."""
    pairs, ctx = (Counter(), Counter()), (Counter(), Counter())
    for text, toxic in rows:
        w = text.split()
        pairs[toxic].update(set(zip([None, *w], w, strict=False)))
    for c in (0, 1):
        for (v, _), n in pairs[c].items():
            ctx[c][v] += n
    follow = Counter(w for _, w in set(pairs[0]) | set(pairs[1]))
    total = sum(follow.values())
    u = [Counter(w for _, w in pairs[c]) for c in (0, 1)]

    def word(c, w):
        n = sum(u[c].values())
        back = sum(min(x, discount) for x in u[c].values()) / n
        return max(u[c][w] - discount, 0) / n + back * (follow[w] + 1 / len(follow)) / (total + 1)

    def pair(c, v, w):
        if not ctx[c][v]:
            return word(c, w)
        back = sum(min(n, discount) for (x, _), n in pairs[c].items() if x == v) / ctx[c][v]
        return max(pairs[c][v, w] - discount, 0) / ctx[c][v] + back * word(c, w)

    return lambda v, w: math.log(pair(1, v, w) / pair(0, v, w)), lambda w: math.log(word(1, w) / word(0, w))


@pytest.mark.parametrize("hot,bits", [(1 << 17, 1 << 20), (0, 64), (5, 128)])
def test_log_likelihoods_by_definition(spark, hot, bits):
    rng = random.Random(9)
    rows = [(" ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(40)) + (" awful you" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(160)]
    gain, alone = brute(rows)
    labelled = spark.createDataFrame(rows, "text string, toxic int")
    table, other = toxicity.entries(*toxicity.gather(labelled, parts=4, flush=500))
    assert math.isclose(other, alone("never seen"), abs_tol=1e-12)
    assert table.count() == table.select("key").distinct().count()
    model = toxicity.Model(table, other, hot, bits)
    unseen = " ".join(f"u{i}" for i in range(3000))
    texts = [rows[0][0], rows[1][0], "awful awful you", unseen, "awful", "awful", rows[2][0] + " awful w1 w2", "zz", None, "", " .. "]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    got = {r["t"]: r for r in toxicity.features(d.union(d).repartition(3), model).collect()}
    keys = {r["i"]: r["h"] for r in d.selectExpr("i", "xxhash64(text) AS h").collect()}
    assert len(got) == len({t for t in texts if t and t.strip(" .")})
    for i, t in enumerate(texts):
        w = (t or "").split() if t != " .. " else []
        if not w:
            assert keys[i] not in got
            continue
        r = got[keys[i]]
        assert math.isclose(r["mean"], sum(gain(v, x) for v, x in zip([None, *w], w, strict=False)) / len(w), abs_tol=1e-9)
        top = sorted((max(alone(x) - other, 0) for x in set(w)), reverse=True)[:2]
        assert math.isclose(r["top"], sum(top) / 2, abs_tol=1e-9)


def test_odd_labels_nulls_and_other_columns(spark):
    rows = [(i, f"plain text {i % 7} here" + (" awful" * (i % 3 == 0)), "c") for i in range(120)] + [(None, "no id", "c"), (500, None, "c"), (500, None, "c"), (501, "", "c")]
    d = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(3, 2), (4, -1), (5, None), (None, 1), (500, 1)], "doc_id long, toxic int")
    out = toxicity.score_texts(d, toxicity.train(d, labels))
    assert out.columns == d.columns
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    none = d.limit(0)
    assert toxicity.score_texts(none, toxicity.train(none, labels)).count() == 0
    assert all(r.score < 0.5 for r in toxicity.score_texts(d, toxicity.train(d, labels.limit(0))).collect())
