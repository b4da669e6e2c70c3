import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from webgraph_spark.llm import classifier, components, lm_scoring, near_dup, topk
from webgraph_spark.llm import queries as llm

SAMPLE = "/root/testdata/sf0.001"


def plain_top(rows, step, k=5):
    usable = [
        (n, i, [math.floor(256 * x) for x in v])
        for n, (i, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in usable:
        if i is not None and i % step == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for m, j, v in usable if m != n]
            out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(12)]) for i in range(120)]
    rows += [(7, rows[7][1]), (10, rows[10][1]), (None, rows[3][1]), (200, None), (210, [1.0, None]), (220, [float("nan")] * 12)]
    rows += [(230, [float("inf")] * 12), (240, []), (251, [0.5] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("uid", F.lit(1)).repartition(3)
    found = topk.top_k(frame, F.col("vec_id") % 10 == 0).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, found), key=str) == plain_top(rows, 10)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert topk.top_k(few, F.col("vec_id") == 0).count() == 2
    assert topk.top_k(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_max_score_skips_and_keeps_ties():
    rng = np.random.default_rng(1)
    postings = rng.integers(-300, 300, (40, 500))
    query = rng.integers(-300, 300, 40)
    low, high = postings.min(axis=1), postings.max(axis=1)
    scores = query @ postings
    for floor in (None, int(np.sort(scores)[-5]), int(scores.max()) + 1, -(10**9)):
        at, found = topk.max_score(query, postings, low, high, floor)
        want = np.arange(500) if floor is None else np.flatnonzero(scores >= floor)
        assert sorted(at) == list(want) and (found == scores[at]).all()


def check_components(docs, rows):
    want = brute.near_components(rows)
    found = near_dup.near_duplicates(docs.withColumn("place", F.col("n_chars")), "place").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["component_id"] == want[r["uid"]] and r["n_shingles"] == len(brute.shingles(rows[r["uid"]][1]))
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def numbered(spark, rows):
    return spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(rows)], "doc_id long, text string, n_chars long")


def test_near_duplicates_of_every_kind(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, shared = [], text(60)
    for i in range(25):
        rows.append((i, " ".join(text(120))))
    for i in range(30):  # a group of near copies, and copies that drift apart step by step
        words = rows[0][1].split()
        words[rng.randrange(120)] = "edit"
        rows.append((100 + i, " ".join(words)))
    drift = text(150)
    for i in range(20):
        drift = drift[:]
        drift[rng.randrange(150)] = f"d{i}"
        rows.append((200 + i, " ".join(drift)))
    for i in range(30):  # a passage that many share
        rows.append((300 + i, " ".join(text(90) + shared)))
    rows += [(400, None), (401, ""), (402, " \n"), (403, "Two Words"), (404, "two words"), (405, "two"), (None, rows[1][1])]
    rows += [(None, "alone without an id at all"), (500, rows[2][1].upper()), (2, rows[2][1]), (501, rows[3][1] + " tail of it")]
    check_components(numbered(spark, rows), rows)
    docs = numbered(spark, rows).withColumnsRenamed({"n_chars": "_uid"})
    kept = near_dup.deduplicate(docs)
    assert kept.columns == docs.columns
    want = brute.near_components(rows)
    empty = [i for i, (_, t) in enumerate(rows) if not brute.shingles(t)]
    groups = {(want[i], 0) if want[i] is not None else (None, i) for i in range(len(rows)) if i not in empty}
    assert kept.count() == len(groups) + len(empty)
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0 == near_dup.deduplicate(docs.limit(0)).count()


def test_far_copies_meet_through_differences(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "LEADERS", 1)  # leaves most to the differences
    rng = random.Random(3)
    rows = []
    for family in range(2):
        base = [f"f{family}w{rng.randrange(300)}" for _ in range(90 + 40 * family)]
        for _ in range(70):
            words = base[: len(base) - rng.randrange(12)]
            for _ in range(rng.randrange(1, 6)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(12)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    check_components(numbered(spark, rows), rows)
    assert len(set(brute.near_components(rows).values())) > 3


def test_near_duplicates_of_sample(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").orderBy("doc_id").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    check_components(numbered(spark, rows), rows)


def test_posterior_bounds():
    from math import comb

    for step, least in enumerate(near_dup.least_matches(), 1):
        seen = step * near_dup.BATCH
        chance = lambda m: sum(comb(seen + 1, j) * 0.75**j * 0.25 ** (seen + 1 - j) for j in range(m + 1))
        assert least == 0 or chance(least - 1) < near_dup.MISS
        assert chance(least) >= near_dup.MISS


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(80)]
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {a for a, b in edges if a == b} - {v for a, b in edges if a != b for v in (a, b)}
    assert found == {v: root(v) for v in parent if v not in loops}


def check_scores(rows, found):
    tokens = [(i, brute.lower(t).encode().split() + [b" "]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, kinds = sum(counts.values()), len(counts)
    want = []
    for (i, ws), h in zip(tokens, held):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in ws)
        want.append((str(i), h, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got) == sorted(want)


def test_language_model(spark, documents, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect()]
    found = lm_scoring.score(sample).collect()
    check_scores(rows, found)
    assert all(r["score"] <= 0 for r in found)
    assert sum(r["score"] for r in found if not r["held_out"]) > sum(r["base_score"] for r in found if not r["held_out"])
    odd = [(1, None), (2, ""), (None, "A b"), (3, "x " * 4000), (3, "x " * 4000), (4, "é É k k")]
    check_scores(odd, lm_scoring.score(documents(odd).withColumns({"uid": F.lit(0), "part": F.lit(1), "slice": F.lit(2)})).collect())
    assert lm_scoring.score(documents([])).count() == 0


def test_scores_do_not_depend_on_ranges_or_segments(spark, sample, monkeypatch):
    scores = lambda: {(r["doc_id"], r["n_tokens"]): round(r["score"], 9) for r in lm_scoring.score(sample).collect()}
    want = scores()
    assert len(lm_scoring.fit(sample).bounds) == 2
    monkeypatch.setattr(lm_scoring, "RANGE_BYTES", 20_000)
    bounds = lm_scoring.fit(sample).bounds
    assert len(bounds) > 4 and bounds[0] == 0 and bounds[-1] == 2**lm_scoring.SEGMENT_BITS
    assert scores() == want
    model = lm_scoring.fit(sample)
    parts = [model.filter_of(k) for k in range(len(bounds) - 1)]
    assert all(len(p.data) + 16 * len(p.words) <= 20_000 + 8 * 2**lm_scoring.SEGMENT_BITS for p in parts)
    for r in model.segments.select("word_counts", "filter").collect():
        counts = np.frombuffer(r["word_counts"], np.int64)
        assert len(r["filter"]) * 8 >= lm_scoring.BITS * lm_scoring._levels(counts).sum()


def test_more_segments_for_more_text(spark, sample, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect()]
    monkeypatch.setattr(lm_scoring, "SEGMENT_TEXT", 16)
    assert lm_scoring.fit(sample).bits > lm_scoring.SEGMENT_BITS
    monkeypatch.setattr(lm_scoring, "RANGE_BYTES", 30_000)
    check_scores(rows, lm_scoring.score(sample).collect())


def test_levels_in_small_batches(spark, sample, monkeypatch):
    want = {r["doc_id"]: r["score"] for r in lm_scoring.score(sample).collect()}
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    monkeypatch.setattr(lm_scoring, "RANGE_BYTES", 30_000)
    try:
        found = {r["doc_id"]: r["score"] for r in lm_scoring.score(sample).collect()}
    finally:
        spark.conf.set(name, before)
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 1e-6 for i in want)


def plain_pair_model(rows):
    """{doc_id: score} with exact counts, rounded as levels are."""
    pairs_of = lambda ws: list(zip([b" ", *ws[:-1]], ws))
    train = [ws for i, ws in rows if zlib.crc32(str(i).encode()) % 10]
    words, pairs = Counter(w for ws in train for w in ws), Counter(p for ws in train for p in pairs_of(ws))
    n = sum(words.values())
    read = lambda c: min((3 * 2 ** (c.bit_length() - 1) - 1) / 2, n) if c else 0.0
    found = {}
    for i, ws in rows:
        found[i] = 0.0
        for a, b in pairs_of(ws):
            context, share = read(words[a]), (read(words[b]) + lm_scoring.ADD) / (n + lm_scoring.ADD * (len(words) + 1))
            found[i] += math.log10((min(read(pairs[a, b]), context) + lm_scoring.PRIOR * share) / (context + lm_scoring.PRIOR))
    return found


def test_pair_model_matches_plain_form(spark, sample, monkeypatch):
    rows = [(r["doc_id"], brute.lower(r["text"] or "").encode().split() + [b" "]) for r in sample.collect()]
    want = plain_pair_model(rows)
    sizes = dict((i, len(ws)) for i, ws in rows)
    # With 40 bits an entry hardly any n-gram is taken for a more frequent one; with 12 about one in 150 is.
    for bits, off in ((40, 1e-4), (lm_scoring.BITS, 0.02)):
        monkeypatch.setattr(lm_scoring, "BITS", bits)
        found = {r["doc_id"]: r["score"] for r in lm_scoring.score(sample).collect()}
        errors = {i: abs(found[i] - want[i]) / sizes[i] for i in want}
        assert sum(abs(found[i] - want[i]) for i in want) / sum(sizes.values()) < off
        assert sum(e > 5 * off for e in errors.values()) < len(errors) / 20


def test_model_beats_words_alone_on_held_out_documents(spark):
    found = lm_scoring.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    total = found.agg(*[F.sum(c).alias(c) for c in ("score", "base_score", "n_tokens")]).first()
    assert total["score"] / total["n_tokens"] > total["base_score"] / total["n_tokens"] + 0.4


def test_filter_reads_counts_back():
    rng = np.random.default_rng(4)
    keys = lm_scoring.short(np.unique(rng.integers(0, 2**48, 5000, dtype=np.uint64)))
    counts = rng.geometric(0.2, len(keys))
    none = np.zeros(0, np.uint64)
    entries = lm_scoring._entries(counts, none.astype(np.int64))
    data = lm_scoring._filter_bytes(keys, counts, none, none.astype(np.int64), 12, entries)
    own = lm_scoring._assembled([{"segment": 0, "filter": data.tobytes(), "words": b"", "word_counts": b""}], lm_scoring.SEGMENT_BITS, 0, 1)
    levels = own.levels(keys, 1)
    assert (levels >= lm_scoring._levels(counts)).all() and (levels == lm_scoring._levels(counts)).mean() > 0.97
    strange = lm_scoring.short(rng.integers(0, 2**48, 5000, dtype=np.uint64))
    assert (own.levels(np.setdiff1d(strange, keys), 1) == 0).mean() > 0.97


def test_classifier_on_held_out_labels(spark):
    found = llm.QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    good, bad = [[r["score"] for r in rows if r["quality"] == q] for q in (1, 0)]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(g >= 0.7 for g in good) / len(good) > 0.97 and sum(b < 0.7 for b in bad) / len(bad) > 0.85


def test_classifier_edges(spark, documents):
    docs = documents([(1, None), (2, ""), (2, ""), (None, "some words"), (3, "word " * 5000)]).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0), (2, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        found = classifier.classify(docs, given).collect()
        assert len(found) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    assert classifier.classify(documents([]), labels).count() == 0


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda given: {r["doc_id"]: round(r["score"], 9) for r in classifier.classify(docs, given).collect()}
    assert score(labels) == score(turned)


def _points(spark, seed: int, n: int = 600):
    """Two clouds; a third of the first is trusted, all else is unlabelled."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.4
    x = rng.normal(size=(n, len(classifier.FEATURES))) + np.where(good, 1.0, -1.0)[:, None] * (np.arange(len(classifier.FEATURES)) < 3)
    positive = good & (rng.random(n) < 1 / 3)
    rows = [(x[i].tolist(), bool(positive[i]), i % 3) for i in range(n)]
    return x, good, positive, spark.createDataFrame(rows, "x array<double>, positive boolean, fold int")


def _plain_risk(z, positive, weights, prior):
    f = z @ weights
    loss = lambda v: np.log1p(np.exp(-v))
    return prior * loss(f[positive]).mean() + max(0.0, loss(-f).mean() - prior * loss(-f[positive]).mean())


def test_classifier_risk_against_a_plain_form(spark):
    x, good, positive, rows = _points(spark, 1)
    mean, spread = x.mean(axis=0), np.sqrt(np.maximum((x * x).mean(axis=0) - x.mean(axis=0) ** 2, 1e-8))
    z = np.hstack([np.clip((x - mean) / spread, -classifier.WIDEST, classifier.WIDEST), np.ones((len(x), 1))])
    scale = classifier._scaling(rows)
    assert np.allclose(scale(x), z)
    weights = classifier._fit(rows, scale, 0.4, 0.1)
    assert np.isclose(classifier.risk(rows, scale, weights, 0.4), _plain_risk(z, positive, weights, 0.4))
    whole = lambda w: _plain_risk(z, positive, w, 0.4) + 0.05 * (w @ w)
    rng = np.random.default_rng(2)
    assert all(whole(weights) <= whole(weights + 0.01 * rng.normal(size=len(weights))) + 1e-9 for _ in range(200))
    found = z @ weights > 0
    assert (found == good).mean() > 0.9


def test_classifier_ridge_is_weighed_on_training_folds(spark):
    _, _, _, rows = _points(spark, 3, 300)
    risks = classifier.fold_risks(rows, (0.01, 3.0))
    assert list(risks) == [0.01, 3.0] and risks[0.01] < risks[3.0]
