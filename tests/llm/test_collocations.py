import re
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webgraph_spark.llm import collocations


def plain(rows, least, longest=5, first=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        inside = Counter()
        for p in candidates:
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], f[p])
        found = []
        for p in candidates:
            a, n = f[p], totals[lang]
            if p in inside and 100 * inside[p] >= 100 * a:
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), (" ".join(p), a, f[p[:k]], f[p[k:]], n, score)))
        out += [(lang, i + 1, *row) for i, (*_, row) in enumerate(sorted(found)[:first])]
    return set(out)


def check(docs, least, **more):
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    found = collocations.mine(docs, least, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert {tuple(r) for r in found} == plain(rows, least, **more)
    assert len(found) == len({(r["lang"], r["rank"]) for r in found})


def test_given_documents(sample):
    check(sample, 5)
    check(sample, 20, first=10)
    check(sample, 3, longest=2)


def test_awkward_documents(documents):
    texts = [None, "", " \t\n", "a b a b a b a b", "A\tB a,b a b", "x\x01 x x\x01 x", "é É é É", "one", "of the " * 400, "of the end.\r\nof the end"]
    rows = [(i, t, lang) for i, t in enumerate(texts) for lang in (None, "en", "e\nn")]
    check(documents(rows), 2)
    check(documents(rows + rows), 4)
    clash = documents(rows).select("*", *[F.lit(1).alias(n) for n in ("words", "count", "key", "a", "n", "begins", "head")])
    check(clash, 2)
    assert collocations.mine(documents([]), 2).count() == 0
    assert collocations.mine(documents([(1, None)]), 1).count() == 0


def test_runs_cut_by_batches_and_ranges(spark, documents, many_ranges, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(collocations, "BLOCK", 200)
    spark.conf.set(name, "7")
    try:
        rows = [(i, f"to be or not to be {i % 5} to be sure. or {i % 3} not", ("en", "de")[i % 2]) for i in range(120)]
        check(documents(rows), 6)
    finally:
        spark.conf.set(name, before)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t.\n", max_size=60), min_size=1, max_size=8))
def test_random_texts(documents, texts):
    check(documents([(i, t) for i, t in enumerate(texts)]).repartition(3), 2)


def test_scores_beyond_64_bits(spark):
    big = F.lit(10**15).cast("decimal(38,0)")
    over = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * big * big, big * F.lit(7).cast("decimal(38,0)"))
    assert spark.range(1).select(over.alias("x")).first()["x"] == 1000 * 10**30 // (7 * 10**15)
