from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_mix_shard_pack import check_packing, plain_targets
from webgraph_spark.llm.quality_rules import judge, measure
from webgraph_spark.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_plain_forms(spark, sample):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "secret_scans", "mixing", "packing"]
    docs = sample
    good = cut_lineage(stages["quality_rules"](spark, docs, ""), "test")
    verdicts = judge(cut_lineage(measure(docs), "test")).collect()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in verdicts if r["kept"]}
    assert all(not brute.quality_counts(r["text"])[5] for r in good.collect())

    single = cut_lineage(stages["near_dedup"](spark, good, ""), "test")
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    want = brute.near_components(rows)
    assert {r["doc_id"] for r in single.collect()} == {rows[i][0] for i in want if rows[i][0] == want[i]}

    hidden = cut_lineage(stages["secret_scans"](spark, single, ""), "test")
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in hidden.collect():
        assert (brute.secret_base(before[r["doc_id"]]) == "" and r["text"] == before[r["doc_id"]]) or "[SECRET]" in r["text"]
        assert not brute.secret_base(r["text"].replace("[SECRET]", "\n")) and r["n_chars"] == len(r["text"])

    mixed = cut_lineage(stages["mixing"](spark, hidden, ""), "test")
    sizes, taken = Counter(), Counter()
    for r in hidden.collect():
        sizes[r["source"]] += len(brute.WORD.findall(r["text"]))
    for r in mixed.collect():
        taken[r["source"]] += len(brute.WORD.findall(r["text"]))
    longest = max(len(brute.WORD.findall(r["text"])) for r in hidden.collect())
    for s, target in plain_targets(sizes).items():
        assert abs(taken[s] - target) <= longest
    for stage in (good, single, hidden, mixed):
        assert stage.columns == COLUMNS

    packed = stages["packing"](spark, mixed, "").collect()
    texts = [(r["doc_id"], r["text"]) for r in mixed.collect()]
    used, least = check_packing(texts, packed)
    assert used <= least + 2


def test_stages_on_awkward_rows(spark, documents):
    docs = documents([(1, None), (None, ""), (2, "a b c", None, None), (2, "a b c", None, None), (3, "x " * 30000)]).withColumns(
        {"_row": F.lit(1), "uid": F.lit(2), "size": F.lit(3)}
    )
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = cut_lineage(stage(spark, given, ""), "test")
            assert name == "packing" or out.columns == given.columns
            out.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
