import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webgraph_spark.llm import mixing, packing, sharding
from webgraph_spark.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full, rest = dict.fromkeys(names, 0.0), set(), 1.5 * sum(sizes.values())
    while rest > 1e-9 and len(full) < len(names):
        share = rest / sum(weight[s] for s in names if s not in full)
        for s in names:
            if s not in full:
                target[s] += share * weight[s]
        rest = 0.0
        for s in names:
            if s not in full and target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s], _ = 2.0 * sizes[s], full.add(s)
    return target


@settings(max_examples=30, deadline=None)
@given(sizes=st.dictionaries(st.one_of(st.none(), st.text("abcé", min_size=1, max_size=3)), st.integers(0, 1000), min_size=1, max_size=8))
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    want = plain_targets(sizes)
    assert found.keys() == want.keys() and all(abs(found[s] - want[s]) < 1e-6 for s in want)


def test_mix(spark, documents, sample):
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 3}") for i in range(600)]
    rows += [(None, None, None, None), (7, "a b", "en", None), (7, "a b", "en", None), (8, "", "en", "s0")]
    docs = documents(rows).withColumns({"cut": F.lit("x"), "_row": F.lit(1)})
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    taken, sizes, target = Counter(), Counter(), {}
    for r in found:
        assert r["size"] == len((r["text"] or "").split()) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    want = plain_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 7
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["taken"])
    assert sorted(map(key, found)) == sorted(map(key, again))
    copies = mixing.take(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["times"] for r in found)
    assert mixing.mix(documents([])).count() == 0 == mixing.take(documents([])).count()


def test_shards(documents, sample):
    rows = [(i, "t" * (i % 11), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(1000)]
    rows += [(None, None, None, None)] * 3 + [(5, "é", None, None)]
    docs = documents(rows).withColumns({"key": F.lit(1), "place": F.lit(2)})
    found = sharding.shard(docs, 24).collect()
    assert len(found) == len(rows)
    slots, mixture = defaultdict(list), defaultdict(Counter)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        mixture[r["shard"]][r["source"]] += 1
    counts = [len(slots[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    hot = sum(1 for r in rows if r[3] == "hot") / 24
    # Every other source can shift a cut by half a row.
    sources = len({r[3] for r in rows})
    assert all(abs(m["hot"] - hot) <= 1 + sources / 2 for m in mixture.values())
    texts = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found)
    place = lambda rs: sorted((str(r["doc_id"]), str(r["source"]), r["shard"], r["slot"]) for r in rs if r["doc_id"] is not None)
    assert place(found) == place(sharding.shard(docs.repartition(7), 24).collect())
    assert sharding.shard(documents([])).count() == 0


def check_packing(rows, packed, capacity=2048):
    tokens = encoder(PATH).whole
    pieces = defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    for doc_id, text in rows:
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [0]
        first, start, piece = len(ids) % capacity or min(capacity, len(ids)), 0, 0
        while start < len(ids):
            part = ids[start : start + (first if start == 0 else capacity)]
            want[doc_id].append((piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            start, piece = start + len(part), piece + 1
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in packed)
    return len(sequences), -(-total // capacity)


def test_packing(documents, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect()]
    used, least = check_packing(rows, packing.pack_documents(sample, PATH).collect())
    assert used <= least + 2
    odd = [(1, None), (2, ""), (None, "a  b \n c"), (3, "<|endoftext|> x"), (4, "日本語 \x1c\x85 é"), (5, "same"), (5, "same"), (6, "wörd, " * 5000)]
    docs = documents(odd).withColumns({"uid": F.lit(1), "length": F.lit(2)})
    used, least = check_packing(odd, packing.pack_documents(docs, PATH).collect())
    assert used <= least + 1
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_packed_ids_come_back(documents):
    docs = documents([(1, "hello world"), (2, "some more text here")])
    packed = packing.pack_documents(docs, PATH, capacity=8, keep_ids=True)
    ids = [np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in packing.sequences(packed).collect()]
    whole = encoder(PATH).whole
    want = Counter(i for t in ("hello world", "some more text here") for i in whole.encode(t).ids + [0])
    assert Counter(i for s in ids for i in s) == want and all(len(s) <= 8 for s in ids)


@settings(max_examples=60, deadline=None)
@given(lengths=st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_uses_every_length_once(lengths):
    plan = packing.pack_lengths(lengths, 64)
    used = Counter()
    for content, times in plan:
        assert sum(length * each for length, each in content) <= 64
        for length, each in content:
            used[length] += each * times
    assert used == Counter(lengths)
    least = -(-sum(length * n for length, n in lengths.items()) // 64)
    assert sum(times for _, times in plan) <= max(least * 4 // 3 + 1, sum(n for length, n in lengths.items() if length > 32))


@pytest.mark.parametrize("text", ["a b", "don't  stop", " lead", "trail ", "x\ny z", "tab\tx", "é à ü.", "1,000 k's", "日本 x", "a b c", "'s 's", "A.b! c?"])
def test_ids_are_those_of_the_tokenizer(text):
    own = encoder(PATH)
    assert own.encode(text) == np.array(own.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_ids_of_random_text(text):
    own = encoder(PATH)
    assert own.encode(text) == np.array(own.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
