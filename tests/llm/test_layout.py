"""Packing, sharding, the pipeline, and what the subpackage may touch."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from panelworks.llm import packing, sharding
from panelworks.llm.queries import QUERIES
from tests.llm.common import empty, frame, near_components, prose, words_of
from tests.llm.test_text_operators import plain_counts, plain_removal


def padding(bounds, histogram):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(x): int(rng.integers(1, 50)) for x in rng.choice(60, 9, replace=False) + 1}
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[x] for x in lengths])
    for k in (1, 2, 3, 4, 20):
        got = packing.boundaries(lengths, counts, k)
        best = min(
            padding((*some, lengths[-1]), histogram)
            for some in itertools.combinations(lengths[:-1].tolist(), min(k, len(lengths)) - 1)
        )
        assert len(got) <= k and got == sorted(got) and padding(got, histogram) == best
    assert packing.boundaries(np.array([], np.int64), np.array([], np.int64), 3) == []


def test_pack(spark):
    texts = [None, "", *(prose(n, n) for n in range(1, 120, 3)), prose(500, 1), "x\n" * 7]
    docs = frame(spark, texts)
    docs = docs.union(docs)
    got = packing.pack(docs, context=64, buckets=4, budget=200).collect()
    words = [len(words_of(t)) + 1 for t in texts]
    pieces = Counter((r["doc_id"], r["piece"], r["first_token"], r["n_tokens"]) for r in got)
    want = Counter(
        {(i, k, 64 * k, min(64, n - 64 * k)): 2 for i, n in enumerate(words) for k in range(-(-n // 64))}
    )
    assert pieces == want
    batches = defaultdict(list)
    for r in got:
        assert 0 <= r["padding"] == r["bucket_length"] - r["n_tokens"]
        batches[r["bucket_length"], r["batch"]].append(r["slot"])
    last = {b: max(k for x, k in batches if x == b) for b, _ in batches}
    for (bound, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) * bound <= 200
        assert batch == last[bound] or len(slots) == 200 // bound
    assert len(last) <= 4
    assert packing.pack(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, context=64, budget=63)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 4097, 65536])
def test_permutation(n):
    image = sharding.permute(np.arange(n), n, seed=3)
    assert sorted(image.tolist()) == list(range(n))
    if n > 50:
        assert (image != sharding.permute(np.arange(n), n, seed=4)).any()
        assert abs(np.corrcoef(image, np.arange(n))[0, 1]) < 0.3


def plain_place(number, n, seed=0):
    """The place of a row, one number at a time in plain integers."""
    prime, keys = (1 << 31) - 1, sharding.round_keys(seed)
    high = next(k for k in range(1, n + 2) if k * k >= n)
    low = -(-n // high)
    while True:
        left, right = divmod(number, low)
        for turn, (add, times) in enumerate(keys):
            mixed = (((left if turn % 2 else right) + add) % prime) ** 2 % prime
            mixed = (mixed * times + (left if turn % 2 else right)) % prime
            if turn % 2:
                right = (right + mixed) % low
            else:
                left = (left + mixed) % high
        number = left * low + right
        if number < n:  # else the cycle goes on
            return number


@pytest.mark.parametrize("count", [0, 1, 15, 16, 17, 200])
def test_shards(spark, count):
    texts = [None, "", "é", *(f"t{i}" for i in range(count))][:count]
    docs = frame(spark, texts) if texts else empty(spark)
    got = sharding.assign_shards(docs).collect()
    sizes = {i: len((t or "").encode()) + 1 for i, t in enumerate(texts)}
    sums = {i: zlib.crc32((t or "").encode()) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["size"] for r in got} == sizes
    assert {r["doc_id"]: r["text_crc32"] for r in got} == sums
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        place = plain_place(r["doc_id"], count)
        assert (r["row_number"], r["shard"], r["slot"]) == (r["doc_id"], place % 16, place // 16)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
        assert count // 16 <= len(own) <= -(-count // 16)


def test_shards_of_repeated_ids(spark):
    docs = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, "z")], "doc_id bigint, text string"
    )
    got = sharding.assign_shards(docs)
    assert sorted(r["row_number"] for r in got.collect()) == [0, 1, 2, 3, 4]


def test_written_shards(spark, tmp_path):
    docs = frame(spark, [f"text {i}" for i in range(100)]).drop("shard", "slot")
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 16


def pipeline_texts():
    passage = ". ".join(prose(12, 100 + s) for s in range(5)) + "."
    texts = [prose(60, 1), prose(60, 1), prose(60, 1).replace(" ", "  "), None, "", "too short", "a " * 80]
    base = prose(150, 2)
    texts += [base, base + " end", base.replace("w1 ", "w1 x "), prose(150, 3)]
    texts += [f"{prose(40, 4)}. {passage}", f"{prose(40, 5)}. {passage}", passage, prose(3000, 6)]
    return texts


def test_pipeline(spark, tmp_path):
    texts = pipeline_texts()
    folder = str(tmp_path / "sf")
    frame(spark, texts).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    # plain version; no line of these few documents is frequent
    stay = {i: t for i, t in enumerate(texts) if not plain_counts(t)[-1]}
    first = {}
    for i, t in stay.items():
        first.setdefault(" ".join(words_of(t)), i)
    stay = {i: t for i, t in stay.items() if first[" ".join(words_of(t))] == i}
    ids = list(stay)
    label, _ = near_components([stay[i] for i in ids])
    stay = {i: stay[i] for n, i in enumerate(ids) if label[n] == n}
    clean = dict(zip(stay, plain_removal(list(stay.values())), strict=True))
    words = {i: len(words_of(t)) + 1 for i, t in clean.items() if words_of(t)}
    assert len(stay) < len(texts) - 5 and len(words) < len(stay)
    pieces = {(r["doc_id"], r["piece"]): r["n_tokens"] for r in got}
    assert pieces == {
        (i, k): min(2048, n - 2048 * k) for i, n in words.items() for k in range(-(-n // 2048))
    }


def test_one_of_many_near_copies_passes_the_pipeline(spark, tmp_path):
    lines = [prose(15, 200 + k) for k in range(10)]
    texts = []
    for i in range(1000):
        own = [x.split() for x in lines]
        own[i % 10][i % 15] = f"own{i}"
        texts.append("\n".join(map(" ".join, own)))
    foot = "Read more on our page today"
    texts += [f"{prose(30, i)}\n{foot}" for i in range(30)]  # boilerplate goes as before
    texts += [f"{foot}\n{prose(4, 99)}"]
    folder = str(tmp_path / "sf")
    frame(spark, texts).write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == {0: 151} | {1000 + i: 31 for i in range(30)}


def test_stages_return_the_columns(spark, tmp_path):
    docs = frame(spark, pipeline_texts())
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert step(spark, empty(spark), str(tmp_path)).count() == 0


def test_thirteen_queries():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    package = Path(sharding.__file__).resolve().parent.parent
    for file in package.rglob("*.py"):
        if file.parent.name != "llm":
            assert "panelworks.llm" not in file.read_text()
