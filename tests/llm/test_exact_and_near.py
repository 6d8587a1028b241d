"""Exact dedup, near dedup and the components below them."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import pairwise

import numpy as np
import pytest

from panelworks.llm import exact, partenum
from panelworks.llm.components import connected
from tests.llm.common import components, empty, frame, near_components, prose


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected_groups(texts):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    first = {}
    for i, t in enumerate(normal):
        first.setdefault(t, i)
    return [
        (i, first[t], normal.count(t), first[t] == i, hashlib.sha256(t.encode()).hexdigest())
        for i, t in enumerate(normal)
    ]


TEXTS = [
    "a b", "a  b", "a\tb", "a b ", "", None, "   ", " ", "é" * 90, "é" * 90 + "x", "x" * 64,
    "x" * 64, "x" * 63, "x" * 65, " " * 500 + "tail", " tail", "y" * 5000, "y" * 5000,
    "y" * 4999 + "z", "\u00a0", "\x1c",
]


def test_radix_groups(spark):
    assert rows(exact.radix_groups(frame(spark, TEXTS))) == sorted(expected_groups(TEXTS), key=repr)


@pytest.mark.parametrize("peek,first,growth", [(1, 1, 2), (3, 2, 3), (64, 512, 8)])
def test_radix_groups_at_any_step(spark, peek, first, growth):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randrange(12))) for _ in range(120)]
    got = exact.radix_groups(frame(spark, texts), peek=peek, first=first, growth=growth)
    assert rows(got) == sorted(expected_groups(texts), key=repr)


def test_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame(
        [(1, "a"), (1, "a"), (None, "b"), (2, "b"), (None, None)], "doc_id bigint, text string"
    )
    got = rows(exact.radix_groups(docs).select("doc_id", "keep_id", "group_size", "kept"))
    assert got == sorted(
        [(1, 1, 2, True), (1, 1, 2, False), (None, None, 2, True), (2, None, 2, False)]
        + [(None, None, 1, True)],
        key=repr,
    )
    kept = exact.drop_copies(docs)
    assert rows(kept) == sorted([(1, "a"), (None, "b"), (None, None)], key=repr)


def test_drop_copies_keeps_columns(spark):
    docs = frame(spark, TEXTS)
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [g[0] for g in expected_groups(TEXTS) if g[3]]


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"e{rng.random()}" if rng.random() < share else w for w in text.split())


def near_texts():
    texts = ["", None, "   ", "one", "One", "one two three four", "ONE two  three\tfour", "a b c d e"]
    texts += ["a b c d e f", "a b c d E"]
    for n, size in enumerate((6, 9, 14, 20, 27, 35, 60, 120, 400)):
        base = prose(size, n)
        texts += [base, base.upper()]
        texts += [edited(base, share, 10 * n + k) for k, share in enumerate((0.01, 0.02, 0.03, 0.06))]
        words = base.split()
        texts += [" ".join(words[: size - size // 8]), " ".join(words[: size - size // 5])]
        texts += [prose(size, 1000 + n) + " " + prose(12, 7)]
    return texts


def test_jaccard_components(spark):
    texts = near_texts()
    label, sizes = near_components(texts)
    got = partenum.jaccard_components(frame(spark, texts))
    assert rows(got.select("doc_id", "n_shingles", "component_id")) == sorted(
        ((i, sizes[i], label[i]) for i in label), key=repr
    )


def test_family_without_a_common_lead(spark):
    """A chain in which each text is close to the next only, and many that are near misses."""
    base = prose(200, 5).split()
    texts = [" ".join(base[k : k + 160]) for k in range(0, 40, 2)]
    texts += [edited(texts[0], 0.05, s) for s in range(40)]
    label, sizes = near_components(texts)
    assert len(set(label.values())) > 10
    got = partenum.jaccard_components(frame(spark, texts))
    assert rows(got.select("doc_id", "component_id")) == sorted(label.items(), key=repr)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_SETS", 4)
    monkeypatch.setattr(partenum, "COLUMNS", 16)
    base = prose(150, 9)
    texts = [edited(base, 0.04, s) for s in range(30)] + [base] * 3
    label, _ = near_components(texts)
    got = partenum.jaccard_components(frame(spark, texts))
    assert rows(got.select("doc_id", "component_id")) == sorted(label.items(), key=repr)


def test_similar_sets_share_a_signature():
    """Whatever the sizes and however differences fall, and also with empty parts."""
    rng = np.random.default_rng(3)
    for size in [*range(5, 60), 100, 333]:
        x = rng.integers(0, 1 << 63, size).astype(np.uint64)
        gone = rng.integers(0, size // 5 + 1)
        added = max(0, (100 * (size - gone)) // 80 - size)
        y = np.concatenate([x[gone:], rng.integers(0, 1 << 63, added).astype(np.uint64)])
        similarity = (size - gone) / (size + added)
        assert similarity >= 0.8
        if gone == 0 and added == 0:
            continue
        items, starts = np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])
        found = {0: set(), 1: set()}
        for number in partenum.band_numbers(np.diff(starts)):
            for who, sig in zip(*partenum.signatures(items, starts, number), strict=True):
                found[int(who)].add(int(sig))
        assert found[0] & found[1], size
        slack = partenum.slack(items, starts)
        assert len(found[0] & found[1]) >= max(slack), size


def test_bands_are_gapless():
    for one, other in pairwise(partenum.bands()[:60]):
        assert other.low == one.high + 1
        assert one.parts * (one.spare + 1) > one.distance or one.distance == 0


def test_near_copies_of_clashing_and_empty_frames(spark):
    docs = frame(spark, near_texts())
    kept = partenum.drop_near_copies(docs)
    label, _ = near_components(near_texts())
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in label if label[i] == i)
    assert partenum.jaccard_components(empty(spark)).count() == 0
    assert exact.radix_groups(empty(spark)).count() == 0


def test_repeated_ids_and_null_ids(spark):
    text = prose(30, 2)
    docs = spark.createDataFrame(
        [(4, text), (4, text), (None, text), (9, text + " more"), (None, "alone in the world here")],
        "doc_id bigint, text string",
    )
    got = rows(partenum.jaccard_components(docs).select("doc_id", "component_id"))
    assert got == sorted([(4, 4), (4, 4), (None, 4), (9, 4), (None, None)], key=repr)


def test_rows_of_one_id_or_without_are_told_apart(spark):
    base, alone = prose(40, 2), prose(40, 3)
    docs = spark.createDataFrame(
        [(1, base), (2, base + " end"), (2, alone), (None, alone + " a"), (None, prose(50, 4)),
         (None, prose(50, 4) + " b"), (3, None), (None, None), (None, "")],
        "doc_id bigint, text string",
    )
    got = rows(partenum.jaccard_components(docs).select("doc_id", "n_shingles", "component_id"))
    assert got == sorted(
        [(1, 36, 1), (2, 37, 1), (2, 36, 2), (None, 37, 2), (None, 46, None), (None, 47, None),
         (3, 0, 3), (None, 0, None), (None, 0, None)],
        key=repr,
    )
    kept = rows(partenum.drop_near_copies(docs))
    (one,) = [r for r in kept if r[1] and r[1].startswith(prose(50, 4))]
    assert kept == sorted([(1, base), (2, alone), one, (3, None), (None, None), (None, "")], key=repr)


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(400, 460)] + [(500, k) for k in range(501, 530)]
    nodes = {x for link in links if link[0] != link[1] for x in link}
    got = dict(map(tuple, connected(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    label = components(nodes, [x for x in links if x[0] != x[1]])
    assert got == label
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
