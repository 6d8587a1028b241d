"""N-gram Jaccard join with PartEnum signatures.

Sets are put into size bands [l, l / t].  Two sets with Jaccard similarity t or more lie in
the same or in neighbouring bands, and differ in at most k = 2 (1 - t) / (1 + t) r elements,
where r is the largest size of the upper band.  For each band the shingle domain is
partitioned by hash into n1 parts of n2 subparts.  At most n1 - g parts can hold more than k2
of the differences, so in at least g parts a choice of n2 - k2 subparts is the same in both
sets: every such choice of every part is a signature, a hash of the elements in it.

Empty projections say nothing and are left out.  A set with g or more parts that have an
empty projection could lose a partner that way; such sets emit the signatures of a
second partition as well, then of a third and so on, and at last one signature for
emptiness itself.  Two sets both meet the condition or one of them has fewer
empty parts than agreeing ones, so no pair is lost.

Candidates are settled in two steps.  First a set is compared with a few leads of its
buckets, which gathers most near copies into components.  Then only buckets whose members are in
different components remain.  They tie sets into families, and a family's sets are
compared in blocks: the sets of two blocks meet in one task, which returns just the links.
Similar sets share not one but many signatures, so each set may leave out some of its
buckets, those of common phrases, before families are formed.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm.common import (
    ARRAY_BYTES,
    batch,
    map_batches,
    mix,
    ship,
    slices,
    stage,
    text_key,
)
from panelworks.llm.components import connected
from panelworks.llm.shingles import WIDTH, distinct_shingles, set_keys
from panelworks.session import tidy

# Similarity as a fraction, so that all comparisons are exact.
SIMILARITY = (80, 100)
# Partitions tried before a set falls back to the signature for emptiness.
PARTITIONS = 8
# Leads a set is compared with first; what they do not settle is settled afterwards.
LEADS = 4
# Bounds of a block of sets, and columns of a matrix product, when families are compared.
BLOCK_SETS = 512
BLOCK_ITEMS = 250_000
COLUMNS = 8192
# Ids that are sent to all executors to select documents; beyond it a shuffle join does.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Band:
    low: int
    high: int
    distance: int  # largest number of differing elements
    parts: int  # n1
    subparts: int  # n2
    spare: int  # k2: differing subparts a signature tolerates
    agreeing: int  # g: parts sure to agree up to k2 subparts

    @property
    def choices(self) -> list[tuple[int, ...]]:
        return list(itertools.combinations(range(self.subparts), self.subparts - self.spare))


def _scheme(distance: int, smallest: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, g) for a distance and the smallest set that uses the band.

    Small distances enumerate subparts; large ones use plain parts, with as many in
    excess of the distance as a set of the smallest size is expected to leave empty.
    """
    if distance <= 4:
        return 1, distance + 3, distance, 1
    if distance <= 12:
        parts = distance // 2 + 2
        return parts, 3, 1, parts - distance // 2
    extra = 1
    while True:
        parts = distance + extra
        empty = parts * math.exp(-smallest / parts)
        if empty + 2 * math.sqrt(empty) < extra:
            return parts, 1, 0, extra
        extra += 1


@lru_cache(maxsize=32)
def bands(similarity: tuple[int, int] = SIMILARITY, largest: int = 1 << 16) -> list[Band]:
    """Size bands from 1 up to ``largest`` at least, and those that meet the last of them; the
    first ones are the same whatever ``largest`` is."""
    a, b = similarity
    out, low, before = [], 1, 1
    while low <= largest * b // a + 1:
        high = low * b // a
        distance = 2 * high * (b - a) // (b + a)
        scheme = _scheme(distance, before) if distance else (1, 1, 0, 1)
        out.append(Band(low, high, distance, *scheme))
        low = high + 1
        before = -(-low * a // b)
    return out


def bands_for(sizes: np.ndarray, similarity=SIMILARITY) -> list[Band]:
    """The bands of sets of the given sizes and of their partners."""
    most = int(sizes.max(initial=1))
    return bands(similarity, 1 << max(16, most.bit_length()))


def _partition(elements: np.ndarray, band_no: int, seed: int, count: int) -> np.ndarray:
    """Place of each element among ``count`` subparts; pairwise different per band and seed."""
    salt = mix(np.array([band_no * 64 + seed + 1], np.uint64))
    spread = mix(elements ^ salt) >> np.uint64(32)
    return ((spread * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def signatures(
    shingles: np.ndarray, starts: np.ndarray, band_no: np.ndarray, similarity=SIMILARITY
) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of sets that take part in the bands of the given numbers."""
    sets_out, sigs_out = [], []
    sizes = np.diff(starts)
    table = bands_for(sizes, similarity)
    for number in np.unique(band_no[band_no >= 0]):
        band = table[number]
        if band.distance == 0:  # only equal sets can match
            continue
        rows = np.flatnonzero(band_no == number)
        used = parts_used(sizes, band, similarity)
        for seed in range(PARTITIONS):
            if not rows.size:
                break
            found, sigs, risky = _one_partition(
                shingles, starts, used, rows, number, band, seed
            )
            sets_out.append(found)
            sigs_out.append(sigs)
            rows = rows[risky]
        if rows.size:
            sets_out.append(rows)
            sigs_out.append(np.repeat(mix(np.array([~number], np.int64).view(np.uint64)), len(rows)))
    if not sets_out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(sets_out), np.concatenate(sigs_out)


def parts_used(sizes: np.ndarray, band: Band, similarity=SIMILARITY) -> np.ndarray:
    """Parts each set needs: with plain parts the first ones suffice, in excess of the largest
    distance to a partner of that set by as many as the band's parts are of its distance."""
    if band.spare:
        return np.full(len(sizes), band.parts)
    a, b = similarity
    partner = np.minimum(band.high, sizes * b // a)
    return np.minimum((sizes + partner) * (b - a) // (b + a) + band.agreeing, band.parts)


def _cells(shingles, starts, rows, number, band, seed):
    """Elements of the sets ``rows`` and the cell (set, part, subpart) of each."""
    length = (starts[1:] - starts[:-1])[rows]
    owner = np.repeat(np.arange(len(rows)), length)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    elements = shingles[np.repeat(starts[rows], length) + inside]
    cells = band.parts * band.subparts
    return elements, owner * cells + _partition(elements, number, seed, cells)


def slack(shingles: np.ndarray, starts: np.ndarray, similarity=SIMILARITY) -> np.ndarray:
    """How many signatures each set is sure to share with any similar set, at least.

    In excess of the distance ``agreeing`` parts agree, and only empty ones say nothing.
    """
    sizes = np.diff(starts)
    table = bands_for(sizes, similarity)
    out = np.full(len(sizes), np.iinfo(np.int32).max)
    for band_no in band_numbers(sizes, similarity):
        for number in np.unique(band_no[band_no >= 0]):
            band = table[number]
            rows = np.flatnonzero(band_no == number)
            if band.distance == 0:
                continue
            if band.spare:
                out[rows] = 1
                continue
            used = parts_used(sizes, band, similarity)[rows]
            _, at = _cells(shingles, starts, rows, number, band, 0)
            held = np.bincount(at, minlength=len(rows) * band.parts).reshape(len(rows), -1)
            empty = (held == 0) & (np.arange(band.parts) < used[:, None])
            out[rows] = np.minimum(out[rows], band.agreeing - empty.sum(1))
    return np.maximum(out, 1)


def _one_partition(shingles, starts, used, rows, number, band, seed):
    """Signatures of the sets ``rows`` under one partition, and which sets need another."""
    elements, at = _cells(shingles, starts, rows, number, band, seed)
    cells = band.parts * band.subparts
    held = np.bincount(at, minlength=len(rows) * cells)
    sums = np.zeros(len(rows) * cells, np.uint64)
    np.add.at(sums, at, mix(elements + np.uint64(seed)))
    shape = (len(rows), band.parts, band.subparts)
    held, sums = held.reshape(shape), sums.reshape(shape)
    some_empty = np.zeros(shape[:2], bool)
    found, sigs = [], []
    part_no = np.arange(band.parts, dtype=np.uint64)
    unused = np.arange(band.parts) >= used[rows, None]
    for c, choice in enumerate(band.choices):
        chosen = list(choice)
        empty = held[:, :, chosen].sum(2) == 0
        some_empty |= empty & ~unused
        label = mix(
            (np.uint64(number) << np.uint64(40)) + np.uint64(seed << 36)
            + (part_no << np.uint64(8)) + np.uint64(c)
        )
        value = mix(sums[:, :, chosen].sum(2, dtype=np.uint64) ^ label)
        set_no, part = np.nonzero(~(empty | unused))
        found.append(rows[set_no])
        # the last bit tells signatures of one element, which are the least specific
        single = held[:, :, chosen].sum(2) == 1
        sigs.append(((value & ~np.uint64(1)) | single.astype(np.uint64))[set_no, part])
    risky = some_empty.sum(1) >= band.agreeing
    return np.concatenate(found), np.concatenate(sigs), risky


def band_numbers(sizes: np.ndarray, similarity=SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Own band of each set, and the next one if a partner can lie there; -1 for none."""
    table = bands_for(sizes, similarity)
    lows = np.array([x.low for x in table])
    own = np.searchsorted(lows, sizes, side="right") - 1
    a, b = similarity
    after = np.minimum(own + 1, len(table) - 1)
    reaches = (own >= 0) & (sizes * b // a >= lows[after])
    return own, np.where(reaches, own + 1, -1)


# --- stages ----------------------------------------------------------------------------

_CLASS = pa.schema([(name, pa.int64()) for name in ("doc_id", "key", "n", "k1", "k2", "slack")])
_SIG = pa.schema([("sig", pa.int64()), ("k1", pa.int64())])
_SET = pa.schema([("rep", pa.int64()), ("items", pa.list_(pa.int64()))])
_BUCKET = pa.schema([("sig", pa.int64()), ("lead", pa.int64()), ("node", pa.int64())])


def set_classes(
    docs: DataFrame, width: int = WIDTH, similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """doc_id, key of the text, size of the shingle set, its 128-bit key, and its :func:`slack`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches, limit=ARRAY_BYTES):
            items, starts = distinct_shingles(x.column("text"), width)
            k1, k2 = set_keys(items, starts)
            yield batch(
                _CLASS,
                doc_id=x.column("doc_id"),
                key=x.column("key"),
                n=np.diff(starts),
                k1=k1,
                k2=k2,
                slack=slack(items, starts, similarity),
            )

    return map_batches(
        docs, run, "doc_id bigint, key bigint, n bigint, k1 bigint, k2 bigint, slack bigint"
    )


def class_table(classes: DataFrame) -> DataFrame:
    """(k1, k2, rep, least, doc_id, key, n, slack) per set that is not empty.

    rep is a number of its own, least the smallest id of the class; (doc_id, key) is
    one of its documents, that with the smallest id if there are ids.
    """
    named = F.min_by("key", "doc_id")
    return stage(
        classes.where("n > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("least"),
            F.coalesce(named, F.min("key")).alias("key"),
            F.min("n").alias("n"),
            F.min("slack").alias("slack"),
        )
        .withColumn("doc_id", F.col("least"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "reps",
    )


def signature_rows(docs: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """(sig, k1) per signature; rows that a slice repeats are sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches, limit=ARRAY_BYTES):
            items, starts = distinct_shingles(x.column("text"), width)
            k1, k2 = set_keys(items, starts)
            sizes = np.diff(starts)
            keys = np.rec.fromarrays([k1, k2])
            once = np.zeros(len(sizes), bool)
            once[np.unique(keys, return_index=True)[1]] = True
            for number in band_numbers(sizes, similarity):
                number = np.where(once & (sizes > 0), number, -1)
                rows, sigs = signatures(items, starts, number, similarity)
                yield batch(_SIG, sig=sigs.view(np.int64), k1=k1[rows])

    return map_batches(docs, run, "sig bigint, k1 bigint")


def buckets(sigs: DataFrame) -> DataFrame:
    """(sig, lead, node) for the sets that share a signature with another set.

    Rows arrive sorted, so a bucket is a run of rows and is streamed: memory does
    not depend on its size.  The lead is the bucket's smallest key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig = last_key = lead = None
        for x in batches:
            if x.num_rows == 0:
                continue
            sig, key = x.column("sig").to_numpy(), x.column("k1").to_numpy()
            new = np.empty(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            new[0] = sig[0] != last_sig
            repeat = np.zeros(len(sig), bool)
            repeat[1:] = ~new[1:] & (key[1:] == key[:-1])
            repeat[0] = not new[0] and key[0] == last_key
            run_no = np.cumsum(new) - 1
            leads = np.append(key[new], 0)[run_no] if new.any() else np.zeros(len(sig), np.int64)
            if not new[0]:
                leads[run_no < 0] = lead
            rows = np.flatnonzero(~new & ~repeat)
            last_sig, last_key, lead = sig[-1], key[-1], leads[-1]
            if rows.size:
                yield batch(_BUCKET, sig=sig[rows], lead=leads[rows], node=key[rows])

    return map_batches(
        sigs.repartition("sig").sortWithinPartitions("sig", "k1"),
        run,
        "sig bigint, lead bigint, node bigint",
    )


def _shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(rep, items) of the wanted representatives (rep, k1, k2, doc_id, key).

    Of rows that repeat id and text a task returns one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for x in slices(batches, limit=ARRAY_BYTES):
            items, starts = distinct_shingles(x.column("text"), width)
            k1, k2 = set_keys(items, starts)
            ids = x.column("rep").to_pylist()
            right = (k1 == x.column("k1").to_numpy()) & (k2 == x.column("k2").to_numpy())
            rows = [i for i in np.flatnonzero(right) if ids[i] not in seen]
            rows = list({ids[i]: i for i in rows}.values())
            seen.update(ids[i] for i in rows)
            lists = pa.ListArray.from_arrays(
                pa.array(starts, pa.int32()), pa.array(items.view(np.int64))
            )
            at = pa.array(rows, pa.int64())
            yield batch(_SET, rep=x.column("rep").take(at), items=lists.take(at))

    small = wanted.count() <= BROADCAST_IDS
    named = wanted.withColumnsRenamed({"doc_id": "of", "key": "of_key"})
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    texts = docs.join(F.broadcast(named) if small else named, same)
    return map_batches(
        texts.select("rep", "k1", "k2", "text"), run, "rep bigint, items array<bigint>"
    )


def _verified(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) of set representatives whose similarity is high enough."""
    a, b = similarity
    left = sets.select(F.col("rep").alias("u"), F.col("items").alias("x"))
    right = sets.select(F.col("rep").alias("v"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - F.col("common")
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .select("u", "v", "x", "y", common.alias("common"))
        .where(F.col("common") * b >= union * a)
        .select("u", "v")
    )


def _members(found: DataFrame, reps: DataFrame) -> DataFrame:
    """(sig, rep, lead): members of buckets, by representative, that may have a partner.

    A set in fewer buckets than it is sure to share with a similar one has none.  The lead
    is the smallest member.
    """
    named = reps.select(F.col("k1").alias("node"), "rep")
    members = stage(
        found.select("sig", "node")
        .union(found.select("sig", F.col("lead").alias("node")).distinct())
        .join(named, "node")
        .select("sig", "rep"),
        "members",
    )
    enough = (
        members.groupBy("rep")
        .agg(F.count(F.lit(1)).alias("held"))
        .join(reps.select("rep", "slack"), "rep")
        .where("held >= slack")
        .select("rep")
        .distinct()
    )
    able = members.join(enough, "rep")
    leads = able.groupBy("sig").agg(F.min("rep").alias("lead"), F.count("rep").alias("m"))
    return stage(
        able.join(leads.where("m > 1").drop("m"), "sig").select("sig", "rep", "lead"), "members"
    )


def _families(members: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """(family, rep, label, n): sets tied by the buckets whose members are still apart.

    Two similar sets share ``slack`` buckets of either at least, so less than half of
    that may be left out by each; those of single elements and of many members go first.
    """
    placed = members.join(labels, members.rep == labels.node, "left").select(
        "sig", "rep", F.coalesce("label", "rep").alias("label")
    )
    mixed = (
        placed.groupBy("sig")
        .agg(
            F.min("label").alias("least"), F.max("label").alias("most"), F.count("rep").alias("m")
        )
        .where("least <> most")
        .select("sig", "m")
    )
    common = Window.partitionBy("rep").orderBy(
        F.col("sig").bitwiseAND(F.lit(1)).desc(), F.desc("m"), "sig"
    )
    rest = stage(
        placed.join(mixed, "sig")
        .join(reps.select("rep", "slack", "n"), "rep")
        .withColumn("place", F.row_number().over(common))
        .where(F.col("place") > F.expr("(slack - 1) div 2"))
        .select("sig", "rep", "label", "n"),
        "rest",
    )
    ties = rest.join(rest.groupBy("sig").agg(F.min("rep").alias("v")), "sig")
    tied = connected(ties.select(F.col("rep").alias("u"), "v"))
    return (
        tied.withColumnRenamed("label", "family")
        .join(rest.select("rep", "label", "n").distinct(), F.col("node") == F.col("rep"))
        .select("family", "rep", "label", "n")
    )


def _blocks(families: DataFrame, growth: float) -> tuple[DataFrame, DataFrame]:
    """(family, block, rep, label) and the pairs of blocks (family, left, right) to compare.

    Blocks are cut by size first, and blocks of sizes too far apart do not meet.  A component that
    fills blocks has blocks of its own, which are not compared with each other; small
    components share blocks.
    """

    def wanted(rows: str, items: str):
        return F.ceil(F.greatest(F.col(rows) / BLOCK_SETS, F.col(items) / BLOCK_ITEMS, F.lit(1.0)))

    sized = families.withColumn("scale", F.floor(F.log(F.col("n")) / math.log(growth)))
    parts = sized.groupBy("family", "scale", "label").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("items")
    )
    parts = parts.withColumn("own", wanted("sets", "items")).withColumn("large", F.col("own") > 1)
    several = parts.groupBy("family").agg(F.countDistinct("label").alias("labels"))
    small = parts.where("not large").groupBy("family", "scale")
    shared = small.agg(F.sum("sets").alias("sets"), F.sum("items").alias("items"))
    parts = (
        parts.select("family", "scale", "label", "own", "large")
        .join(several.where("labels > 1").select("family"), "family")
        .join(
            shared.select("family", "scale", wanted("sets", "items").alias("shared")),
            ["family", "scale"],
            "left",
        )
    )
    own = F.struct("label", F.pmod(F.xxhash64("rep"), F.col("own")).alias("no"))
    together = F.struct(
        F.lit(None).cast("bigint").alias("label"),
        F.pmod(F.xxhash64("label"), F.col("shared")).alias("no"),
    )
    block = F.when(F.col("large"), own).otherwise(together)
    placed = stage(
        sized.join(parts, ["family", "scale", "label"]).select(
            "family", F.struct("scale", block.alias("part")).alias("block"), "rep", "label"
        ),
        "blocks",
    )
    one = placed.select("family", F.col("block").alias("left")).distinct()
    other = placed.select("family", F.col("block").alias("right")).distinct()
    apart = F.col("left.part.label").isNull() | ~F.col("left.part.label").eqNullSafe(
        F.col("right.part.label")
    )
    near = F.abs(F.col("left.scale") - F.col("right.scale")) <= 1
    pairs = one.join(other, "family").where((F.col("left") <= F.col("right")) & apart & near)
    return placed, stage(pairs, "block_pairs")


def _block_links(families: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links (u, v) between sets of one family in different components, by blocks."""
    a, b = similarity
    # a little more than the largest ratio of sizes, so that rounding loses no pair
    placed, pairs = _blocks(stage(families, "families"), 1.01 * b / a)

    def meet(group: pa.Table) -> pa.Table:
        rep, label = group["rep"].to_numpy(), group["label"].to_numpy()
        lists = group["items"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        u, v = similar_pairs(lists.flatten().to_numpy(), bounds, label, a, b)
        return pa.table({"u": rep[u], "v": rep[v]})

    of = pairs.select(F.col("family").alias("of"), "left", "right")
    two = of.where(~F.col("left").eqNullSafe(F.col("right")))
    ends = of.select("*", F.col("left").alias("end")).union(
        two.select("*", F.col("right").alias("end"))
    )
    here = (F.col("family") == F.col("of")) & F.col("block").eqNullSafe(F.col("end"))
    rows = placed.join(ends, here).select("of", "left", "right", "rep", "label")
    rows = rows.join(sets.select("rep", "items"), "rep")
    ship(rows.sparkSession)
    return rows.groupBy("of", "left", "right").applyInArrow(meet, "u bigint, v bigint")


def similar_pairs(items: np.ndarray, bounds: np.ndarray, label: np.ndarray, a: int, b: int):
    """Index pairs of sets with similarity a / b or more and different labels.

    ``items`` holds the sets one after the other.  Elements of a single set cannot be
    common; over the others, products of 0/1 matrices count the common elements.
    """
    size = np.diff(bounds)
    count = len(size)
    owner = np.repeat(np.arange(count), size)
    order = np.argsort(items, kind="stable")
    ordered, owner = items[order], owner[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    element = np.cumsum(new) - 1
    often = np.bincount(element) > 1 if len(element) else np.zeros(0, bool)
    keep = often[element]
    owner, element = owner[keep], (np.cumsum(often) - 1)[element[keep]]
    common = np.zeros((count, count), np.float32)
    for at in range(0, int(often.sum()), COLUMNS):
        here = (element >= at) & (element < at + COLUMNS)
        matrix = np.zeros((count, COLUMNS), np.float32)
        matrix[owner[here], element[here] - at] = 1
        common += matrix @ matrix.T
    common = np.rint(common).astype(np.int64)
    union = size[:, None] + size[None, :] - common
    linked = (b * common >= a * union) & (label[:, None] != label[None, :])
    u, v = np.nonzero(np.triu(linked, 1))
    return u, v


@tidy
def _labelled(
    docs: DataFrame, width: int, similarity: tuple[int, int]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, reps, labels) of documents (doc_id, key, text): a class row per document, the
    distinct sets, and (node, label) for the reps that are linked with another."""
    classes = stage(set_classes(docs, width, similarity), "classes")
    reps = class_table(classes)
    members = _members(stage(buckets(signature_rows(docs, width, similarity)), "buckets"), reps)
    most = Window.partitionBy("v").orderBy(F.desc("shared"), "u")
    pairs = stage(
        members.where("rep <> lead")
        .groupBy(F.col("lead").alias("u"), F.col("rep").alias("v"))
        .agg(F.count(F.lit(1)).alias("shared"))
        .withColumn("place", F.row_number().over(most))
        .where(F.col("place") <= LEADS)
        .select("u", "v"),
        "pairs",
    )
    involved = members.select("rep").distinct()
    wanted = stage(
        reps.join(involved, "rep").select("rep", "k1", "k2", "doc_id", "key"), "wanted"
    )
    sets = stage(_shingle_sets(docs, wanted, width), "sets")
    links = stage(_verified(pairs, sets, similarity), "links")
    labels = stage(connected(links), "labels")
    further = stage(
        _block_links(_families(members, labels, reps), sets, similarity), "links"
    )
    if not further.isEmpty():
        labels = stage(connected(links.union(further)), "labels")
    return classes, reps, labels


def _components(
    docs: DataFrame, id_col: str, text_col: str, width: int, similarity: tuple[int, int]
) -> DataFrame:
    """doc_id, key, n, component (a number, null without words), least (id of the component)
    and own (id of the class) for each row."""
    text = F.col(text_col)
    docs = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text_key(text).alias("key"), text.alias("text")
    )
    classes, reps, labels = _labelled(docs, width, similarity)
    placed = reps.join(labels, F.col("rep") == labels.node, "left").select(
        "k1", "k2", F.col("least").alias("own"), F.coalesce("label", "rep").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("own").alias("least"))
    return (
        classes.drop("slack")
        .join(placed.join(least, "component"), ["k1", "k2"], "left")
        .select("doc_id", "key", "n", "component", "least", "own")
    )


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id for each row.

    Documents whose shingle sets are equal form a class, named by its smallest id.  Classes
    are linked when their sets' similarity is at least ``similarity``; a component is named
    by its smallest id.  Documents without words or with null text are
    linked with nothing; a row without an id belongs to its class but never names it, and a
    class or component without any id has none.  Rows of one id are documents of their
    own: two texts under one id are not linked by it, though each may give a component that name.

    Each set is first compared with the few leads it shares most buckets with.  Afterwards
    only members of families that are still in different components are, block by
    block, so no link between components is missed and no list of pairs is made.
    """
    found = _components(docs, id_col, text_col, width, similarity)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("own")).otherwise(F.col("doc_id")).alias("class_id"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document stays: that with the smallest id of each component.

    Rows without an id come after those with one; rows of one id are ordered by a hash of their
    texts.  Rows that repeat id and text are one document and stay or go together.
    """
    found = stage(_components(docs, id_col, text_col, WIDTH, SIMILARITY), "components").where(
        F.col("component").isNotNull()
    )
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    stays = found.groupBy("component").agg(F.min(place).alias("first"))
    gone = (
        found.join(stays, "component")
        .where(~place.eqNullSafe(F.col("first")))
        .select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"))
        .distinct()
    )
    here = F.col(id_col).cast("bigint").eqNullSafe(F.col("gone_id")) & (
        text_key(F.col(text_col)) == F.col("gone_key")
    )
    return docs.join(gone, here, "left_anti").select(*docs.columns)
