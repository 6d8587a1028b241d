"""Removal of byte strings that occur twice, with a sparse suffix array sorted deep-shallow.

Every string of ``length`` bytes has an anchor: the first of the ``GRAM``-byte grams in it with the
smallest hash.  Equal strings have equal grams at the same place in them, so strings meet if and
only if their anchors do, and only suffixes at anchors need sorting.  Strings with one
anchor start in a row; the bytes they span are the anchor's segment.

Grams that occur once are left out first.  Segments that occur twice as a whole are settled
by their hash, so copies never travel.  What is left are the edges of repeated passages:
different segments with the same gram.  One of each goes to its gram's group, where the
suffixes that start at the anchors, and the reversed prefixes that end there, are sorted.  A
string that starts ``o`` bytes before the anchor is repeated if another segment agrees with it for
``o`` bytes to the left and ``length - o`` to the right.  The segments that agree for ``o`` bytes to
the left are an interval of the sorted prefixes; of these, the neighbours in the order of the
suffixes agree for the most bytes to the right.

Groups above ``HOT`` segments are not sorted in one task: their strings are counted one by
one over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.llm.common import BYTES, batch, map_batches, merged, mix, powers, slices, stage, utf8
from panelworks.llm.deepshallow import common_prefix, deep_shallow
from panelworks.session import tidy

# Bytes of a string that must not occur twice.
LENGTH = 200
# Bytes of the grams that anchors are chosen by.
GRAM = 64
# Different segments of one gram that a task sorts.
HOT = 50_000
# Bytes that are turned into arrays at once; a longer text is looked at in overlapping pieces.
PIECE = 1 << 18

_HIGH = np.uint64(0xFFFFFFFF00000000)


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` bytes of an array of bytes."""
    up, down = powers(len(raw))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTES[raw] * up)])
    return mix((upto[gram:] - upto[:-gram]) * down[: len(raw) - gram + 1])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        x = np.minimum(x[:-step], x[step:])
        reach += step
    return x


def string_anchors(raw: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(at, low, high, hash): anchors in the texts that follow each other in ``raw``.

    ``ends`` has the end of each text.  The strings that start at low to high have the anchor at.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none
    hashes = gram_hashes(raw, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least((hashes & _HIGH) | places, length - gram + 1)
    at = (least & ~_HIGH).astype(np.int64)
    # strings that reach into the next text are none
    begins = np.concatenate([[0], ends[:-1]])
    change = np.zeros(len(at) + 1, np.int64)
    long = ends - begins >= length
    np.add.at(change, begins[long], 1)
    np.add.at(change, ends[long] - length + 1, -1)
    inside = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if not inside.size:
        return none, none, none, none
    own = at[inside]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.append(first[1:], len(own)) - 1
    return own[first], inside[first], inside[last], hashes[own[first]].view(np.int64)


def _pieces(texts: list[bytes | None], length: int, limit: int = PIECE):
    """Lists of (row, offset, bytes) of about ``limit`` bytes; pieces of a longer text overlap,
    so that each string is in one of them."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(len(text or b"") - length + 1, 0), limit):
            piece = text[start : start + limit + length - 1]
            if held and size + len(piece) > limit:
                yield held
                held, size = [], 0
            held.append((row, start, piece))
            size += len(piece)
    if held:
        yield held


_ANCHOR = pa.schema(
    [
        ("t1", pa.int64()),
        ("t2", pa.int64()),
        ("at", pa.int32()),
        ("low", pa.int32()),
        ("high", pa.int32()),
        ("gram", pa.int64()),
        ("segment", pa.int64()),
    ]
)
_ANCHOR_DDL = "t1 bigint, t2 bigint, at int, low int, high int, gram bigint, segment bigint"


def text_keys(text: Column) -> tuple[Column, Column]:
    """A 128-bit key of a text; rows with equal texts have equal results."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def segments(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(t1, t2, at, low, high, gram, segment) per anchor of the texts (t1, t2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            for held in _pieces(utf8(x.column("text")), length):
                whole = b"".join(piece for _, _, piece in held)
                sizes = np.array([len(piece) for _, _, piece in held], np.int64)
                ends = np.cumsum(sizes)
                raw = np.frombuffer(whole, np.uint8)
                at, low, high, hashed = string_anchors(raw, ends, length, gram)
                which = np.searchsorted(ends, at, side="right")
                base = np.array([start for _, start, _ in held], np.int64)[which]
                base -= (ends - sizes)[which]
                digest = xxhash.xxh3_64_intdigest
                found = [
                    digest(whole[a:b], s)
                    for a, b, s in zip(
                        low.tolist(), (high + length).tolist(), (at - low).tolist(), strict=True
                    )
                ]
                rows = pa.array(np.array([row for row, _, _ in held], np.int64)[which])
                yield batch(
                    _ANCHOR,
                    t1=x.column("t1").take(rows),
                    t2=x.column("t2").take(rows),
                    at=(at + base).astype(np.int32),
                    low=(low + base).astype(np.int32),
                    high=(high + base).astype(np.int32),
                    gram=hashed,
                    segment=np.array(found, np.uint64).view(np.int64),
                )

    return map_batches(texts, run, _ANCHOR_DDL)


def repeated_starts(
    lefts: list[bytes], rights: list[bytes], length: int
) -> list[list[tuple[int, int]]]:
    """Per segment of a gram, ranges [from, to] of the distances before the anchor at which
    strings start that another segment has too.

    ``lefts`` are the bytes before the anchor, reversed; ``rights`` those from it on.
    """
    out: list[list[tuple[int, int]]] = [[] for _ in lefts]

    def compare(members: list[int], left: int) -> None:
        """Neighbours among segments that agree for ``left`` bytes before the anchor."""
        for a, b in zip(members, members[1:], strict=False):
            right = common_prefix(rights[a], rights[b])
            if left + right >= length:
                for m in (a, b):
                    out[m].append((length - right, left))

    if len(lefts) == 2:
        compare([0, 1], common_prefix(*lefts))
        return out
    rank = [0] * len(rights)
    for place, m in enumerate(deep_shallow(rights)):
        rank[m] = place
    ordered = deep_shallow(lefts)
    shared = [common_prefix(lefts[a], lefts[b]) for a, b in zip(ordered, ordered[1:], strict=False)]
    # intervals of the sorted prefixes, innermost first: (shared bytes, where it begins)
    open_: list[tuple[int, int]] = []
    for place, depth in enumerate([*shared, -1]):
        begin = place
        while open_ and open_[-1][0] > depth:
            left, begin = open_.pop()
            compare(sorted(ordered[begin : place + 1], key=rank.__getitem__), left)
        if depth >= 0 and (not open_ or open_[-1][0] < depth):
            open_.append((depth, begin))
    return out


_MEMBER = "t1 bigint, t2 bigint, at int, low int, high int, gram bigint, body binary"
_RANGE = pa.schema(
    [("t1", pa.int64()), ("t2", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]
)
_RANGE_DDL = "t1 bigint, t2 bigint, start int, end int"


def _bodies(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted segments with their bytes; one row per segment and task."""
    schema = pa.schema([*list(_ANCHOR)[:6], ("body", pa.binary())])
    named = ("at", "low", "high", "gram")
    listed = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct(*named)).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for x in slices(batches):
            out = {name: [] for name in schema.names}
            for row, text in enumerate(utf8(x.column("text"))):
                key = (x.column("t1")[row].as_py(), x.column("t2")[row].as_py())
                if key == before:  # copies of a text come one after the other
                    continue
                before = key
                for p in x.column("places")[row].as_py():
                    for name in named:
                        out[name].append(p[name])
                    out["t1"].append(key[0])
                    out["t2"].append(key[1])
                    out["body"].append(text[p["low"] : p["high"] + length])
            yield batch(schema, **out)

    joined = texts.join(listed, ["t1", "t2"]).select("t1", "t2", "text", "places")
    return map_batches(joined, run, _MEMBER)


def _sorted_groups(members: DataFrame, length: int) -> DataFrame:
    """(t1, t2, start, end): what is repeated of each member of a gram's group."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        gram, held = None, {}
        columns = ("t1", "t2", "at", "low", "high", "body")
        for x in batches:
            for own, *row in zip(
                x.column("gram").to_pylist(),
                *(x.column(c).to_pylist() for c in columns),
                strict=True,
            ):
                if own != gram and held:
                    yield list(held.values())
                    held = {}
                gram = own
                held[tuple(row[:5])] = row
        if held:
            yield list(held.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            return batch(_RANGE, **dict(zip(_RANGE.names, columns, strict=True)))

        for rows in groups(batches):
            if len(rows) < 2:
                continue
            lefts = [body[: at - low][::-1] for _, _, at, low, _, body in rows]
            rights = [body[at - low :] for _, _, at, low, _, body in rows]
            for (t1, t2, at, *_), starts in zip(
                rows, repeated_starts(lefts, rights, length), strict=True
            ):
                out += [(t1, t2, at - most, at - least + length) for least, most in starts]
            if len(out) > 50_000:
                yield ready()
                out = []
        yield ready()

    ordered = members.repartition("gram").sortWithinPartitions("gram")
    return map_batches(ordered, run, _RANGE_DDL)


def _counted_strings(members: DataFrame, length: int) -> DataFrame:
    """What :func:`_sorted_groups` returns, for groups too large to sort in one task."""
    schema = pa.schema([*list(_RANGE)[:3], ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches, "body", PIECE >> 1):
            digests, rows, starts = [], [], []
            for row, (low, high, body) in enumerate(
                zip(*(x.column(c).to_pylist() for c in ("low", "high", "body")), strict=True)
            ):
                for k in range(high - low + 1):
                    digests.append(xxhash.xxh3_128_digest(body[k : k + length]))
                    rows.append(row)
                    starts.append(low + k)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield batch(
                schema,
                t1=x.column("t1").take(at),
                t2=x.column("t2").take(at),
                start=pa.array(starts, pa.int32()),
                h1=np.ascontiguousarray(halves[:, 0]),
                h2=np.ascontiguousarray(halves[:, 1]),
            )

    strings = stage(
        map_batches(
            members.dropDuplicates(["t1", "t2", "at", "low"]),
            run,
            "t1 bigint, t2 bigint, start int, h1 bigint, h2 bigint",
        ),
        "strings",
    )
    twice = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return strings.join(twice, ["h1", "h2"], "left_semi").select(
        "t1", "t2", "start", (F.col("start") + length).cast("int").alias("end")
    )


@tidy
def repeated_ranges(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """(t1, t2, ranges): start and end of repeated bytes per text, unordered and overlapping;
    ``texts`` has a row (t1, t2, text) per document."""
    same = ["gram", "segment"]
    anchors = stage(segments(texts, length, gram), "anchors")
    often = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    again = stage(anchors.join(often, "gram", "left_semi"), "again")
    kinds = stage(
        again.groupBy(*same).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("t1", "t2", "at", "low", "high")).alias("one"),
        ),
        "kinds",
    )
    whole = again.join(kinds.where("n > 1").select(*same), same, "left_semi").select(
        "t1", "t2", F.col("low").alias("start"), (F.col("high") + length).cast("int").alias("end")
    )
    groups = (
        kinds.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
        .where("kinds > 1 and least = 1")
        .select("gram", "kinds")
    )
    wanted = stage(kinds.join(groups, "gram").select("gram", "kinds", "one.*"), "wanted")
    found = whole
    parts = [wanted.where(F.col("kinds") <= hot), wanted.where(F.col("kinds") > hot)]
    for part, settle in zip(parts, (_sorted_groups, _counted_strings), strict=True):
        if not part.isEmpty():
            found = found.union(settle(_bodies(texts, part, length), length))
    listed = found.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    return stage(listed, "ranges")


_OUT = "n_bytes bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept binary"


@tidy
def remove_repeated_bytes(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) of each row in a struct ``row``, with n_bytes,
    n_removed, spans and kept.

    Removed is each byte of a string of ``length`` bytes that starts anywhere else too, in the same
    text or in that of another row; spans are maximal runs of such bytes, kept is what
    is left.  Null texts count as empty.  Rows that repeat, with or without an id, are
    rows of their own, so texts of ``length`` bytes or more in two rows go altogether.
    """
    keep = docs.columns if keep is None else keep
    text = F.coalesce(F.col(text_col), F.lit(""))
    t1, t2 = text_keys(text)
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        text.alias("text"),
        t1.alias("t1"),
        t2.alias("t2"),
    )
    long = rows.where(F.octet_length("text") >= length).select("t1", "t2", "text")
    ranges = repeated_ranges(long, length, gram, hot).withColumnsRenamed({"t1": "k1", "t2": "k2"})
    here = (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))
    joined = rows.join(ranges, here, "left").select("row", "text", "ranges")
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL(_OUT).fields])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            texts = utf8(x.column("text"))
            spans, kept = [], []
            for text, listed in zip(texts, x.column("ranges").to_pylist(), strict=True):
                own = merged([(r["start"], r["end"]) for r in listed or ()])
                edges = [0, *(e for r in own for e in r), len(text)]
                spans.append([{"start": a, "end": b} for a, b in own])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [
                    x.column("row"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                    pa.array(spans, span),
                    pa.array(kept, pa.binary()),
                ],
                names=["row", "n_bytes", "n_removed", "spans", "kept"],
            )

    return map_batches(joined, run, schema)
