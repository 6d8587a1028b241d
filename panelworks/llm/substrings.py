"""Substring deduplication by hashing lines, sentences and the pieces of long ones.

A text is cut into units: lines, and within a line sentences.  Units of many words are cut
further, before each word pair whose hash is the smallest nearby, so that a passage without
sentence ends, or one that other text cuts into, has the same pieces up to a few words from its
ends.  A window is a run of pieces with just enough words.  Windows are normalised and
hashed, digests are grouped over all documents, and the occurrence with the smallest (id, text
key, place) stays; the others are removed.  So all that is removed has occurred before, word by
word and in one stretch, and short phrases that recur by chance are left alone.  Offsets
of what was removed refer to the original text.

Texts are cut once, in arrays; the places of the windows go with their digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.llm.common import (
    ARRAY_BYTES,
    FACTOR,
    batch,
    map_batches,
    merged,
    mix,
    powers,
    slices,
    stage,
    text_key,
    utf8,
    word_table,
)
from panelworks.session import tidy

# Words of a window at least.
RUN_WORDS = 25
# A piece starts at a word pair whose hash is the smallest of so many before and after it in the
# unit; on average it has 2 * REACH + 1 words.
REACH = 4
# Units of so many words or fewer are one piece.
SHORT = 8
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_STOP = np.isin(np.arange(256), list(b".!?"))


def piece_starts(hashes: np.ndarray, last: np.ndarray, reach: int = REACH) -> np.ndarray:
    """The words at which pieces start, from the hashes of words and which words end units."""
    unit = np.cumsum(last) - last
    pairs = hashes.copy()
    pairs[:-1] += np.where(last[:-1], np.uint64(0), hashes[1:] * FACTOR)
    pairs = mix(pairs)
    start = np.bincount(unit)[unit] > SHORT if len(unit) else np.zeros(0, bool)
    for k in range(1, min(reach, len(pairs) - 1) + 1):
        before, after, apart = pairs[:-k], pairs[k:], unit[:-k] != unit[k:]
        start[k:] &= (after < before) | apart
        start[:-k] &= (before <= after) | apart
    start[:1] = True
    start[1:] |= last[:-1]
    return np.flatnonzero(start)


def text_windows(texts: list[bytes | None], run_words: int = RUN_WORDS, sentences: bool = True):
    """(text, start, end, h1, h2) of the windows of a list of texts: which text, the byte
    range up to the next word, and a 128-bit digest of the words, A-Z lower-cased.

    Without ``sentences`` the units are lines and are not cut further.
    """
    raw, base, sizes, begin, end, hashes = word_table(texts)
    count = len(begin)
    up, down = powers(count + 1)
    lines = np.cumsum(raw == 10)
    following = np.append(begin[1:], len(raw) - 1)
    last = lines[following] > lines[end - 1]
    if sentences:
        last |= _STOP[raw[end - 1]]
        starts = piece_starts(hashes, last)
    else:
        starts = np.flatnonzero(np.concatenate([[True], last[:-1]])) if count else begin
    text = np.searchsorted(base, begin[starts], side="right") - 1
    bounds = np.append(starts, count)
    upto_text = np.searchsorted(begin, base + sizes)[text]
    fits = starts + run_words <= upto_text
    first, text = starts[fits], text[fits]
    after = bounds[np.searchsorted(bounds, first + run_words)]
    halves = []
    for salt in _SALTS:
        sums = np.cumsum(mix(hashes ^ salt) * up[:count])
        sums = np.concatenate([np.zeros(1, np.uint64), sums])
        halves.append(mix((sums[after] - sums[first]) * down[first]).view(np.int64))
    ends_text = after == upto_text[fits]
    stop = np.where(ends_text, base[text] + sizes[text], np.append(begin, 0)[after])
    return text, begin[first] - base[text], stop - base[text], *halves


_WINDOW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("key", pa.int64()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
    ]
)


def windows(docs: DataFrame, run_words: int = RUN_WORDS, sentences: bool = True) -> DataFrame:
    """(doc_id, key, start, end, h1, h2) per window; ``docs`` has doc_id, key and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches, limit=ARRAY_BYTES):
            text, start, end, h1, h2 = text_windows(utf8(x.column("text")), run_words, sentences)
            rows = pa.array(text)
            yield batch(
                _WINDOW,
                doc_id=x.column("doc_id").take(rows),
                key=x.column("key").take(rows),
                start=start.astype(np.int32),
                end=end.astype(np.int32),
                h1=h1,
                h2=h2,
            )

    return map_batches(
        docs, run, "doc_id bigint, key bigint, start int, end int, h1 bigint, h2 bigint"
    )


@tidy
def repeated_windows(
    docs: DataFrame, run_words: int = RUN_WORDS, sentences: bool = True
) -> DataFrame:
    """(doc_id, key, ranges): byte ranges of a document's windows that occurred before."""
    cut = stage(windows(docs, run_words, sentences), "windows")
    # half a digest tells most windows that occur once; what is left is small
    many = cut.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1")
    again = stage(cut.join(many, "h1", "left_semi"), "again")
    place = F.struct("doc_id", "key", "start")
    firsts = again.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    repeats = (
        again.join(firsts, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "key")
        .agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    )
    return stage(repeats, "repeats")


_OUT = "clean_text string, spans array<struct<start:int,end:int>>, n_removed_chars bigint"


@tidy
def remove_repeats(
    docs: DataFrame,
    run_words: int = RUN_WORDS,
    sentences: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) in a struct ``row``, with clean_text, spans and
    n_removed_chars.

    spans are code point offsets [start, end) in the original text, ascending.  Documents are
    ranked by id, nulls first, then by a hash of the text; rows that repeat id and text are ranked
    as one document, so of two equal rows with one id none loses anything to the other.  Rows
    with one id, or none, and different texts are different documents.  Null text stays null.
    """
    keep = docs.columns if keep is None else keep
    named = (
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_key(F.col(text_col)).alias("key"),
        F.col(text_col).alias("text"),
    )
    repeated = repeated_windows(docs.select(*named), run_words, sentences).select(
        F.col("doc_id").alias("of"), F.col("key").alias("of_key"), "ranges"
    )
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        *named,
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    joined = rows.join(repeated, same, "left").select("row", "text", "ranges")
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL(_OUT).fields])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            clean, spans, removed = [], [], []
            texts, lists = utf8(x.column("text")), x.column("ranges").to_pylist()
            for text, listed in zip(texts, lists, strict=True):
                ranges = merged([(r["start"], r["end"]) for r in listed or ()])
                offsets, at, points, parts = [], 0, 0, []
                for a, b in ranges:
                    parts.append(text[at:a])
                    points += len(text[at:a].decode())
                    size = len(text[a:b].decode())
                    offsets.append({"start": points, "end": points + size})
                    points, at = points + size, b
                clean.append(b"".join([*parts, text[at:]]) if ranges else text)
                spans.append(offsets)
                removed.append(sum(o["end"] - o["start"] for o in offsets))
            yield pa.RecordBatch.from_arrays(
                [
                    x.column("row"),
                    pa.array(clean, pa.binary()).cast(pa.string()),
                    pa.array(spans, span),
                    pa.array(removed, pa.int64()),
                ],
                names=["row", "clean_text", "spans", "n_removed_chars"],
            )

    return map_batches(joined, run, schema)


def drop_repeats(docs: DataFrame, run_words: int = RUN_WORDS) -> DataFrame:
    """The rows of ``docs`` without repeated passages, columns as they are.

    ``n_chars`` follows the text if the column is there.  A row of which nothing but
    white space is left is dropped; rows that had no text to begin with stay.
    """
    # the text comes back as clean_text, so it need not travel twice
    done = remove_repeats(docs, run_words, keep=[c for c in docs.columns if c != "text"])
    emptied = (F.col("n_removed_chars") > 0) & ~F.col("clean_text").rlike(r"[^\x20\x09-\x0D]")
    replaced = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced["n_chars"] = F.char_length("clean_text").cast(kind)
    return done.where(~emptied).select(
        *[
            (replaced[c] if c in replaced else F.col("row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
