"""Quality rules: repetition inside a document, and line frequency across documents.

Lines are normalised and hashed; for each host the distinct documents that hold a line are
counted, where documents with the same text are one.  A line in more of them than the
limits allow is boilerplate: it is removed, and a document that has too little left is
rejected.  By the limits' share, a host has at most (lines per document) / share such lines.
Near copies can count as one document too, so that a group of them does not lose its lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.llm import partenum
from panelworks.llm.common import batch, map_batches, mix, slices, stage, utf8
from panelworks.session import tidy

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
_SPACE = b"\x20\t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate in a host when more than ``documents`` and more than ``share`` of
    the host's distinct documents hold it.  A document is depleted when fewer than
    ``words`` words, or less than ``left`` of its words, remain without such lines."""

    documents: int = 20
    share: float = 0.05
    words: int = 10
    left: float = 0.3
    repeated: float = 20.0  # largest percentage of words in repeated windows


LIMITS = Limits()


def line_hash(line: bytes) -> int | None:
    """Hash of a line with A-Z lower-cased and white space collapsed; None if it has no word."""
    words = line.lower().split()
    return xxhash.xxh3_64_intdigest(b" ".join(words)) if words else None


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


_LINE = pa.schema([("host", pa.string()), ("line", pa.int64()), ("document", pa.int64())])


def document_lines(docs: DataFrame) -> DataFrame:
    """(host, line, document) for each distinct line of each row; ``docs`` has host and text.

    ``document`` is the column of that name, or a hash of the text if there is none.
    """
    named = "document" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            rows, lines, documents = [], [], []
            for i, text in enumerate(utf8(x.column("text"))):
                own = {line_hash(s) for s in (text or b"").split(b"\n")} - {None}
                rows += [i] * len(own)
                lines += own
                if not named:
                    documents += [xxhash.xxh3_64_intdigest(text or b"")] * len(own)
            rows = pa.array(rows, pa.int64())
            hosts = x.column("host").take(rows)
            yield batch(
                _LINE,
                host=hosts.cast(pa.string()),
                line=_signed(lines),
                document=x.column("document").take(rows) if named else _signed(documents),
            )

    return map_batches(docs, run, "host string, line bigint, document bigint")


@tidy
def _as_near_groups(docs: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame] | None:
    """(host, line, document) and (host, document) where ``document`` is a group of near copies.

    Groups are those of near dedup, over distinct texts.  A line in more groups than
    the limit is in more texts too, so just the lines of that many texts are looked at; None if
    there is no such line.
    """
    text = F.xxhash64(F.coalesce("text", F.lit(""))).alias("document")
    docs = docs.select("host", "text", text)
    lines = document_lines(docs)
    common = stage(
        lines.distinct()
        .groupBy(F.col("host").alias("of"), F.col("line").alias("common"))
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") > limits.documents)
        .drop("documents"),
        "common",
    )
    if common.isEmpty():
        return None
    # hosts without such a line have no boilerplate, whatever their groups are
    hosts = common.select("of").distinct()
    docs = docs.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left_semi")
    found = partenum.jaccard_components(docs, "document")
    groups = stage(
        found.select(F.col("doc_id").alias("document"), F.col("component_id").alias("near")).distinct(),
        "near_groups",
    )
    here = (F.col("line") == F.col("common")) & F.col("host").eqNullSafe(F.col("of"))
    near = F.col("near").alias("document")
    held = lines.join(common, here, "left_semi").distinct()
    return (
        held.join(groups, "document").select("host", "line", near),
        docs.select("host", "document").distinct().join(groups, "document").select("host", near),
    )


def frequent_lines(
    docs: DataFrame, limits: Limits = LIMITS, near_copies: bool = False
) -> DataFrame:
    """(host, lines): the sorted hashes of each host's boilerplate lines.

    With ``near_copies`` near copies of a text count as one document of the host.
    """
    grouped = _as_near_groups(docs, limits) if near_copies else None
    if near_copies and grouped is None:
        return docs.sparkSession.createDataFrame([], "host string, lines array<bigint>")
    lines, documents = grouped or (
        document_lines(docs),
        docs.select("host", F.xxhash64(F.coalesce("text", F.lit(""))).alias("document")),
    )
    held = (
        lines.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents"))
    ).where(F.col("documents") > limits.documents)
    hosts = (
        documents.distinct()
        .groupBy(F.col("host").alias("of"))
        .agg(F.count(F.lit(1)).alias("all"))
        .where(F.col("all") > limits.documents)
    )
    return (
        held.join(hosts, F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("documents") > F.col("all") * limits.share)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


class _Numbers(dict):
    """Numbers words in the order in which they appear."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def repeated_words(words: np.ndarray, counts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Per text, the words in windows of ``width`` words found twice or more in that text.

    ``words`` holds word numbers of all texts in a row, ``counts`` the words of each.
    Windows are compared by hash first; those that meet are then compared word by word.
    """
    full = np.maximum(counts - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), full)
    starts = np.cumsum(counts) - counts
    first = starts[text] + np.arange(len(text)) - np.repeat(np.cumsum(full) - full, full)
    value = mix(text.astype(np.uint64))
    numbers = words.astype(np.uint64)
    for k in range(width):
        value = (value ^ numbers[first + k]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    ordered = np.sort(value)
    met = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(len(counts), np.int64)
    if not met.size:
        return out
    at = np.minimum(np.searchsorted(met, value), len(met) - 1)
    found = np.flatnonzero(met[at] == value)
    windows = np.column_stack([text[found], *(words[first[found] + k] for k in range(width))])
    order = np.lexsort(windows.T[::-1])
    same = (windows[order][1:] == windows[order][:-1]).all(1)
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    mark = np.zeros(len(words) + 1, np.int64)
    begin = first[found[twice]]
    np.add.at(mark, begin, 1)
    np.add.at(mark, begin + width, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(mark)[:-1] > 0)])
    return covered[starts + counts] - covered[starts]


_STAT_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_statistics(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """The counts of the base rules for a list of texts; null text counts as empty."""
    numbers = _Numbers()
    ids: list[int] = []
    out = {name: np.zeros(len(texts), np.int64) for name in _STAT_NAMES}
    for i, text in enumerate(texts):
        if not text:
            continue
        words = text.split()
        ids += map(numbers.__getitem__, words)
        out["n_words"][i] = len(words)
        raw = np.frombuffer(text, np.uint8)
        spaces = int((((raw >= 9) & (raw <= 13)) | (raw == 32)).sum())
        out["word_chars"][i] = len(raw) - int(((raw & 0xC0) == 0x80).sum()) - spaces
        out["n_symbols"][i] = sum(text.count(SYMBOLS[k : k + 1]) for k in range(len(SYMBOLS)))
        lines = [s for s in text.split(b"\n") if s.strip(_SPACE)]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    out["n_repeat_words"] = repeated_words(np.array(ids, np.int64), out["n_words"])
    return out


_VERDICT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, n_removed_lines bigint, words_left bigint, "
    "kept boolean, clean_text string"
)


def judge(
    docs: DataFrame,
    limits: Limits = LIMITS,
    text_col: str = "text",
    host_col: str = "source",
    keep: list[str] | None = None,
    near_copies: bool = False,
) -> DataFrame:
    """The columns ``keep`` of each row (all by default) in a struct ``row``, with the counts,
    base_failed, n_removed_lines, words_left, kept and clean_text.

    clean_text is the text without boilerplate lines (null for null text).  A null host is a
    host of its own.  An empty text fails the base rules.  Copies of a text count as one
    document, so a line is not boilerplate because its document was copied; with
    ``near_copies`` so do near copies.
    """
    keep = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"),
        F.col(text_col).alias("text"),
        F.col(host_col).cast("string").alias("host"),
    )
    lines = frequent_lines(rows.select("host", "text"), limits, near_copies)
    frequent = stage(lines, "frequent")
    joined = rows.join(
        frequent.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")), "left"
    ).select("row", "text", "lines")
    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL(_VERDICT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            texts = utf8(x.column("text"))
            out = text_statistics(texts)
            failed = (out["n_words"] < 10) | (
                100 * out["n_repeat_words"] > limits.repeated * out["n_words"]
            )
            clean, removed, left = _without_lines(texts, x.column("lines"), out["n_words"])
            enough = (left >= limits.words) & (left >= limits.left * out["n_words"])
            yield pa.RecordBatch.from_arrays(
                [
                    x.column("row"),
                    *(pa.array(out[name]) for name in _STAT_NAMES),
                    pa.array(failed),
                    pa.array(removed),
                    pa.array(left),
                    pa.array(~failed & enough),
                    clean,
                ],
                names=["row", *(part.split()[0] for part in _VERDICT.split(", "))],
            )

    return map_batches(joined, run, schema)


def _without_lines(texts: list[bytes | None], lines: pa.Array, words: np.ndarray):
    """Texts without the given lines, how many lines went, and the words left."""
    removed, left = np.zeros(len(texts), np.int64), words.copy()
    clean, bad, known = [], set(), None
    for i, text in enumerate(texts):
        listed = lines[i]
        if not text or not listed.is_valid:
            clean.append(text)
            continue
        if known is None or not listed.equals(known):
            bad, known = {v & 0xFFFFFFFFFFFFFFFF for v in listed.as_py()}, listed
        own = text.split(b"\n")
        stay = [s for s in own if line_hash(s) not in bad]
        removed[i] = len(own) - len(stay)
        if removed[i]:
            text = b"\n".join(stay)
            left[i] = len(text.split())
        clean.append(text)
    return pa.array(clean, pa.binary()).cast(pa.string()), removed, left


def keep_good(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The rows that the rules keep, without boilerplate lines, columns as in ``docs``.

    Near copies count as one document, so one of a large group of them is left for near dedup.
    ``n_chars`` follows the text if the column is there.
    """
    # the text comes back as clean_text, so it need not travel twice
    others = [c for c in docs.columns if c != "text"]
    judged = judge(docs, limits, keep=others or ["source"], near_copies=True).where("kept")
    replaced = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced["n_chars"] = F.char_length("clean_text").cast(kind)
    return judged.select(
        *[
            (replaced[c] if c in replaced else F.col("row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
