"""Spelling variants: words one edit apart, found along a relational trie.

Words are the rows of two tries, one of the words and one of the words reversed, each kept apart
by word length.  A trie is a table of edges (depth, node, symbol, child), where a node is the
hash of its prefix.  A frontier of states (word, position, node, edits) walks it level by level:
each level is one equality join of the states with the edges of that depth.  States without an
edit stay on their own word's path; at each position from the middle of the word on they step to
the other children of the node (a replaced code point), or stay on the node of the trie of
shorter words (a deleted one).  States with an edit follow the one edge that fits.  Two words
one edit apart agree on their first or on their last half, so starting in the middle of both
tries loses none and keeps the frontier out of the dense top of the trie.  An edge below which
there is one word ends the walk: the rests of both words are compared.

Inserted code points are deleted ones seen from the other word.  Words longer than
:data:`LONGEST` do not enter the tries, as each level is a job: two of them are compared if
they agree on the half of which one edit cannot touch both.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.llm.common import stage
from panelworks.session import tidy

# Letters of words: A-Z, a-z and the Latin-1 letters (with the two signs between them).
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form must be so many times as frequent as the words that take it.
RATIO = 5
# Longest word of the tries, in code points.
LONGEST = 64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(
        F.translate(word, _UPPER, _UPPER.lower())
    )


def count_words(
    docs: DataFrame,
    change: Callable[[Column, Column], Column] | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences, A-Z lower-cased.

    ``change(id, word)`` may rewrite each occurrence and must not lengthen it.  Null texts have
    no words; a null id is an empty string for ``change``.
    """
    found = F.regexp_extract_all(
        F.coalesce(F.col(text_col), F.lit("")), F.lit(f"({LETTERS}{{{least_length},}})"), F.lit(1)
    )
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(found).alias("found"),
    ).select("id", lower_ascii(F.col("found")).alias("word"))
    if change is not None:
        rows = rows.select(change(F.col("id"), F.col("word")).alias("word"))
    return (
        rows.where(F.char_length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_count)
    )


def _node(way: Column, length: Column, prefix: Column) -> Column:
    return F.xxhash64(way, length, prefix)


def _at(text: Column, position: Column) -> Column:
    """The code point at a position from 0; the empty string past the end."""
    return F.substr(text, position + 1, F.lit(1))


def _rest(text: Column, position: Column) -> Column:
    return F.substr(text, position + 1)


def both_ways(words: DataFrame) -> DataFrame:
    """(way, path, length): each word read forwards (0) and backwards (1)."""
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("path")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("path")),
    )
    return words.select(F.explode(ways).alias("x")).select(
        "x.way", "x.path", F.char_length("x.path").alias("length")
    )


def edge_table(paths: DataFrame) -> DataFrame:
    """(depth, node, symbol, child, below, only) from the middle of each path on.

    below counts the words under the edge and only is one of them.  The end of a word is an edge
    with an empty symbol.
    """
    depths = F.sequence(F.floor(F.col("length") / 2).cast("int"), F.col("length"))
    steps = paths.select("way", "path", "length", F.explode(depths).alias("depth"))
    prefix = F.substr("path", F.lit(1), F.col("depth"))
    longer = F.substr("path", F.lit(1), F.col("depth") + 1)
    return (
        steps.select(
            "depth",
            _node(F.col("way"), F.col("length"), prefix).alias("node"),
            _at(F.col("path"), F.col("depth")).alias("symbol"),
            _node(F.col("way"), F.col("length"), longer).alias("child"),
            "path",
        )
        .groupBy("depth", "node", "symbol", "child")
        .agg(F.count(F.lit(1)).alias("below"), F.min("path").alias("only"))
    )


def _own_states(paths: DataFrame, depth: int) -> DataFrame:
    """States without an edit at a depth, and those that delete the code point there.

    Of equal code points in a row only the last is deleted.
    """
    here = paths.where((F.floor(F.col("length") / 2) <= depth) & (F.col("length") > depth))
    prefix = F.substr("path", F.lit(1), F.lit(depth))
    at = F.lit(depth)
    kept = F.struct(
        F.lit(depth).alias("position"),
        _node(F.col("way"), F.col("length"), prefix).alias("node"),
        F.lit(0).alias("edits"),
    )
    deleted = F.struct(
        F.lit(depth + 1).alias("position"),
        _node(F.col("way"), F.col("length") - 1, prefix).alias("node"),
        F.lit(1).alias("edits"),
    )
    last = _at(F.col("path"), at) != _at(F.col("path"), at + 1)
    states = F.when(last, F.array(kept, deleted)).otherwise(F.array(kept))
    return here.select("way", "path", F.explode(states).alias("s")).select(
        "way", "path", "s.position", "s.node", "s.edits"
    )


def _step(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """States one level further down, with ``found`` set where the walk met a word."""
    path, position = F.col("path"), F.col("position")
    fits = F.col("symbol") == _at(path, position)
    moved = (
        states.join(edges.where(F.col("depth") == depth).drop("depth"), "node")
        # an own path goes on by itself, so its own edge is left out here
        .where(F.when(F.col("edits") == 1, fits).otherwise(~fits & (F.col("symbol") != "")))
    )
    single = F.col("below") == 1
    meets = _rest(path, position + 1) == _rest(F.col("only"), F.lit(depth + 1))
    return moved.where(~single | meets).select(
        "way",
        "path",
        (position + 1).cast("int").alias("position"),
        F.col("child").alias("node"),
        F.lit(1).alias("edits"),
        F.when(single, F.col("only")).alias("found"),
    )


def _trie_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for words of the tries; near is as long as word or one shorter."""
    paths = stage(both_ways(words), "paths")
    edges = stage(
        edge_table(paths).repartitionByRange("depth", "node").sortWithinPartitions("depth", "node"),
        "edges",
    )
    lengths = paths.agg(F.min("length"), F.max("length")).first()
    shortest, longest = lengths[0] or 0, lengths[1] or -1
    frontier, levels = None, []
    for depth in range(shortest // 2, longest + 1):
        states = _own_states(paths, depth)
        if frontier is not None:
            states = states.unionByName(frontier)
        level = stage(_step(states, edges, depth), "level")
        levels.append(level.where(F.col("found").isNotNull()))
        frontier = level.where(F.col("found").isNull()).drop("found")
    if not levels:
        return words.select("word", F.col("word").alias("near")).limit(0)
    found = reduce(DataFrame.union, levels)

    def straight(path: str) -> Column:
        return F.when(F.col("way") == 0, F.col(path)).otherwise(F.reverse(path))

    return found.select(straight("path").alias("word"), straight("found").alias("near"))


def _long_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for words beyond the tries, near being as long as word or one shorter."""
    length = F.char_length("word")

    def halves(of: Column) -> Column:
        """Hashes of the first and of the last half that words of a length are compared by."""
        half = F.floor(of / 2).cast("int")
        return F.array(
            F.xxhash64(F.lit(0), of, F.left("word", half)),
            F.xxhash64(F.lit(1), of, F.right("word", of - half)),
        )

    asked = words.select("word", F.explode(halves(length)).alias("half"))
    as_long = words.select(F.col("word").alias("near"), F.explode(halves(length)).alias("half"))
    shorter = words.select(
        F.col("word").alias("near"), F.explode(halves(length + 1)).alias("half")
    )
    return (
        asked.join(as_long.union(shorter), "half")
        .where(F.levenshtein("word", "near", 1) == 1)
        .select("word", "near")
    )


def near_words(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(word, near), both ways, for all pairs of distinct ``word`` values one edit apart."""
    short = F.char_length("word") <= longest
    # a word on the border may be near one beyond it
    found = _trie_pairs(words.where(short)).union(
        _long_pairs(words.where(F.char_length("word") >= longest))
    )
    # nodes are hashes; the check makes the pairs exact whatever they do
    right = found.where(F.levenshtein("word", "near", 1) == 1)
    return right.union(right.select("near", "word")).distinct()


@tidy
def spelling_variants(
    counts: DataFrame, ratio: int = RATIO, longest: int = LONGEST
) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``counts`` (word, n).

    form is the most frequent near word (ties: the smallest in code point order) if it is
    ``ratio`` times as frequent as the word, else null.  root follows forms to the last
    one.  ``counts`` holds each word once; an empty table gives an empty one.
    """
    words = stage(counts.select("word", "n"), "words")
    near = near_words(words.select("word"), longest)
    ranked = near.join(words.withColumnsRenamed({"word": "near", "n": "near_n"}), "near")
    best = ranked.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
    )
    form_n = -F.col("best.less")
    taken = form_n >= ratio * F.col("n")
    forms = stage(
        words.join(best, "word", "left").select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, form_n).alias("form_n"),
        ),
        "forms",
    )
    # counts grow by the ratio from form to form, which bounds the hops; each round doubles them
    most = words.agg(F.max("n")).first()[0] or 1
    hops = math.ceil(math.log(max(most, 2), ratio))
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(hops - 1, 0).bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stage(
            roots.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root")
            ),
            "roots",
        )
    return forms.join(roots, "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )
