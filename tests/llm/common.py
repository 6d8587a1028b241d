"""Small frames and plain versions that the tests of the operators share."""

from __future__ import annotations

import random
import re
from collections import defaultdict

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = (
    "kept keep_id group_size row rest prefix head n sig rep label node lines host units of "
    "spans clean_text component_id piece bucket_length n_words shard slot score"
).split()


def frame(spark, texts, lang="en", source="s"):
    """Documents with ids 0, 1, 2, ... and columns whose names operators use inside."""
    rows = [
        (i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING:
        df = df.selectExpr("*", f"'own' as `{name}`")
    return df


def empty(spark):
    return frame(spark, ["x"]).where("doc_id < 0")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def shingles(text, width=5):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(ids, links):
    """Smallest id reachable from each id."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    label = {}
    for start in sorted(ids):
        stack = [start]
        while stack:
            node = stack.pop()
            if node not in label:
                label[node] = start
                stack += near[node]
    return label


def near_components(texts):
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return components(sets, links), {i: len(s) for i, s in sets.items()}
