"""Byte-level repeats, spelling variants and conversation repair, against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from panelworks.llm import deepshallow, grammar, passages, repair, variants
from panelworks.llm.queries import QUERIES
from tests.llm.common import empty, frame, prose

# --- deep-shallow sorting and repeated bytes -------------------------------------------------


def test_deep_shallow_order():
    rng = random.Random(1)
    for _ in range(600):
        pool = [bytes(rng.choices(b"ab", k=rng.randrange(40))) for _ in range(4)]
        strings = [
            rng.choice(pool)[: rng.randrange(41)] + bytes(rng.choices(b"ab\0", k=rng.randrange(3)))
            for _ in range(rng.randrange(30))
        ]
        order = deepshallow.deep_shallow(strings, rng.choice([0, 8, 16, 200]))
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)
        for a, b in zip(strings, strings[1:], strict=False):
            assert deepshallow.common_prefix(a, b) == len(os.path.commonprefix([a, b]))


def plain_ranges(texts, length):
    """Maximal runs of bytes in strings that start in two places."""
    raw = [(t or "").encode() for t in texts]
    held = Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    return [
        passages.merged(
            [(k, k + length) for k in range(len(t) - length + 1) if held[t[k : k + length]] > 1]
        )
        for t in raw
    ]


def check_bytes(spark, texts, length, **options):
    docs = frame(spark, texts)
    got = passages.remove_repeated_bytes(docs, length, **options).collect()
    assert got[0]["row"].asDict().keys() == set(docs.columns) if got else not texts
    want = plain_ranges(texts, length)
    assert len(got) == len(texts)
    for r in got:
        i = r["row"]["doc_id"]
        raw = (texts[i] or "").encode()
        assert [(s["start"], s["end"]) for s in r["spans"]] == want[i], i
        gone = {k for a, b in want[i] for k in range(a, b)}
        assert bytes(r["kept"]) == bytes(c for k, c in enumerate(raw) if k not in gone)
        assert (r["n_bytes"], r["n_removed"]) == (len(raw), len(gone))


def repeat_texts(seed):
    """Texts that share stretches with different surroundings, copies and runs."""
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abé", k=rng.randrange(20, 90))) for _ in range(4)]
    texts = [None, "", "x", "a" * 150, "ab" * 60, "a" * 29, "a" * 30, "é" * 40]
    for _ in range(40):
        text = "".join(
            rng.choice(shared)[rng.randrange(9) : rng.randrange(20, 91)]
            if rng.random() < 0.5
            else "".join(rng.choices("abcdé ", k=rng.randrange(1, 40)))
            for _ in range(rng.randrange(1, 6))
        )
        texts.append(text)
    return [*texts, texts[9], texts[10], texts[10]]


@pytest.mark.parametrize("seed,hot", [(1, 50), (3, 1)])
def test_repeated_bytes(spark, seed, hot):
    check_bytes(spark, repeat_texts(seed), 30, gram=10, hot=hot)


def test_pieces_of_long_texts(spark, monkeypatch):
    held = list(passages._pieces([b"x" * 25, None, b"", b"y" * 4, b"z" * 9], 5, 10))
    starts = Counter((row, base + k) for part in held for row, base, piece in part
                     for k in range(len(piece) - 4))
    assert starts == {(0, k): 1 for k in range(21)} | {(4, k): 1 for k in range(5)}


def test_repeated_bytes_of_prose(spark):
    text = prose(300, 1)
    texts = [text, f"new {text[40:900]} end", prose(200, 2), text[:199], text[:200], text]
    check_bytes(spark, texts, passages.LENGTH)


def test_repeated_bytes_of_no_rows(spark):
    assert passages.remove_repeated_bytes(empty(spark)).count() == 0
    rows = [(None, "z" * 250), (None, "z" * 250), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = passages.remove_repeated_bytes(docs).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 250, 250]


# --- spelling variants -----------------------------------------------------------------------


def plain_variants(words, ratio=5):
    near, keys = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            keys[len(w), i, shorter].add(w)
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in keys.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


@pytest.mark.parametrize("longest", [7])
def test_spelling_variants(spark, longest):
    rng = random.Random(longest)
    words = {"".join(rng.choices("abé", k=rng.randrange(1, 10))) for _ in range(400)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaaa"}
    counted = {w: 5 ** rng.randrange(6) + rng.randrange(3) for w in sorted(words)}
    counts = spark.createDataFrame([(w, n, "own") for w, n in counted.items()],
                                   "word string, n bigint, form string")
    got = {tuple(r) for r in variants.spelling_variants(counts, longest=longest).collect()}
    assert got == plain_variants(counted)
    assert variants.spelling_variants(counts.where("n < 0")).count() == 0


def test_very_long_words_are_compared(spark):
    long = "".join(random.Random(5).choices("abcdefgh", k=5000))
    words = {long: 100, long[:2000] + long[2001:]: 5, long[:4000] + "z" + long[4001:]: 6}
    words |= {"q" * 12: 50, "q" * 13: 5, "other" * 20: 9}
    counts = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {tuple(r) for r in variants.spelling_variants(counts, longest=12).collect()}
    assert got == plain_variants(words)


def test_words_are_counted(spark):
    texts = [None, "", "Straße ÉLAN élanes ÉLANES Élanes", "foobar FooBar foo_bar x", "élanes" * 3]
    got = variants.count_words(frame(spark, texts), least_length=5, least_count=1).collect()
    want = Counter()
    for t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            want[w] += len(w) >= 5
    assert {r["word"]: r["n"] for r in got} == {w: n for w, n in want.items() if n}
    assert variants.count_words(empty(spark)).count() == 0

    def first_gone(_, word):
        return F.substr(word, F.lit(2))

    cut = variants.count_words(frame(spark, texts), first_gone, least_length=6, least_count=1)
    assert {r["word"] for r in cut.collect()} == {w[1:] for w in want if len(w) > 6}


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_variant_query(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randrange(5, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=400))) for i in range(60)] + [(None, None)]
    folder = write(spark, tmp_path, "documents", rows, "doc_id bigint, text string")
    words = Counter()
    for i, text in rows[:-1]:
        for w in text.split():
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            words[w] += len(w) >= 6
    want = plain_variants({w: n for w, n in words.items() if n >= 5})
    got = QUERIES["op12_spelling_variants"](spark, folder).collect()
    assert {tuple(r) for r in got} == want
    assert any(r["form"] for r in got)


# --- conversation repair ---------------------------------------------------------------------


def test_automaton_accepts_the_grammar():
    table = grammar.Automaton()
    whole = re.compile("(s?(ua)+)?")
    todo = [("", 0)]
    while todo:
        text, stack = todo.pop()
        assert table.accepting[stack] == bool(whole.fullmatch(text)), text
        for symbol in "sua":
            onward = table.moves[stack].get(symbol)
            assert (onward is not None) == bool(re.fullmatch("s?(ua)*u?", text + symbol))
            if onward is not None and len(text) < 8:
                todo.append((text + symbol, onward))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = None
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif body[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def plain_repair(rows):
    """Best (cost, audit, lines) over all edits, by the text of initials written so far."""
    given = (("u", "user"), ("a", "assistant"))
    ways = {"": (0, "", ())}

    def put(out, text, way):
        if re.fullmatch("s?(ua)*u?", text) and (text not in out or way[:2] < out[text][:2]):
            out[text] = way

    def inserted(ways):
        out, layer = dict(ways), ways
        for _ in range(3):
            onward = {}
            for text, (cost, audit, lines) in layer.items():
                for x, role in given:
                    put(onward, text + x, (cost + 3, audit + "I", (*lines, role + ":")))
            for text, way in onward.items():
                put(out, text, way)
            layer = onward
        return out

    for (_, role, text), fault in zip(rows, faults_of(rows), strict=True):
        onward = {}
        for done, (cost, audit, lines) in inserted(ways).items():
            put(onward, done, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 * (fault == "truncated")
            put(onward, done + (role[:1] or "?"), (cost, audit + "K", (*lines, f"{role}:{text}")))
            for x, name in given:
                put(onward, done + x, (cost + 3, audit + "R", (*lines, f"{name}:{text}")))
        ways = onward
    return min(w for t, w in inserted(ways).items() if re.fullmatch("(s?(ua)+)?", t))


def plain_conversation(rows):
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    faults = faults_of(rows)
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, lines = plain_repair(rows)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest)


def turn_rows(seed, conversations=30, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in [None, *range(rng.randrange(longest))]:
            if rng.random() < 0.85:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
                text = rng.choice(["Yes.", "No!", "open", "", " \n", None, "a b?\t", f"t{turn}."])
                rows.append((conv, turn, role, text))
    return rows


def grouped(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("chunk", [3])
def test_repair(spark, chunk):
    turns = spark.createDataFrame(turn_rows(chunk), SCHEMA).selectExpr("*", "'own' as pos", "1 as fault")
    rows, conversations = repair.repair(turns, chunk=chunk)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(rows).collect()}
    got = {
        r["conv_id"]: (*(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal")),
                       r["cost"], r["audit"], digests[r["conv_id"]])
        for r in conversations.collect()
    }
    assert got == {c: plain_conversation(own) for c, own in grouped(turn_rows(chunk)).items()}
    letters = defaultdict(list)
    for r in rows.collect():
        letters[r["conv_id"]].append((r["pos"], r["part"], r["edit"]))
    assert {c: "".join(e for *_, e in sorted(x)) for c, x in letters.items()} == {
        c: x[-2] for c, x in got.items()
    }


def test_repair_of_no_rows(spark):
    turns = spark.createDataFrame([], SCHEMA)
    rows, conversations = repair.repair(turns)
    assert rows.count() == 0 and conversations.count() == 0 and repair.digests(rows).count() == 0


def test_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{rng.randrange(40)}.") for t in range(700)]
    turns = spark.createDataFrame(rows, SCHEMA)
    _, conversations = repair.repair(turns, chunk=64)
    (got,) = conversations.collect()
    assert (got["cost"], got["audit"]) == plain_repair([r[1:] for r in rows])[:2]


def test_repair_query(spark, tmp_path):
    rows = [r for r in turn_rows(11, 80) if r[0] is not None and r[1] is not None]
    folder = write(spark, tmp_path, "conversations", rows, SCHEMA)
    damaged = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        damaged += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    held = grouped(damaged)
    want = {(c, *plain_conversation(held.get(c, []))) for c in {r[0] for r in rows}}
    got = QUERIES["op13_structure_repair"](spark, folder).collect()
    assert {tuple(r) for r in got} == want
