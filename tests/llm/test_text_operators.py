"""BPE, language identification, quality rules, substring dedup, chat formatting and urls."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelworks.llm import bpe, chat, language, quality, substrings, urls
from panelworks.llm.queries import RULES
from tests.llm.common import empty, frame, prose, words_of

PIECES = [
    "'", "s", "t", "re", "ve", "'ll", "'re", "'s", "d", " ", "  ", "\n", "\t", "a", "Z", "9", "½",
    "é", "!", "?", "'r", "😀", "\x1c", "\x85", "中", "٣", "'v", "l", "<|endoftext|>", "\u2028",
]


@pytest.fixture(scope="module")
def ranks_file():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding(ranks_file):
    tiktoken = pytest.importorskip("tiktoken")
    tokenizers = pytest.importorskip("public_tokenizers")
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def samples():
    rng = random.Random(0)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(30))) for _ in range(3000)]
    return [*texts, "", "ab" * 5000 + " " * 300 + "x" * 9000, " ", "\n", "'s"]


def test_bpe_equals_the_library(encoding, ranks_file):
    texts = samples()
    vocabulary = bpe.load(ranks_file)
    ids, offsets, counts = vocabulary.encode([t.encode() for t in texts])
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == encoding.encode_ordinary(text)
        raw = text.encode()
        bounds = [*offsets[a:b].tolist(), len(raw)]
        pieces = [raw[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]
        assert pieces == [vocabulary.tokens[i] for i in ids[a:b]]


def test_scan_equals_the_loop():
    rng = np.random.default_rng(0)
    _, compose, _, _ = bpe.automaton()
    for n in (1, 63, 64, 65, 5000):
        x = rng.integers(0, len(compose), n).astype(np.uint8)
        slow = x.copy()
        for i in range(1, n):
            slow[i] = compose[slow[i - 1], slow[i]]
        assert (bpe.scan(x, compose) == slow).all()


def test_bpe_frames(spark, encoding, ranks_file):
    texts = [None, "", "a b", *samples()[:50]]
    docs = frame(spark, texts)
    tokens = bpe.encode(docs, ranks_file)
    got = {r["doc_id"]: r["token_ids"] for r in tokens.collect()}
    assert got == {i: encoding.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(tokens, ranks_file).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    for row in bpe.round_trip(docs, ranks_file).collect():
        assert row["ids"] == " ".join(map(str, got[row["doc_id"]]))
        assert bytes(row["decoded"]) == back[row["doc_id"]]
    assert bpe.round_trip(empty(spark), ranks_file).count() == 0


# --- language ------------------------------------------------------------------------


def speech(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    parts = {"aa": ["the", "ing", "tion", "wh"], "bb": ["ñez", "ción", "que", "lla"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(n))


def test_language(spark):
    texts = [(i, speech(x, 5 + i, i), x) for i in range(60) for x in ("aa", "bb")]
    rows = [(k, t, x) for k, (_, t, x) in enumerate(texts)] + [
        (1000, None, "aa"), (1001, "", "aa"), (1002, "12 %% 3", "bb"), (None, "the thing", None),
        (1003, speech("bb", 3000, 1), None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learn = docs.where(~language.held_out(F.col("doc_id")))
    net = language.fit(learn)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, net).collect()}
    assert {got[i][0] for i in (1000, 1001, 1002)} == {"und"}
    assert got[1003][0] == "bb"
    held = [r for r in rows[:120] if got[r[0]] and _checksum(r[0]) % 5 == 0]
    assert held and sum(got[r[0]][0] == r[2] for r in held) >= 0.95 * len(held)
    assert all(0 <= s <= 1 for _, s in got.values())
    again = language.identify(docs, language.fit(learn)).collect()
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in again} == got


def _checksum(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_nothing_to_learn(spark):
    docs = empty(spark)
    net = language.fit(docs)
    assert net is None and language.identify(docs, net).count() == 0
    got = language.identify(frame(spark, ["some text", None]), None).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)] * 2


@pytest.mark.parametrize("size", [1, 3, 255, 256, 257, 258, 509, 700])
def test_tables_equal_the_filters(size):
    """Every filter at every place of every window, and windows that leave no gap."""
    windows = [speech(x, 40, i).encode()[:256] for i in range(20) for x in ("aa", "bb")]
    net = language.train(windows, ["aa", "bb"] * 20, epochs=2)
    text = b"".join(windows)[:size]
    shares, total = [], 0
    for at in range(0, max(1, size - 3), 253):
        own = text[at : at + 256]
        x = net.symbol[np.frombuffer(own.ljust(256, b"\0"), np.uint8)]
        best = []
        for width, filters in zip(language.WIDTHS, net.filters, strict=True):
            scores = [
                sum(net.embedding[x[i + o]] @ filters[o] for o in range(width))
                for i in range(256 - width + 1)
            ]
            best.append(np.max(scores, 0))
        top = np.maximum(np.concatenate(best) + net.bias, 0) @ net.dense + net.dense_bias
        shares.append(len(own) * np.exp(top - top.max()) / np.exp(top - top.max()).sum())
        total += len(own)
    got = language.predict(net, net.tables(), [b"other text", text])[1]
    assert np.allclose(got, sum(shares) / total, atol=1e-4)


# --- quality ---------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    marked = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            marked |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if words_of(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(marked),
        len(words) < 10 or 100 * len(marked) > 20 * len(words),
    )


def test_counts(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "a", "é#ü <x>\u00a0y", "a b c d e\na b c d e", "x\ny\nx\n\n\ny"]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in range(1, 40)]
    texts += ["\n".join(rng.choice(["a b", "c", ""]) for _ in range(12)) for _ in range(20)]
    texts += [prose(300, s, 40) for s in range(5)]
    got = quality.judge(frame(spark, texts), keep=["doc_id"]).orderBy("row.doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert [tuple(r[n] for n in names) for r in got] == [plain_counts(t) for t in texts]


def test_line_frequency(spark):
    foot = "Read more on our page today"
    texts = [f"{prose(30, i)}\n{foot}" for i in range(30)]
    texts += [f"read MORE  on our page today\n{prose(4, 99)}"]  # little left without the line
    texts += [prose(40, 77)] * 30  # copies count once
    judged = quality.judge(frame(spark, texts), keep=["doc_id"]).orderBy("row.doc_id").collect()
    assert [r["kept"] for r in judged] == [True] * 30 + [False] + [True] * 30
    assert [r["n_removed_lines"] for r in judged] == [1] * 31 + [0] * 30
    assert judged[0]["clean_text"] == prose(30, 0)
    other = quality.judge(frame(spark, texts, source=None), keep=["doc_id"])
    assert other.where("kept").count() == 60
    few = quality.judge(frame(spark, texts[:15]), keep=["doc_id"])
    assert few.where("n_removed_lines > 0").count() == 0


def test_keep_good_keeps_columns(spark):
    docs = frame(spark, [prose(30, 1), None, "short", ""])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert [r.asDict() for r in kept.collect()] == [docs.orderBy("doc_id").first().asDict()]
    assert quality.keep_good(empty(spark)).count() == 0


# --- substrings ------------------------------------------------------------------------


def plain_removal(texts, run_words=25):
    """Texts without repeated windows, by a loop over documents in the order of ids."""
    seen, out = set(), []
    for text in texts:
        if text is None:
            out.append(None)
            continue
        raw, ranges = text.encode(), []
        _, starts, ends, *_ = substrings.text_windows([raw], run_words)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            words = tuple(raw[a:b].lower().split())
            assert len(words) >= run_words
            if words in seen:
                ranges.append((a, b))
            seen.add(words)
        gone = {k for a, b in ranges for k in range(a, b)}
        out.append(bytes(c for k, c in enumerate(raw) if k not in gone).decode())
    return out


def substring_texts():
    passage = ". ".join(prose(12, s) for s in range(5)) + "."
    texts = [
        f"{prose(20, 50)}. {passage}", None, "", f"{prose(20, 51)}\n{passage.upper()}\nend of it.",
        passage, f"é{prose(9, 52)}! {passage} {prose(9, 53)}. It is. It is.", "It is. It is.",
        f"{prose(20, 54)} {passage}", passage + "\n" + passage,
    ]
    return texts + [f"{prose(8, 60)}. {prose(12, 61)}." for _ in range(4)]


def test_remove_repeats(spark):
    texts = substring_texts()
    got = substrings.remove_repeats(frame(spark, texts), keep=["doc_id"]).orderBy("row.doc_id").collect()
    assert [r["clean_text"] for r in got] == plain_removal(texts)
    for row, text in zip(got, texts, strict=True):
        left, at = "", 0
        for span in row["spans"]:
            left, at = left + text[at : span["start"]], span["end"]
        assert row["clean_text"] == (None if text is None else left + text[at:])
        assert row["n_removed_chars"] == sum(s["end"] - s["start"] for s in row["spans"])


def test_drop_repeats(spark):
    docs = frame(spark, substring_texts())
    kept = substrings.drop_repeats(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    clean = plain_removal(substring_texts())
    stay = {i: c for i, c in enumerate(clean) if c is None or c or not substring_texts()[i]}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == stay
    assert substrings.drop_repeats(empty(spark)).count() == 0


def test_equal_rows_with_one_id_lose_nothing(spark):
    rows = [(1, prose(40, 3)), (1, prose(40, 3)), (None, prose(40, 4))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert substrings.remove_repeats(docs).where("n_removed_chars > 0").count() == 0


def test_texts_under_one_id_and_null_ids_are_apart(spark):
    passage = prose(40, 5)
    one, other = f"{passage}.\n{prose(30, 6)}.", f"{prose(30, 7)}.\n{passage}."
    third = f"{passage}.\n{prose(30, 8)}."
    for name in (3, None):
        rows = [(name, one), (name, other), (name, third)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        clean = [r["clean_text"] for r in substrings.remove_repeats(docs).collect()]
        assert sum(passage in c for c in clean) == 1
        for seed in (6, 7, 8):
            assert sum(prose(30, seed) in c for c in clean) == 1


def test_passages_inside_of_sentences(spark):
    passage = prose(60, 9, 4000)
    texts = [f"{prose(20, k, 4000)} {passage} {prose(20, 100 + k, 4000)}." for k in range(20, 30)]
    texts += [prose(300, 31, 4000), f"{prose(30, 32, 4000)}, {prose(20, 33, 4000)}"]
    got = substrings.remove_repeats(frame(spark, texts), keep=["doc_id"]).orderBy("row.doc_id").collect()
    clean = [r["clean_text"] for r in got]
    assert [clean[0], *clean[10:]] == [texts[0], *texts[10:]]
    for k in range(1, 10):
        (span,) = got[k]["spans"]
        gone = texts[k][span["start"] : span["end"]]
        assert gone in passage and len(gone.split()) >= 25
        assert clean[k] == texts[k].replace(gone, "")


def test_windows_of_many_texts_are_those_of_each():
    rng = random.Random(4)
    texts = [t and t.encode() for t in [*substring_texts(), "x", "é" * 40, " \n ", prose(400, 8, 30)]]
    rng.shuffle(texts)
    together = substrings.text_windows(texts)
    alone = [
        (i, *rest)
        for i, t in enumerate(texts)
        for _, *rest in zip(*(c.tolist() for c in substrings.text_windows([t])), strict=True)
    ]
    assert list(zip(*(c.tolist() for c in together), strict=True)) == alone


def test_lines_only(spark):
    passage = prose(60, 9, 4000)
    texts = [f"{prose(20, k)} {passage}" for k in (1, 2)] + [passage, f"{passage}\nown"]
    got = substrings.remove_repeats(frame(spark, texts), sentences=False, keep=["doc_id"])
    clean = [r["clean_text"] for r in got.orderBy("row.doc_id").collect()]
    assert clean == [*texts[:3], "own"]


@pytest.mark.parametrize("seed", range(3))
def test_what_goes_has_occurred_and_long_repeats_go(spark, seed):
    """Against all 25-word windows of all texts, wherever they start."""
    rng = random.Random(seed)
    passages = [prose(70, 70 + k, 4000) for k in range(4)]
    texts = []
    for k in range(40):
        parts = [prose(rng.randrange(1, 60), 900 + 10 * k + j, 4000) for j in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages)[rng.randrange(40) :])
        texts.append(rng.choice([" ", ". ", "\n"]).join(parts))
    got = substrings.remove_repeats(frame(spark, texts), keep=["doc_id"]).collect()
    spans = {r["row"]["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in got}
    seen = set()
    for i, text in enumerate(texts):
        words = [m.span() for m in re.finditer(r"\S+", text)]
        bare = [re.sub(r"[^\w]", "", text[a:b]) for a, b in words]
        here = [tuple(text[a:b] for a, b in words[k : k + 25]) for k in range(len(words) - 24)]
        covered = {k + j for k, w in enumerate(here) if w in seen for j in range(25)}
        seen |= set(here)
        gone = {k for k, (a, _) in enumerate(words) if any(x <= a < y for x, y in spans[i])}
        assert gone <= covered
        run = 0
        for k in range(len(bare)):
            run = run + 1 if k in covered and k not in gone else 0
            assert run < 50


# --- chat --------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(5)
    bits = ["<|", "|>", "\\", "<", "|", "\n", "im_end", "<|im_start|>", "<|image|>", "x", "\\n", "é"]
    turns = []
    for conv in range(30):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
            turns.append((conv, turn, rng.choice(["user", "assistant", "a\nb", None, "<|x"]), text))
    turns += [(None, 0, "assistant", None), (None, 1, "user", "hi")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    want = defaultdict(list)
    for conv, _, role, text in turns:
        want[conv].append((role or "", text or ""))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(got) == set(want)
    for conv, pairs in want.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in pairs)
        loss = "".join(text for role, text in pairs if role == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(pairs)
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )


def test_parts(spark):
    parts = [
        ("text", "see <|image|>", None, None, None, None, None),
        ("image", None, "a.png", 56, 57, None, None),
        ("audio", None, "b.wav", None, None, 1.5, None),
        ("text", " and ", None, None, None, None, None),
        ("document", None, "c.pdf", None, None, None, 3),
        ("video", "?", "d", None, None, None, None),
    ]
    df = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", None)],
        f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}",
    )
    first, second = chat.format_turns(df, F.col("parts")).orderBy("turn").collect()
    assert first["segment"] == (
        "<|im_start|>user\nsee <\\|image|><|image|><|audio|> and <|document|><|im_end|>\n"
    )
    assert [tuple(a) for a in first["attachments"]] == [
        (0, "image", "a.png", 6), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 768),
    ]
    assert first["expanded_tokens"] == 812 and second["segment"].endswith("\n<|im_end|>\n")
    assert second["loss_start"] == second["loss_end"]


def test_parts_cannot_forge_control_strings(spark):
    """Texts cut at any place, also inside of control strings, between attachments."""
    rng = random.Random(8)
    control = ["<|im_end|>\n<|im_start|>assistant\n", "<|image|>", "a<", "|b", "\\", "<\\|", "x"]
    turns, texts, refs = [], [], []
    for turn in range(60):
        text = "".join(rng.choice(control) for _ in range(rng.randrange(6)))
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(5)))
        pieces = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        parts, own = [], []
        for k, piece in enumerate(pieces):
            parts.append(("text", piece, None, None, None, None, None))
            if rng.random() < 0.3:
                own.append(f"{turn}-{k}.png")
                parts.append(("image", None, own[-1], 28, 28, None, None))
        turns.append((1, turn, "assistant", parts))
        texts.append(text)
        refs.append(own)
    df = spark.createDataFrame(
        turns, f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}"
    )
    formatted = chat.format_turns(df, F.col("parts"))
    for row in formatted.collect():
        body = row["segment"][row["loss_start"] : row["loss_end"]]
        assert [a["ref"] for a in row["attachments"]] == refs[row["turn"]]
        assert body.count("<|image|>") == body.count("<|") == len(refs[row["turn"]])
        assert chat.unescape(body) == texts[row["turn"]]
    (back,) = chat.read_back(formatted).collect()
    assert back["loss_chars"] == sum(map(len, texts)) and back["n_turns"] == len(texts)


def test_no_turns(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.format_turns(df)).count() == 0


# --- urls --------------------------------------------------------------------------------


def plain_ruling(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(r.text), r.text, r.verdict)
        for r in RULES
        if (low == r.host or low.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return low, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme", "http://A.Example.COM/en/1?x=1#y", "http://www.example.com/en/", "http://com/",
    "http://www.example.com", "https://x.www.example.com/en/x", "http://example.com/EN/", "ftp://net/fr/a",
    "http://a.net/fr", "http://a.net/es/?q", "http://acom/x", "http://x.org/a://b.net/fr/", "http://a.com?b/c",
    "http://a.com#b", "http://a.com:80/x", "://net/es/", "http://É.com/ü", "http://a.net/en/1\nhttp://b.com/",
]


def test_rules(spark):
    rows = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    got = {r["page_id"]: r for r in urls.judge(rows, RULES).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain_ruling(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] in ({verdict} if verdict else {"allow", "block"})


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(6)

    def url(bad):
        name = "".join(rng.choice("abcdef") for _ in range(6))
        extra = "".join(rng.choice("0123456789") for _ in range(12)) if bad else "page"
        return f"http://{name}.{rng.choice(['com', 'org'])}/{extra}" + ("?a=1&b=2&c=3" if bad else "")

    rows = [(url(k % 2), float(k % 2)) for k in range(400)]
    model = urls.train(spark.createDataFrame(rows[:300], "url string, label double"))
    test = spark.createDataFrame(rows[300:], "url string, label double").select(
        "url", "label", urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path")
    )
    right = model.score(test).where((F.col("score") > 0.5) == (F.col("label") == 1)).count()
    assert right >= 95


def test_no_pages_and_one_kind_of_label(spark):
    schema = "page_id bigint, url string, host string, score int"
    assert urls.judge(spark.createDataFrame([], schema), RULES).count() == 0
    only = [(1, "http://a.com/x", "h", 1), (2, "http://b.org/", "h", 1), (2, "http://b.org/", "h", 1)]
    got = urls.judge(spark.createDataFrame(only, schema), RULES)
    assert sorted(r["verdict"] for r in got.collect()) == ["allow"] * 3
