"""Operators on single texts, against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from prairie.llm import binary, chat, decontaminate, hmm, packing, quality, secrets, tokens, toxicity
from prairie.session import fresh_path
from tests.llm import cases

BLANK = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(BLANK, text or "") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def pairs(df, *columns):
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))


# Secrets ---------------------------------------------------------------------------

def plain_spans(text):
    found = []
    for kind, rule in enumerate(secrets.RULES):
        for m in rule.compiled().finditer(text or ""):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_secrets_are_those_of_a_plain_scan(spark):
    docs = cases.documents(spark)
    got = sorted(repr((r.doc_id, [(s.start, s.kind, s.end) for s in r.spans])) for r in secrets.scan(docs).collect())
    assert got == sorted(repr((r[0], plain_spans(r[1]))) for r in cases.rows())
    assert secrets.scan(cases.nothing(spark)).count() == 0


def test_short_hex_runs_do_not_matter():
    loose = re.compile("[0-9a-f]+")
    text = "ab" * 20 + "g" + "0" * 31 + "x" + "f" * 32
    strict = [m.span() for m in secrets.RULES[2].compiled().finditer(text)]
    assert strict == [m.span() for m in loose.finditer(text) if len(m.group()) >= 32]


@pytest.mark.parametrize(
    "pattern, text",
    [("abc(def|xyz)?g", "abcxyzg"), ("(foo|ba)r[0-9]+tail", "bar12tail"), ("a?bcd", "bcd"), ("(xyz){2}", "xyzxyz"), ("k[ab]cd", "kbcd")],
)
def test_every_match_satisfies_its_query(pattern, text):
    rule = secrets.Rule("r", pattern)
    query = secrets.trigram_query(rule)
    assert re.search(pattern, text)
    segment = secrets.Segment([b"none", text.encode(), b""], sorted(secrets.trigrams(query)))
    assert segment.candidates(query)[1]


def test_queries_rule_texts_out():
    query = secrets.trigram_query(secrets.RULES[0])
    assert query != secrets.ANY and secrets.trigram_query(secrets.RULES[2]) == secrets.ANY
    grams = sorted(secrets.trigrams(query))
    assert secrets.Segment([b"nothing here", b"my token is", b"api_key"], grams).candidates(query).tolist() == [False, True, True]


# Chat ------------------------------------------------------------------------------

def test_layouts_become_the_same_turns(spark):
    records = [
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"id":7}',
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        '{"dialog":[{"speaker":"user","utterance":"q"},{"speaker":"bot","utterance":"a"}]}',
        '{"instruction":"q","output":"a"}',
        '{"prompt":"q","response":"a","extra":{"deep":[1]}}',
        '{"prompt":"q","completion":"a"}',
        '{"question":"q","answer":"a"}',
        '{"data":{"prompt":{"text":"q"},"response":{"text":"a"}}}',
    ]
    df = spark.createDataFrame(list(enumerate(records)), "id int, record string")
    for r in chat.canonical(df, "record").collect():
        assert [tuple(t) for t in r.turns] == [("user", "q"), ("assistant", "a")], r


def test_records_without_layout(spark):
    records = [None, "", "no json", "[1]", "3", '{"other":1}', '{"messages":[]}', '{"messages":"text"}']
    df = spark.createDataFrame(list(enumerate(records)), "id int, record string")
    rows = chat.canonical(df, "record").collect()
    assert len(rows) == len(records) and all(r.turns == [] and r.layout is None for r in rows)


def test_joined_and_optional_fields(spark):
    df = spark.createDataFrame([(1, '{"system":"s","instruction":"q","input":"i","output":null}')], "id int, record string")
    assert [tuple(t) for t in chat.canonical(df, "record").first().turns] == [("system", "s"), ("user", "q\n\ni"), ("assistant", "")]


@pytest.mark.parametrize("text", ["", "<s>", "</s></s>", "<\\s><\\\\/s>", "[INST]<s>[\\INST]", "a\nb</s", "<<s>>", "\\", "$1 \\1 <s>"])
def test_template_reads_back_what_it_wrote(spark, text):
    from pyspark.sql import functions as F

    t = chat.Template()
    turns = [("user", text), ("we ird\nrole", text), ("assistant", text)]
    df = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>")
    df = df.select(t.write(F.col("turns")).alias("f"), t.mask(F.col("turns")).alias("m"))
    r = df.select("f", t.read(F.col("f")).alias("back"), t.under(F.col("f"), F.col("m")).alias("loss")).first()
    assert [tuple(x) for x in r.back] == turns and r.loss == [text]
    assert r.f.count("<s>") == 3 and r.f.count("</s>") == 3 and "[INST]" not in r.f


def test_chat_query_holds_nulls_and_ties(spark, tmp_path):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "assistant", "</s>"), (2, 5, "assistant", "b"), (2, None, "user", "a")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op2_chat(spark, str(tmp_path)).collect()}
    digest = lambda turns: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == digest([("user", ""), ("", "x"), ("", "x")]) and got[1].n_turns == 3
    assert got[2].turns_sha256 == digest([("user", "a"), ("assistant", "b")]) and got[2].loss_chars == 1
    assert got[None].loss_sha256 == hashlib.sha256(b"</s>").hexdigest()
    assert got[-1].turns_sha256 == digest([("user", chat.PROBE), ("assistant", chat.PROBE)])
    assert len(got) == 4


# Quality ---------------------------------------------------------------------------

def plain_measures(text):
    text = text or ""
    own = words(text)
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w in windows if _many(windows)[w] > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(own), sum(map(len, own)), sum(text.count(c) for c in quality.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def _many(windows, known={}):
    from collections import Counter

    if id(windows) not in known:
        known.clear()
        known[id(windows)] = Counter(windows)
    return known[id(windows)]


def test_measurements(spark):
    got = pairs(quality.ledger(cases.documents(spark)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(repr((r[0], *plain_measures(r[1]))) for r in cases.rows())
    assert quality.ledger(cases.nothing(spark)).count() == 0


def test_policies_and_ablation(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,)], "failed long")
    got = {(r.policy, r.rule): (r.n_failed, r.n_only, r.n_kept, r.n_kept_without) for r in quality.ablation(rows, "base").collect()}
    assert got == {("base", "few_words"): (3, 2, 2, 4), ("base", "repeated_words"): (1, 0, 2, 2)}


def test_quality_stage_keeps_columns(spark):
    kept = quality.stage(spark, cases.documents(spark), "")
    assert kept.columns == cases.documents(spark).columns
    # few words: empty and short texts; repeated words: one word 30,000 times and a cycle
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 3, None, *range(20, 26)]))


# Contamination ---------------------------------------------------------------------

def plain_hits(texts, items, width=13):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        own = pattern.findall(lower(text))
        for i in range(max(1, len(own) - width + 1) if own else 0):
            windows.setdefault(tuple(own[i : i + width]), set()).add(str(item if item is not None else ""))
    out = []
    for key, text in texts:
        own = pattern.findall(lower(text))
        hit, ids = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if found := windows.get(tuple(own[i : i + n])):
                    hit |= set(range(i, i + n))
                    ids |= found
        out.append((key, len(own), len(hit), sorted(ids)))
    return out


def test_contamination(spark):
    items = [(1, " ".join(f"word{i}" for i in range(10, 40))), (2, "one"), (2, "seen in MANY documents"), (3, None), (4, "?!"), (None, "own-words"), (12, "ß   endoftext")]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(repr, plain_hits([r[:2] for r in cases.rows()], items)))
    for block in (2, 1000):
        assert pairs(decontaminate.scan(cases.documents(spark), table, block=block), "doc_id", "n_words", "n_hit", "items") == want
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.n_hit == 0 for r in decontaminate.scan(cases.documents(spark), none).collect())
    assert decontaminate.scan(cases.nothing(spark), table).count() == 0


def test_spans_lead_to_the_original(spark):
    docs = spark.createDataFrame([(1, "Äb!  The QUICK,\nbrown fox… ran")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "quick brown"), (2, "fox ran far")], "item_id long, text string")
    r = decontaminate.scan(docs, items).first()
    assert [docs.first().text[s.start : s.end] for s in r.spans] == ["QUICK,\nbrown"]


# Tokens, packing, files ------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokens.vocabulary())
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_as_the_whole(library):
    rng = np.random.default_rng(1)
    parts = ["a", "Wort", " ", "  ", "\n", "\n\n", "\t", "'s", "it's", ",", "...", "é", " ", " ", "\r\n", "12", "😀", "\x1c", "\x01", " x", "᠎", "_", "²"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 25))) for _ in range(3000)] + ["", " ", "\n"]
    encoder = tokens.Encoder(tokens.vocabulary(), 0)
    for text, raw in zip(texts, encoder.encode(texts)):
        assert tokens.numbers(raw, 2).tolist() == library(text) + [0], repr(text)


def test_batch_is_cut_on_its_bytes(library, monkeypatch):
    rng = np.random.default_rng(3)
    parts = [*"azAZ09.,-_\"(<$'\n\t\r\x0b\x1c\x1f\x7f\x85\xa0×÷ÀßɏɀʰαЖ日\u180e\u2003\u2028\u200b\u3000。“—😀²½", *[" "] * 12, *["\n"] * 4, *["'"] * 4, "'s", "don't", "<|endoftext|>", "<|endoftext"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(0, 30))) for _ in range(4000)]
    texts[::9] = [None] * len(texts[::9])
    encoder = tokens.Encoder(tokens.vocabulary(), 2)
    for size in (tokens.SLICE, 100):
        monkeypatch.setattr(tokens, "SLICE", size)
        column = pa.array(["before", *texts, "behind"]).slice(1, len(texts))
        for text, raw in zip(texts, encoder.encode_batch(column).to_pylist()):
            assert tokens.numbers(raw, 2).tolist() == library(text) + [2], repr(text)
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [encoder.end] * 2


def test_batch_asks_for_each_piece_once(library, monkeypatch):
    """Python sees the distinct pieces of a batch, and a word is the same with any mark or number beside it."""
    asked, encoded = [], []
    pieces, whole, word = tokens._Worker.pieces, tokens._Library.whole, tokens._Library.word
    monkeypatch.setattr(tokens._Worker, "pieces", lambda self, p: asked.append(len(p)) or pieces(self, p))
    monkeypatch.setattr(tokens._Library, "whole", lambda self, t: encoded.append(t) or whole(self, t))
    monkeypatch.setattr(tokens._Library, "word", lambda self, t: encoded.append(t) or word(self, t))
    monkeypatch.setattr(tokens, "_HELD", {})
    rng = np.random.default_rng(4)
    words = [w + m for w in ("eins", "zwei", "drei", "größer") for m in ("", ",", "-", ")", "/7", "?!", '"')]
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 300)) for _ in range(200)]
    got = tokens.Encoder(tokens.vocabulary(), 0).encode(texts)
    assert [tokens.numbers(raw, 2).tolist() for raw in got] == [library(t) + [0] for t in texts]
    assert len(asked) == 1 and len(encoded) <= asked[0] <= 20  # 4 words with a blank and without, 6 marks, a number, the end


def test_ids_of_a_column_are_counted_together(spark):
    rows = spark.createDataFrame([(2, np.array(i, "<u2").tobytes()) for i in ([5, 3, 5], [], [3, 9, 5], [1])], "width int, ids binary")
    assert binary.frequencies(rows.coalesce(1)).tolist() == [5, 3, 1, 9]
    column = pa.array([b"\1\0", b"\2\0\3\0", b"", b"\4\0"])
    assert tokens.all_numbers(column.slice(1, 2), 2).tolist() == [2, 3] and not len(tokens.all_numbers(column.slice(0, 0), 2))


def test_packing_is_gapless_and_whole(spark, library):
    pieces = packing.pack(cases.documents(spark), length=64).collect()
    docs = {}
    for p in pieces:
        docs.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    want = sorted(tuple(library(r[1]) + [0]) for r in cases.rows())
    streams = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        stream = streams.setdefault(p.sequence_id, [])
        assert p.offset == len(stream) and len(p.ids) == 4 * p.length and p.length > 0
        stream += np.frombuffer(p.ids, "<u4").tolist()
    sizes = [len(streams[k]) for k in sorted(streams)]
    assert set(sizes[:-1]) <= {64} and sizes[-1] <= 64 and sorted(streams) == list(range(len(sizes)))
    flat = [i for k in sorted(streams) for i in streams[k]]
    got, own = [], []
    for i in flat:
        own.append(i)
        if i == 0:
            got.append(tuple(own))
            own = []
    assert sorted(got) == want and not own
    assert packing.pack(cases.nothing(spark)).count() == 0


def test_hilbert_neighbours_touch():
    side = np.arange(16)
    points = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    key = packing.hilbert(points, 4)
    assert sorted(key) == list(range(16**3))
    steps = np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_sequences(spark):
    pieces = packing.pack(cases.documents(spark), length=64)
    total = sum(p.length for p in pieces.collect())
    assert sum(len(r.ids) for r in packing.sequences(pieces).collect()) == 4 * total


def test_code_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 1 << rng.integers(1, 33, n), dtype=np.uint64).astype(np.uint32) if n else np.zeros(0, np.uint32)
        control, data = binary.encode(values)
        assert len(control) == -(-n // 4) and (binary.decode(control, data, n) == values).all()


def test_files_hold_all_ids_in_order(spark, library):
    path = fresh_path(spark, "files")
    binary.write(cases.documents(spark), path)
    got = sorted(binary.read(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    key = lambda d: (d is not None, d or 0)
    assert [key(r.doc_id) for r in got] == sorted(key(r[0]) for r in cases.rows())
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.start == at and len(ids) == r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32 and ids[-1] == 2
        at += r.n_tokens
    assert sorted(tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted(tuple(library(r[1]) + [2]) for r in cases.rows())
    empty = fresh_path(spark, "files")
    binary.write(cases.nothing(spark), empty)
    assert binary.read(spark, empty).count() == 0


# Language model --------------------------------------------------------------------

def test_scaled_recursion_is_the_sum_over_all_paths():
    from itertools import product

    model = hmm.first_model(np.full(5, 0.2), 2)
    seq = np.array([0, 3, 1, 4])
    total = 0.0
    for path in product(range(2), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
        total += p
    got = hmm.log_likelihoods(model, np.concatenate([seq, seq[:1]]), np.array([0, 4]), np.array([4, 1]))
    assert np.isclose(got[0], np.log(total)) and np.isclose(got[1], np.log((model.start * model.emit[0]).sum()))


def test_expected_counts_add_up_and_help():
    rng = np.random.default_rng(4)
    flat = np.concatenate([rng.integers(0, 3, 300), rng.integers(3, 6, 300)])
    starts, lengths = np.arange(0, 600, 30), np.full(20, 30)
    model = hmm.first_model(np.full(6, 1 / 6), 2)
    before = hmm.log_likelihoods(model, flat, starts, lengths).sum()
    for _ in range(5):
        first, move, emit = hmm.expected(model, flat, starts, lengths)
        assert np.isclose(first.sum(), 20) and np.isclose(move.sum(), 20 * 29) and np.isclose(emit.sum(), 600)
        model = hmm.Model(first / first.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        after = hmm.log_likelihoods(model, flat, starts, lengths).sum()
        assert after >= before - 1e-9
        before = after


def test_base_scores(spark):
    from collections import Counter
    from math import isclose, log10

    got = hmm.score(cases.documents(spark), rounds=1).collect()
    own = [(r[0], [*words(lower(r[1])), None]) for r in cases.rows()]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter(w for d, ws in own if not held(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((d or -1, len(ws), sum(counts[w] > 0 for w in ws), sum(log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for d, ws in own)
    have = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.base_score) for r in got)
    for a, b in zip(have, want, strict=True):
        assert a[:3] == b[:3] and isclose(a[3], b[3], rel_tol=1e-9), (a, b)
    assert all(r.train_tokens == n and r.held_out == held(r.doc_id) and r.score < 0 for r in got)
    assert hmm.score(cases.nothing(spark)).count() == 0


def test_states_beat_the_base_on_held_out_text(spark, sf_dir):
    rows = [r for r in hmm.op3_markov(spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


# Toxicity --------------------------------------------------------------------------

def test_classifier_finds_the_marked_words(spark):
    rng = np.random.default_rng(6)
    filler = [f"f{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = " ".join(rng.choice(filler, 40))
        toxic = i % 3 == 0
        if toxic:
            text = text.replace(" ", f" {rng.choice(['badword', 'vileing', 'vilely'])} ", 1)
        rows.append((i, text, "en" if i % 2 else None))
        labels.append((i, int(toxic)))
    rows += [(1000, None, None), (1001, "", "xx"), (1001, "Badword", None), (None, "f1 f2", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels + [(3, None), (None, 1), (5000, 1)], "doc_id long, toxic int")
    got = toxicity.classify(docs, known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    checked = [r for r in got if r.held_out and r.doc_id < 600]
    assert len(checked) > 80 and sum((r.doc_id % 3 == 0) == bool(r.predicted) for r in checked) >= 0.98 * len(checked)


def test_classifier_without_labels(spark):
    docs = cases.documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.0}
    assert toxicity.classify(cases.nothing(spark), none).count() == 0


def test_a_text_scores_the_same_alone_and_in_any_batch():
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["bad", "worse", "good", "fine", "plain"], n)) for n in rng.integers(0, 9, 60)]
    model = toxicity.fit(texts, [int("bad worse" in t) for t in texts])
    tables, hasher = model.tables(), toxicity.Hasher(model.rows)
    alone = np.concatenate([toxicity.score([t], model, hasher, tables) for t in texts])
    for order in (np.arange(60), np.arange(60)[::-1], rng.permutation(60)):
        assert (toxicity.score([texts[i] for i in order], model, hasher, tables) == alone[order]).all()


def test_thresholds_cover_all_labelled_rows(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 9 < (1 if i < 800 else 4)
        marks = ["bad"] * int(rng.integers(0, 4) + 2 * toxic) + ["good"] * int(rng.integers(0, 4))
        rows.append((i, " ".join(rng.permutation(marks + ["plain"] * 3)), "en" if i < 500 else "fr" if i < 890 else "xx"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = toxicity.classify(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), fit_rows=24).collect()
    y, lang = dict(labels), {r[0]: r[2] for r in rows}

    def f1(picked, own):
        hits = sum(y[r.doc_id] for r in picked)
        return 2 * hits / max(1, len(picked) + sum(y[r.doc_id] for r in own))

    for name in ("en", "fr", "xx"):
        own = [r for r in got if lang[r.doc_id] == name and not r.held_out]
        assert len({r.threshold for r in own}) == 1 and 0 < sum(y[r.doc_id] for r in own) < len(own)
        edges = {int(r.score * toxicity.BINS) / toxicity.BINS for r in own}
        best = max(f1([r for r in own if r.score >= e], own) for e in edges)
        assert f1([r for r in own if r.flagged], own) == best
