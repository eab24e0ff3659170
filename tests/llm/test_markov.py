"""The language model's whole score against plain loops, with own, hashed, rare and unseen words."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from prairie.llm import hmm

S = 3


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def forward_backward(start, move, emits):
    """Gammas and expected moves of one sequence; a constant for each token changes neither."""
    n = len(emits)
    emits = [e / max(e) for e in emits]
    a, b = [[0.0] * S for _ in range(n)], [[1.0] * S for _ in range(n)]
    for t in range(n):
        for k in range(S):
            a[t][k] = emits[t][k] * (start[k] if t == 0 else sum(a[t - 1][j] * move[j][k] for j in range(S)))
    for t in range(n - 2, -1, -1):
        for k in range(S):
            b[t][k] = sum(move[k][j] * emits[t + 1][j] * b[t + 1][j] for j in range(S))
    p = sum(a[-1])
    gamma = [[a[t][k] * b[t][k] / p for k in range(S)] for t in range(n)]
    moves = np.zeros((S, S))
    for t in range(n - 1):
        for j in range(S):
            for k in range(S):
                moves[j, k] += a[t][j] * move[j][k] * emits[t + 1][k] * b[t + 1][k] / p
    return p, gamma, moves


def plain_scores(rows, rounds, own, hashed, share_, window):
    texts = [(d, [*(t or "").encode().lower().split(), b""]) for d, t in rows]
    train = [ws for d, ws in texts if not held(d)]
    counts = Counter(w for ws in train for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    order = sorted(counts, key=lambda w: (-counts[w], w))
    first = {w: i for i, w in enumerate(order[:own]) if counts[w] * share_ >= total}
    cell = lambda w: first[w] if w in first else own + zlib.crc32(w) % hashed
    mass = np.zeros(own + hashed)
    for w in counts:
        mass[cell(w)] += counts[w] + (w not in first) + (w in first)
    mass[own:] += 1
    mass = np.maximum(mass, 1)  # cells without a word too
    share = mass / mass.sum()
    model = hmm.first_model(share, S)
    start, move, emit = model.start, model.move, model.emit
    windows = [ws[i : i + window] for ws in train for i in range(0, len(ws), window)]
    for r in range(rounds + 1):
        s, m, e, by_word = np.zeros(S), np.zeros((S, S)), np.zeros((own + hashed, S)), {w: np.zeros(S) for w in counts}
        for ws in windows:
            _, gamma, moves = forward_backward(start, move, [emit[cell(w)] for w in ws])
            s, m = s + gamma[0], m + moves
            for w, g in zip(ws, gamma):
                e[cell(w)] += g
                by_word[w] += g
        if r == rounds:
            break
        start, move = (s + 1) / (s + 1).sum(), (m + 1) / (m + 1).sum(1, keepdims=True)
        e = e + hmm.PRIOR * share[:, None] + e.sum(0) / e.sum()
        emit = e / e.sum(0)
    taken = sum(by_word.values()) / total
    joint = {w: (counts[w] + 1) / (total + distinct + 1) * (by_word[w] + hmm.LEAN * taken) / (counts[w] + hmm.LEAN) for w in counts}
    unseen = taken / (total + distinct + 1)
    scale = sum(joint.values()) + unseen
    assert np.allclose(sum(v / scale for v in joint.values()) + unseen / scale, 1)
    out = []
    for d, ws in texts:
        alpha, log = None, 0.0
        for w in ws:
            b = joint.get(w, unseen) / scale
            alpha = (start if alpha is None else alpha @ move) * b
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        out.append((d, log))
    return out


def documents(seed=5):
    rng = random.Random(seed)
    topics = [[f"a{i}" for i in range(12)], [f"B{i}" for i in range(12)]]
    rows = []
    for d in range(60):
        words = [rng.choice(topics[(d + i // 9) % 2]) if rng.random() < 0.8 else f"rare{rng.randrange(80)}" for i in range(rng.randrange(0, 40))]
        rows.append((d, " ".join(words) if words or d % 2 else None))
    return rows + [(2, "only once here"), (2, rows[3][1]), (None, "a1 \n never-seen É"), (100, " ".join(f"a{i % 12}" for i in range(700)))]


@pytest.mark.parametrize("own, hashed, share", [(6, 4, 30), (6, 4, 1_000_000), (8192, 4096, 60)])
def test_score_is_that_of_plain_loops(spark, own, hashed, share):
    """Some words with cells of their own, some common ones in hash cells, rare and unseen ones."""
    rows = documents()
    df = spark.createDataFrame([(d, t, 0, "") for d, t in rows], "doc_id long, text string, n int, word string").repartition(3)
    got = hmm.score(df, rounds=2, states=S, own=own, hashed=hashed, share=share).collect()
    want = plain_scores(rows, 2, own, hashed, share, hmm.WINDOW)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for a, b in zip(sorted(((r.doc_id, r.score) for r in got), key=key), sorted(want, key=key), strict=True):
        assert a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-6), (a, b)


def test_what_is_learned_grows_with_the_words(spark):
    """Each training word has its row, whatever the cells."""
    df = spark.createDataFrame([(i, " ".join(f"w{i * 50 + j}" for j in range(50))) for i in range(40)], "doc_id long, text string")
    rows = df.selectExpr("doc_id AS _key", "text AS _text", "false AS held_out")
    lex = hmm.lexicon(hmm.word_counts(rows), 4, 8, 100)
    found = hmm.word_states(hmm.encoded(rows, lex), hmm.first_model(lex.share, S), lex).collect()
    assert len(found) == 2001 and len(lex.words) == 1
    for r in found:
        unit = hmm.UNIT / (lex.n[lex.numbers[bytes(r.word)]] if bytes(r.word) in lex.numbers else lex.rare_most)
        counts = hmm.unpacked([np.array([r.p0]), np.array([r.p1])], unit, S)[0]
        assert counts.sum() == pytest.approx(r.n, rel=1e-4)


def test_packing_keeps_counts():
    rng = np.random.default_rng(3)
    for states in (1, 2, 5, 6):
        counts = rng.random((40, states)) * 100
        assert np.allclose(hmm.unpacked(hmm.packed(counts, 1e6), 1e6, states), counts, atol=1e-5)
