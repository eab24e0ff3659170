"""The fitted text model and its five queries against numpy; numbering and sparse blocks."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from prairie.functions.text import words_ascii
from prairie.operators import features, models, ranking, vectors
from prairie.plans import models as plans
from prairie.plans import vectors as text_plans
from prairie.session import fresh_path


def tokens(text):
    return [w.lower() for w in re.findall("[a-zA-Z]+", text or "")]


class Plain:
    """Fit on some texts, apply to others, with dense matrices."""

    def __init__(self, texts, labels):
        counts = Counter(w for t in texts for w in tokens(t))
        self.words = sorted(counts, key=lambda w: (-counts[w], w))[: vectors.SIZE]
        x = self.counts(texts)
        df = (x > 0).sum(0)
        self.idf = np.where(df < len(texts), np.log(len(texts) / np.maximum(df, 1)), 0)
        x = x * self.idf
        self.mean, self.std = x.mean(0), x.std(0)
        self.std[self.std < 1e-12] = 0
        x = self.scaled(x)
        known = np.array([y is not None for y in labels])
        x, y = x[known], np.array([y for y in labels if y is not None])
        w, rate, last, self.rounds = np.zeros(len(self.words)), 0.003, None, 0
        for self.rounds in range(200):
            z = x @ w
            loss = (np.logaddexp(0, z) - y * z).mean() + 0.005 * w @ w
            if last is not None:
                rate *= 1.05 if loss < last else 0.5
                if abs(last - loss) < 1e-4:
                    break
            last = loss
            w = w - rate * (x.T @ (1 / (1 + np.exp(-z)) - y) / len(y) + 0.01 * w)
        self.w = w

    def counts(self, texts):
        place = {w: i for i, w in enumerate(self.words)}
        x = np.zeros((len(texts), len(self.words)))
        for i, t in enumerate(texts):
            for w in tokens(t):
                if w in place:
                    x[i, place[w]] += 1
        return x

    def scaled(self, x):
        return np.where((x != 0) & (self.std > 0), (x - self.mean) / np.where(self.std > 0, self.std, 1), 0)

    def p(self, texts):
        return 1 / (1 + np.exp(-(self.scaled(self.counts(texts) * self.idf) @ self.w)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Documents with words that only a fifth of them have, empty and null texts, and some without label."""
    rng = np.random.default_rng(9)
    names = np.array([f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"][:650])
    quality = [int(v) for v in rng.random(60) < 0.55]
    texts = [" ".join(rng.choice(names[quality[i] * 30 : 620 + quality[i] * 30], 60)) + (" Unseen" if i % 5 == 0 else "") for i in range(60)]
    texts[7], texts[15] = None, ""
    path = tmp_path_factory.mktemp("fitted")
    pq.write_table(pa.table({"doc_id": range(60), "text": texts, "lang": ["en"] * 60}), str(path / "documents.parquet"))
    labels = [(i, quality[i]) for i in range(60) if i % 9 != 4]
    pq.write_table(pa.table({"doc_id": [i for i, _ in labels], "quality": pa.array([q for _, q in labels], pa.int32()), "toxic": [0] * len(labels)}), str(path / "labels.parquet"))
    plain = Plain([texts[i] for i, _ in labels if i % 5], [q for i, q in labels if i % 5])
    unseen = [(i, q) for i, q in labels if i % 5 == 0]
    return str(path), plain, unseen, plain.p([texts[i] for i, _ in unseen]), texts


def test_weights_over_all_words_until_the_stop_rule(spark, folder):
    path, plain, *_ = folder
    assert len(plain.words) > 500 and plain.rounds > 20 and "unseen" not in plain.words
    got = {r.idx: r.w for r in plans.QUERIES["c8_logistic_weights"](spark, path).collect()}
    assert got == pytest.approx(dict(enumerate(plain.w)), abs=1e-8)


def test_scores_of_unseen_documents(spark, folder):
    path, plain, unseen, p, texts = folder
    got = {r.doc_id: (r.label, r.p) for r in plans.QUERIES["c9_logistic_scores"](spark, path).collect()}
    assert {i: y for i, (y, _) in got.items()} == dict(unseen)
    assert [got[i][1] for i, _ in unseen] == pytest.approx(p.tolist(), abs=2e-6) and got[15][1] == 0.5

    sweep = {r.threshold: (r.tp, r.fp, r.tn, r.fn, r.f1) for r in plans.QUERIES["c10_logistic_sweep"](spark, path).collect()}
    y = np.array([q for _, q in unseen])
    for t in models.THRESHOLDS:
        tp, fp, tn, fn = (int(((y == a) & ((p >= t) == b)).sum()) for a, b in ((1, True), (0, True), (0, False), (1, False)))
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0
        assert sweep[t] == (tp, fp, tn, fn, pytest.approx(f1))

    bad = [(i, round(v, 6), (texts[i] or "")[:300]) for (i, q), v in zip(unseen, p) if q == 0 and v >= 0.5][:3]
    rows = plans.QUERIES["p15_o9_false_positives"](spark, path).collect()
    assert bad and sorted((r.doc_id, r.snippet) for r in rows) == [(i, s) for i, _, s in bad]

    top = sorted((i for i in range(len(plain.w)) if plain.w[i] > 0 and plain.words[i] not in text_plans.STOP_WORDS), key=lambda i: (-plain.w[i], i))[:20]
    rows = plans.QUERIES["o7_top_coefficients"](spark, path).collect()
    assert [(r.idx, r.word) for r in rows] == [(i, plain.words[i]) for i in top]


def test_model_is_read_back_by_another_job(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, "a c c", 0), (3, "b d", None), (4, None, 1)], "id long, text string, label int")
    path = fresh_path(spark, "model")
    made = features.fit(docs, "id", words_ascii("text"), path, rounds=5, rate=0.5)
    again = features.TextModel.load(spark, path)
    new = spark.createDataFrame([(9, "A zzz b", 1), (10, "", 0), (11, None, None)], "id long, text string, label int")
    plain = Plain(["a b", "a c c", "b d", None], [1, 0, None, 1])
    assert [r.word for r in again.vocab.orderBy("idx").collect()] == plain.words
    rows = {r.id: [(e.idx, e.v) for e in r.entries] for r in again.vectors(new, "id", words_ascii("text")).collect()}
    want = plain.scaled(plain.counts(["A zzz b"]) * plain.idf)[0]
    assert rows[10] == rows[11] == [] and dict(rows[9]) == pytest.approx({i: v for i, v in enumerate(want) if v})
    for a, b in zip(made.scored(new, "id", words_ascii("text")).orderBy("id").collect(), again.scored(new, "id", words_ascii("text")).orderBy("id").collect()):
        assert a == b
    empty = features.fit(docs.limit(0), "id", words_ascii("text"), fresh_path(spark, "model"))
    assert empty.vocab.count() == 0 and [r.p for r in empty.scored(new, "id", words_ascii("text")).collect()] == [0.5] * 3


@pytest.mark.parametrize("entries, span", [(1, 3), (7, 4), (1 << 18, 2048)])
def test_blocks_hold_every_row_once(spark, monkeypatch, entries, span):
    monkeypatch.setattr(models, "ENTRIES", entries)
    monkeypatch.setattr(models, "RANGE", span)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 10)) * (rng.random((50, 10)) < 0.4)
    rows = [(int(i % 3 == 0), [(j, float(v)) for j, v in enumerate(r) if v]) for i, r in enumerate(x)] + [(None, [(1, 5.0)]), (1, [])]
    df = spark.createDataFrame(rows, "label int, entries array<struct<idx:long,v:double>>").repartition(2)
    blocks = models.packed(df).collect()
    sizes = [np.frombuffer(b["sizes"], "<i4") for b in blocks]
    assert sum(map(len, sizes)) == 51 and sum(int(s.sum()) for s in sizes) == int((x != 0).sum())
    assert all(len(s) == 1 or (s.sum() <= entries and len(s) <= entries) for s in sizes)
    w = rng.normal(size=10)
    y, z = np.array([*(i % 3 == 0 for i in range(50)), 1]), np.append(x @ w, 0)
    got = {r.idx: r.total for r in models.gradient(df, w).collect()}
    want = np.vstack([x, np.zeros(10)]).T @ (1 / (1 + np.exp(-z)) - y)
    assert got.pop(-2) == 51 and got.pop(-1) == pytest.approx(float((np.logaddexp(0, z) - y * z).sum()))
    assert got == pytest.approx(dict(enumerate(want)))


def test_every_row_gets_its_place(spark):
    rows = [(i * 7919 % 1000 // 3, f"w{i}") for i in range(1000)] + [(None, "x"), (5, "w1"), (5, "w1")]
    df = spark.createDataFrame(rows, "n long, word string").repartition(6)
    got = ranking.numbered(df, F.desc("n"), "word").collect()
    assert sorted(r.idx for r in got) == list(range(1003))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.n, r.word) for r in sorted(got, key=lambda r: r.idx)] == order
    assert ranking.numbered(df.limit(0), "n").count() == 0
    plan = vectors.all_ranks(df.dropDuplicates())._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_documents_are_read_once_for_all_vectors(spark, sf_dir):
    """Vocabulary, counts and moments come from one pass over the texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    c = vectors.corpus(docs, "doc_id", words_ascii("text"))
    plan = vectors.standardised(c.tfidf_raw(), "doc_id", vectors.moments(c.tfidf_raw(), c.n))._jdf.queryExecution().toString()
    assert "documents.parquet" not in plan and c.n == docs.count()
    assert math.isclose(c.long.agg(F.sum("cnt")).first()[0], sum(len(tokens(r.text)) for r in docs.collect()))


def test_category_goes_along_without_a_join(spark, sf_dir):
    from prairie.plans import vectors as pv

    made = pv.with_category(spark, sf_dir)
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "lang")
    assert made.join(docs, "doc_id").where("category <> lang").count() == 0 and made.count() > 0


def test_scoring_reads_the_texts_once(spark, tmp_path):
    from prairie.functions.text import words_ascii
    from prairie.operators import features

    docs = spark.createDataFrame([(i, f"one {'two' if i % 3 else 'three'} w{i % 5}", i % 2) for i in range(30)], "doc_id long, text string, label int")
    model = features.fit(docs, "doc_id", words_ascii("text"), str(tmp_path / "model"), rounds=2)
    found = model.scored(docs, "doc_id", words_ascii("text"))
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 30


def test_vectors_are_made_in_their_rows(spark):
    """No shuffle; repeated ids stay rows of their own, texts without words have empty vectors."""
    texts = [(1, "a b b c"), (1, "c"), (2, None), (None, "a a"), (3, "b zz"), (4, "")]
    docs = spark.createDataFrame(texts, "id long, text string")
    c = vectors.corpus(docs, "id", words_ascii("text"), 3)
    made = vectors.valued(c.counts, c.vocab.select("idx", F.lit(2.0).alias("f")), lambda cnt, total, f: cnt * f / total, "id")
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    place = {r.word: r.idx for r in c.vocab.collect()}
    got = sorted((r.id or 0, [(e.idx, round(e.v, 9)) for e in r.entries]) for r in made.collect())
    want = []
    for i, text in texts:
        n = Counter(w for w in tokens(text) if w in place)
        want.append((i or 0, sorted((place[w], round(2 * x / n.total(), 9)) for w, x in n.items())))
    assert got == sorted(want)
    assert sum(len(e) for _, e in got) == c.long.count() and len(c.norm_vectors().collect()) == 6


def test_equal_entries_of_a_block_are_held_once(spark):
    rows = [(i % 2, [(j, float(1 + (i + j) % 2)) for j in range(40)]) for i in range(300)] + [(1, [])]
    df = spark.createDataFrame(rows, "label int, entries array<struct<idx:long,v:double>>").coalesce(1)
    [block] = models.packed(df).collect()
    assert len(block["v"]) == 8 * 80 and len(block["codes"]) == 2 * 300 * 40
    x = np.array([[v for _, v in e] or [0] * 40 for _, e in rows])
    y, w = np.array([label for label, _ in rows]), np.linspace(-0.1, 0.1, 40)
    got = {r.idx: r.total for r in models.gradient(df, w).collect()}
    want = x.T @ (1 / (1 + np.exp(-(x @ w))) - y)
    assert [got[j] for j in range(40)] == pytest.approx(want.tolist()) and got[-2] == 301
    many = [(0, [(j, j / 7)]) for j in range(70_000)]  # more entries than two bytes tell apart
    df = spark.createDataFrame(many, "label int, entries array<struct<idx:long,v:double>>").coalesce(1)
    got = {r.idx: r.total for r in models.gradient(df, np.zeros(70_000)).collect()}
    assert got[69_999] == pytest.approx(69_999 / 14) and len(got) == 70_001
