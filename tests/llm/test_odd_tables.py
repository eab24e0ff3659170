"""Odd column names and types, records without a layout, and changes of the line store in any order."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from prairie.llm import chat, decontaminate, jaccard, lines, packing, quality, toxicity
from prairie.session import fresh_path, table
from tests.llm import cases
from tests.llm.test_groups import applied, plain_dedup, texts

STAGES = [quality.stage, lines.stage, jaccard.stage, decontaminate.stage]


def odd(spark, sf_dir):
    """Documents with columns named as helpers are, with dots, backticks and maps."""
    docs = table(spark, sf_dir, "documents").limit(40)
    names = ["_name", "_row", "_whole", "_body", "_text", "_key", "row", "class", "size", "kept", "a.b", "c`d", "drops", "_NAME_"]
    docs = docs.select("*", *(F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names))
    tags = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("x.y"), F.col("doc_id")))
    return docs.withColumn("tags", tags).withColumn("deep", F.array(F.struct(tags.alias("m"))))


@pytest.mark.parametrize("stage", STAGES)
def test_stages_keep_odd_columns(spark, sf_dir, stage):
    docs = odd(spark, sf_dir)
    before = {r.doc_id: r for r in docs.collect()}
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        for c in docs.columns:
            if c not in ("text", "n_chars"):
                assert r[c] == before[r.doc_id][c], c


def test_packing_of_odd_columns(spark, sf_dir):
    docs = odd(spark, sf_dir)
    assert packing.stage(spark, docs, sf_dir).select("doc_id").distinct().count() == docs.count()


def test_near_duplicates_take_one_of_repeated_rows_with_maps(spark, sf_dir):
    docs = odd(spark, sf_dir)
    assert jaccard.stage(spark, docs.union(docs), sf_dir).count() == jaccard.stage(spark, docs, sf_dir).count()


# Chat ------------------------------------------------------------------------------


def test_conversations_without_a_layout_stay(spark):
    rows = [(1, 0, '{"prompt": "a", "response": "b"}'), (2, 0, "no json"), (2, 1, None), (3, 0, '{"other": 1}'), (4, 0, '{"role": "user", "text": "x"}'), (4, 1, "{}")]
    df = spark.createDataFrame(rows, "conv long, turn long, record string")
    got = {r.conv: r for r in chat.digests(chat.formatted(df, "conv", "turn", "record"), "conv").collect()}
    assert sorted(got) == [1, 2, 3, 4] and [got[i].n_turns for i in (1, 2, 3, 4)] == [2, 0, 0, 1]
    assert got[2].formatted_chars == got[3].loss_chars == 0
    assert chat.formatted(df.limit(0), "conv", "turn", "record").count() == 0


def test_long_texts_are_read_back(spark):
    long = ("</s>[INST] \\ " + "word " * 40) * 800
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "assistant", "")]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    records = df.select("conv", "turn", F.to_json(F.struct("role", "text")).alias("record"))
    made = chat.formatted(records, "conv", "turn", "record")
    turns = made.select(chat.Template().read(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in turns] == [r[2:] for r in rows]
    assert chat.digests(made, "conv").first().loss_chars == len(long)


# Lines -----------------------------------------------------------------------------


def test_deletion_of_what_is_not_there_changes_nothing(spark):
    schema = "doc_id long, text string"
    rows = texts(4, 40)
    docs, other = spark.createDataFrame(rows, schema), spark.createDataFrame([(i, t) for i, t in texts(5, 30)], schema)
    store = lines.LineStore(spark, shards=4)
    store.delete(docs)
    store.insert(docs)
    want = sorted(map(repr, plain_dedup(rows)))
    assert applied(store, docs) == want
    store.delete(other.where("doc_id < 0"))
    store.delete(docs)
    store.delete(docs)
    assert store.drops.count() == 0
    store.insert(docs)
    assert applied(store, docs) == want


@pytest.mark.parametrize("slots", [4, 1 << 12])
def test_store_is_opened_again_by_another_job(spark, slots):
    schema = "doc_id long, text string"
    first, second = texts(1), [(i + 1000, t) for i, t in texts(2)]
    a, b = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    path = fresh_path(spark, "store")
    lines.LineStore(spark, path, shards=4, slots=slots, least_docs=4).insert(a)
    again = lines.LineStore.open(spark, path)
    assert (again.least_docs, again.shards, again.slots, again.version) == (4, 4, slots, 1)
    again.insert(b)
    third = lines.LineStore.open(spark, path)
    both = a.union(b)
    assert applied(third, both) == sorted(map(repr, plain_dedup(first + second, 4)))
    third.delete(a)
    assert applied(lines.LineStore.open(spark, path), b) == sorted(map(repr, plain_dedup(second, 4)))


def test_a_full_filter_is_made_anew(spark):
    """Once deletions leave room, the filter rules lines out again, and misses none."""
    line = lambda i: f"line number {i} that is long enough to count as one of the lines"
    many = spark.createDataFrame([(d, "\n".join(map(line, range(60)))) for d in range(6)], "doc_id long, text string")
    few = spark.createDataFrame([(d, "\n".join(map(line, range(60, 64)))) for d in range(10, 16)], "doc_id long, text string")
    store = lines.LineStore(spark, shards=1, slots=16)
    store.insert(many)
    store.insert(few)
    assert store.filters[0][1]
    store.delete(many)
    assert not store.filters[0][1] and store.drops.count() == 4
    assert store.candidates(store.keys(few)).count() == 24 and store.candidates(store.keys(many)).count() < 180


# Decontamination -------------------------------------------------------------------


def test_blocks_give_the_hits_of_one_automaton(spark, sf_dir):
    docs, items = cases.documents(spark), spark.createDataFrame([(1, cases.LINE), (2, "word1 word2"), (2, "x"), (None, "own words"), (3, "no such words here")], "item_id long, text string")
    rows = lambda df: sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans)) for r in df.collect())
    whole = rows(decontaminate.scan(docs, items))
    assert rows(decontaminate.scan(docs, items, block=1)) == rows(decontaminate.scan(docs, items, block=3)) == whole
    assert any("['', '1']" in r for r in whole)


# Toxicity --------------------------------------------------------------------------


def plain_pooled(model, numbers):
    """The largest answer of each filter, window by window; a text ends with its gap words."""
    words = [model.embedding[a] + model.embedding[b] for a, b in [*numbers.tolist(), *[(0, 0)] * max(toxicity.WIDTHS)]]
    out = []
    for w in toxicity.WIDTHS:
        windows = [sum(words[i + j] @ model.filters[w][j] for j in range(w)) for i in range(len(words) - w + 1)]
        out.append(np.max(windows, 0) + model.bias[w])
    return np.concatenate(out)


def small_model(seed=1, rows=9):
    rng = np.random.default_rng(seed)
    embedding = rng.normal(size=(rows, toxicity.EMBEDDING)).astype(np.float32)
    embedding[0] = 0
    filters = {w: rng.normal(0, 0.5, (w, toxicity.EMBEDDING, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS}
    bias = {w: rng.normal(0, 0.3, toxicity.FILTERS).astype(np.float32) for w in toxicity.WIDTHS}
    dense = rng.normal(0, 0.2, len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32)
    return toxicity.Model({}, embedding, filters, bias, dense, 0.1), rng


def test_scores_are_those_of_plain_loops():
    texts = ["bad word here", "", "a b c d e f g a b", "Bad, BAD!", "word", "x " * 3000, "ünï çödé \U0001f600", "one\ntwo\tthree"] * 3
    model = toxicity.fit(texts, [int("ad" in t) for t in texts])
    hasher = toxicity.Hasher(model.rows)
    got = toxicity.score(texts, model, hasher, model.tables())
    for text, p in zip(texts, got):
        pooled = plain_pooled(model, hasher.numbers(text))
        z = float(np.maximum(pooled, 0) @ model.dense) + model.offset
        assert p == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)


def test_pooling_of_a_batch_is_that_of_each_text():
    model, rng = small_model()
    numbers = [rng.integers(0, 9, (n, 2)).astype(np.int32) for n in (0, 1, 2, 3, 17, 1, 0, 40)]
    got = model.pooled(*toxicity.joined(numbers), model.tables())
    assert np.allclose(got, [plain_pooled(model, n) for n in numbers], atol=1e-4)


def test_gradients_are_finite_differences():
    model, rng = small_model(2)
    numbers = [rng.integers(1, 9, (n, 2)).astype(np.int32) for n in (3, 8, 1, 12, 5)]
    y = np.array([1.0, 0, 1, 0, 1])
    flat, starts = toxicity.joined(numbers)

    def loss():
        p = model.score(model.pooled(flat, starts, model.tables()))
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    pooled, places = model.pooled(flat, starts, model.tables(), places=True)
    g = toxicity.gradients(model, flat, pooled, places, model.score(pooled), y)
    checked = 0
    for array, found in [(model.embedding, g.embedding), (model.dense, g.dense), *((model.filters[w], g.filters[w]) for w in toxicity.WIDTHS), *((model.bias[w], g.bias[w]) for w in toxicity.WIDTHS)]:
        for at in rng.choice(array.size, 25):
            place = np.unravel_index(at, array.shape)
            if array is model.embedding and place[0] == 0:
                continue
            old, sides = array[place], []
            for step in (2e-3, -2e-3):
                array[place] = old + step
                sides.append(loss())
            array[place] = old
            assert found[place] == pytest.approx((sides[0] - sides[1]) / 4e-3, abs=2e-3)
            checked += abs(found[place]) > 5e-3
    assert checked > 30


def test_sample_keeps_to_its_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (10_000 if i == 7 else 100)) for i in range(50)], "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(50)], "_id long, _y int")
    rows = toxicity.sample(docs, known, "doc_id", "text", 40, 3000)
    assert len(rows) == 30 and all(len(r["_t"]) == 100 for r in rows)
    assert len(toxicity.sample(docs, known, "doc_id", "text", 40)) == 40


def test_classifier_reads_long_and_odd_texts(spark):
    rows = [(i, f"{'vile' if i % 3 == 0 else 'kind'} word{i % 7} " * 3, "en") for i in range(200)]
    rows += [(300, "vile " * 50_000, "xx"), (301, None, None), (302, "\x00 \U0001f600 " + "a" * 200_000, "en"), (304, "kind " * 50_000, "en"), (300, "vile " * 50_000, "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(5, 7)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert all((r.score > 0.5) == (r.doc_id % 3 == 0) for r in got if r.doc_id < 300 or r.doc_id in (300, 304))
