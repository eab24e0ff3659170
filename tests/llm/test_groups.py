"""Operators that compare documents with each other, and the pipeline, against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from prairie.llm import decontaminate, jaccard, lines, packing, quality, registry, tokens
from tests.llm import cases
from tests.llm.test_text_operators import lower, plain_hits, plain_measures, words

STRIP = " \t\n\x0b\x0c\r"


# Lines -----------------------------------------------------------------------------

def plain_dedup(rows, least_docs=lines.LEAST_DOCS, least_chars=lines.LEAST_CHARS):
    holders = defaultdict(set)
    rank = lambda d: -(2**63) if d is None else d
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(k := lower(line.strip(STRIP))) >= least_chars:
                holders[k].add(rank(d))
    out = []
    for d, t in rows:
        own = (t or "").split("\n")
        gone = lambda x: len(h := holders.get(lower(x.strip(STRIP)), ())) >= least_docs and max(h) != rank(d)  # noqa: E731, B023
        kept = [x for x in own if not gone(x)]
        out.append((d, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def applied(store, docs, keys=None):
    return sorted(repr((r.row.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in store.apply(docs, keys=keys).collect())


def texts(seed=1, n=60):
    rng = random.Random(seed)
    pool = [f"{'Common' if i % 2 else 'shared'} line number {i} with enough characters to count" for i in range(8)] + ["short", "", "  \t"]
    return [(i, "\n".join(rng.choice([f" {p}\t", p.upper(), p]) for p in rng.choices(pool, k=rng.randint(0, 6))) or None) for i in range(n)]


def test_lines_of_all_cases(spark):
    docs = cases.documents(spark)
    want = sorted(map(repr, plain_dedup([r[:2] for r in cases.rows()])))
    got = sorted(repr((r.row.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in lines.dedup(docs).collect())
    assert got == want and any(", 2, " in w for w in want)
    assert lines.dedup(cases.nothing(spark)).count() == 0
    out = lines.stage(spark, docs, "")
    assert out.columns == docs.columns and out.count() == docs.count()


@pytest.mark.parametrize("shards, slots", [(4, 1024), (1, 4)])
def test_deletions_undo_insertions(spark, shards, slots):
    """Also with a filter that is far too small: it says maybe, the result is the same."""
    first, second = texts(1), [(i + 1000, t) for i, t in texts(2)]
    schema = "doc_id long, text string"
    a, b = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    store = lines.LineStore(spark, shards=shards, slots=slots)
    store.insert(a)
    before = applied(store, a)
    assert before == sorted(map(repr, plain_dedup(first)))
    store.insert(b)
    assert applied(store, a.union(b)) == sorted(map(repr, plain_dedup(first + second)))
    store.delete(b)
    assert applied(store, a) == before
    store.delete(a)
    assert store.drops.count() == 0 and applied(store, a) == sorted(map(repr, ((d, *_untouched(t)) for d, t in first)))


def _untouched(t):
    t = t or ""
    return t.count("\n") + 1, 0, t


def test_cuckoo_holds_what_was_added():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, (900, 2), dtype=np.uint64)
    cuckoo = lines.Cuckoo(1024)
    places = np.stack(cuckoo.places(keys, 4), 1)
    for p in places[:850].tolist():
        cuckoo.add(*p)
    assert not cuckoo.full and cuckoo.has(*places[:850].T).all() and cuckoo.has(*places[850:].T).sum() < 5
    for p in places[:400].tolist():
        cuckoo.remove(*p)
    assert cuckoo.has(*places[400:850].T).all() and cuckoo.has(*places[:400].T).sum() < 10
    for p in np.concatenate([places, places]).tolist():
        if not cuckoo.full:
            cuckoo.add(*p)
    assert cuckoo.full and cuckoo.has(*places.T).all()


# Near duplicates -------------------------------------------------------------------

def plain_components(rows, width, percent, rank=lambda d: d):
    sets = []
    for _, t in rows:
        own = words(lower(t))
        n = min(width, len(own))
        sets.append(frozenset(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) if n else frozenset())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), d) if x is not None]
        least[find(i)] = min(known, key=rank) if known else None
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def near_copies(seed, groups=6, size=12, n=120):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=25)
    rows = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=n)
        if g % 2:
            base[10:35] = passage
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append(" ".join(own))
    rows += [rows[0]] * 5 + [" ".join(rng.choices(vocabulary, k=n)) for _ in range(30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width, percent, seed, block", [(4, 85, 1, 256), (5, 80, 2, 4), (4, 85, 3, 3), (2, 50, 4, 16)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, width, percent, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near(docs, width=width, percent=percent).collect())
    want = sorted(plain_components(rows, width, percent))
    assert got == want and 15 < len({c for _, _, c in want}) < len(want)


def test_dense_group_with_documents_at_its_edge(spark):
    """A large group around one text, many of whose members link with the centre only or with nothing."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        own = list(base)
        for _ in range(rng.randint(1, 9)):
            own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near(docs, width=4, percent=85).collect())
    assert got == sorted(plain_components(rows, 4, 85))


def test_near_duplicates_of_all_cases(spark):
    got = sorted(repr(tuple(r)) for r in jaccard.near(cases.documents(spark)).collect())
    assert got == sorted(map(repr, plain_components([r[:2] for r in cases.rows()], 5, 80)))
    assert jaccard.near(cases.nothing(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = cases.documents(spark)
    kept = jaccard.stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    # 1, 2, 3 and the null id are near copies, of which the null id is the smallest; repeated rows count once.
    assert ids == sorted(["None", "None", "3", "4", "5", "6", "7", "8", "9", "10", "11", *map(str, range(20, 26)), "30"])


def test_filters_lose_no_pair():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = set(rng.sample(range(100), n))
        b = set(rng.sample(sorted(a), rng.randint(max(1, n - 4), n))) | set(rng.sample(range(100, 200), rng.randint(0, 4)))
        both = len(a & b)
        links = 100 * both >= 80 * (len(a) + len(b) - both)
        assert links == (both >= jaccard.needed(len(a), len(b), 80))
        if links:
            order = sorted(a | b, key=lambda x: zlib.crc32(str(x).encode()))
            first = [set([x for x in order if x in s][: jaccard.prefix_length(len(s), 80)]) for s in (a, b)]
            assert first[0] & first[1]


# Pipeline --------------------------------------------------------------------------

def plain_pipeline(rows, items, encode):
    def passes(t):
        n, chars, symbols, dup, repeat = plain_measures(t)
        own = [x for x in (t or "").split("\n") if words(x)]
        return not (
            n < 20 or 100 * repeat > 30 * n or 10 * symbols > n or 100 * dup > 50 * len(own)
            or chars < 2 * n or chars > 40 * n or 10 * (t or "").count("!") > 3 * n
        )

    rows = [(d, t) for d, t in rows if passes(t)]
    rows = [(d, kept if t is not None else None) for (d, t), (_, _, _, kept) in zip(rows, plain_dedup(rows), strict=True)]
    kept = []
    for (d, t), (_, _, c) in zip(rows, plain_components(rows, 5, 80), strict=True):
        if d == c and (d, t) not in kept:
            kept.append((d, t))
    hits = {repr(r[0]): r for r in plain_hits(kept, items)}
    kept = [(d, t) for d, t in kept if not (hits[repr(d)][2] and 20 * hits[repr(d)][2] >= hits[repr(d)][1])]
    return {d: encode(t) for d, t in kept}


def test_pipeline_is_that_of_plain_python(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = plain_pipeline(rows, items, lambda t: library.encode(t or "", add_special_tokens=False).ids + [packing.END])
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got[r.doc_id].append(r)
    assert sorted(got) == sorted(want) and 50 < len(want) < len(rows)
    for d, pieces in got.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            ids = np.array(want[d][at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(want[d]), zlib.crc32(ids))
            at += p.length
        assert at == len(want[d])


def test_pipeline_stages_hold_all_cases(spark, tmp_path):
    spark.createDataFrame([(1, "seen in many documents of the table")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (cases.documents(spark), cases.nothing(spark)):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns, name
            path = f"{tmp_path}/{i}-{docs is None}-{random.random()}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
    names = registry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert decontaminate.WIDTH == 13 and quality.WINDOW == 8
