"""Prefix trie, ranked search and SimHash against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from prairie.llm import search, simhash, trie
from prairie.session import table
from tests.llm import cases
from tests.llm.test_text_operators import lower, words

# Prefix trie -----------------------------------------------------------------------


def _said(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain_trie(rows, forked=True):
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, _said(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    whole = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if forked else 0
        whole[c] = tuple((own.get(c - int(math.fmod(c, 20)), []) if h else [])[:h] + said[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
        ends[whole[c]].append(str(c))
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(words(k[-1][1])) if k else 0
    return sorted(
        repr((m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(",".join(ends[k]).encode()).hexdigest()))
        for k, m in members.items()
    )


TURNS = "conv_id long, turn long, role string, text string, depth long, node string"


def turn_rows(seed=3, n=90):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 200), n):
        for t in range(rng.choice([1, 2, 3, 4, 7])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", "A  b\tc", "é x"]), 1, "n"))
    rows += [(500, t, "user", f"turn {t % 5}", None, None) for t in range(400)]  # long
    rows += [(c, t, "user", f"turn {t % 5}", 0, "") for c in range(540, 570) for t in range(6)]  # copies of its start
    rows += [(7000, None, "user", "null turn", 1, ""), (7000, 2, "b", "tie", 1, ""), (7000, 2, "a", "tie", 1, ""), (7000, 2, "a", "tie", 1, "")]
    rows += [(None, 1, "user", "nobody", 1, ""), (7000, 1, "user", "x" * 100_000 + " y", 1, "")]
    return rows


def shown(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(repr(tuple(r)) for r in df.select(names).collect())


@pytest.mark.parametrize("subtree, shard", [(trie.SUBTREE, trie.SHARD), (20, 10)])
def test_trie_of_all_cases(spark, subtree, shard):
    """With a small bound the long conversation is cut over several rounds."""
    rows = turn_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    donor, head = F.col("conv") - F.col("conv") % 20, F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    assert shown(trie.prefix_trie(df, donor=donor, head=head, subtree=subtree, shard=shard)) == plain_trie(rows)
    if shard < 100:
        assert shown(trie.prefix_trie(df, subtree=subtree, shard=shard)) == plain_trie(rows, False)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 0, "")], TURNS)).count() == 0


def test_long_conversation_lies_in_several_partitions(spark):
    """Numbers and sums go on from partition to partition."""
    hashes = [hashlib.sha256(bytes([i])).digest()[:16] for i in range(30)]
    want, total = [], 0
    for i, h in enumerate(hashes, 1):
        total = (total + int.from_bytes(h, "big") * pow(trie.BASE, i, trie.PRIME)) % trie.PRIME
        want.append(total)
    cuts, ends = [(0, 7), (7, 19), (19, 30)], []
    for part, (a, b) in enumerate(cuts):
        inside = sum(int.from_bytes(h, "big") * pow(trie.BASE, i, trie.PRIME) for i, h in enumerate(hashes[a:b], 1)) % trie.PRIME
        ends.append((part, 5 if part else 1, 5, b - a, inside.to_bytes(16, "big")))
    carry = trie.carried(ends)
    assert carry == {1: (5, 7, want[6]), 2: (5, 19, want[18])}


def test_node_table_gives_each_key_its_slot():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2), dtype=np.uint64)
    nodes = trie.NodeTable(keys[:4000])
    assert sorted(nodes.slots(keys[:4000]).tolist()) == list(range(4000))
    assert (nodes.slots(keys[4000:]) == -1).all()
    assert (nodes.keys[nodes.slots(keys[:4000])] == keys[:4000]).all()
    with pytest.raises(ValueError):
        trie.NodeTable(np.concatenate([keys[:5], keys[:1]]))


def test_ids_of_a_node_are_read_in_order(spark):
    ends = spark.createDataFrame([(bytes([i % 3]) * 16, i) for i in range(-50, 3000)], "node binary, conv long").repartition(7)
    got = {r.node: r.ends_sha256 for r in trie.ends_digest(ends, piece=100).collect()}
    for k in range(3):
        ids = ",".join(str(i) for i in range(-50, 3000) if i % 3 == k)
        assert got[bytes([k]) * 16] == hashlib.sha256(ids.encode()).hexdigest()


# Search ----------------------------------------------------------------------------


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))


def plain_search(docs, items, top=search.TOP):
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // n_terms
            s = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                for t, times in Counter(plain_terms(text)).items()
                if t in b
            )
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [repr((item, i + 1, s[3], -s[0])) for i, s in enumerate(sorted(scores)[:top])]
    return sorted(out)


ITEMS = "item_id long, text string, rank int, score long, doc_id string"


def test_search_of_all_cases(spark):
    items = [(1, cases.LINE), (2, None), (3, ""), (None, "word1 WORD1 w3"), (4, "own words of this text 3 4 5"), (4, "one X x É ÄÄ 😀 endoftext"), (5, "-- _")]
    items += [(10 + i, f"word{i} w{i} w{i * 7} one") for i in range(30)]
    df = spark.createDataFrame([(*i, 0, 0, "") for i in items], ITEMS)
    docs = cases.documents(spark)
    want = plain_search([r[:2] for r in cases.rows()], items)
    for size in (search.ITEM_BYTES, 40):  # one block, and one for a few items each
        found = search.search(docs, df, item_bytes=size)
        assert sorted(repr((r.item_id, r["rank"], r.doc_id, r.score)) for r in found.collect()) == want
    assert search.search(cases.nothing(spark), df).count() == 0
    assert search.search(docs, df.limit(0)).count() == 0


def test_ties_at_the_edge_go_by_key(spark):
    docs = spark.createDataFrame([(i, "same text" if i % 3 else "same") for i in range(3000, 0, -1)], "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, "text"), (2, "same same")], "item_id long, text string")
    rows = search.search(docs, items).collect()
    ids = [i for i in range(1, 3001) if i % 3][:20]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r["rank"]) if r.item_id == 1] == ids


def test_tiles_keep_sums_exact():
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 25_000, (700, 9)).astype(np.int64)
    weights[3, 4] = 1 << 50  # one weight beyond the bound
    parts = search.tiles(weights, 0)
    back = np.zeros_like(weights)
    for first, w in parts:
        assert int(w.sum(0).max()) * search.IMPACT < search.EXACT and len(w) <= search.TERMS
        back[first : first + len(w)] += w.astype(np.int64)
    assert (back == weights).all() and len(parts) > 2
    assert len(search.tiles(weights[:, :3], 0)) == 1


def test_best_keeps_the_first_of_ties():
    best = search.Best(2, 3, pa.int64())
    best.add(np.array([0, 0, 1, 0]), np.array([5, 7, 1, 5]), pa.array([9, 8, 1, None]))
    best.add(np.array([0, 1, 0]), np.array([5, 2, 4]), pa.array([3, 4, 1]))
    assert list(zip(best.item.tolist(), best.score.tolist(), best.key.to_pylist())) == [(0, 7, 8), (0, 5, 3), (0, 5, 9), (1, 2, 4), (1, 1, 1)]
    assert best.least.tolist() == [5, 0]


# SimHash ---------------------------------------------------------------------------


def plain_fingerprint(text):
    own = words(lower(text or ""))
    shingles = [" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_near(rows):
    prints = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3).tolist():
            a, b = label[i], label[j]
            if a != b:
                label = [a if x == b else x for x in label]
    least = defaultdict(list)
    for k, (d, _) in zip(label, rows):
        least[k] += [] if d is None else [d]
    return sorted(repr((d, f"{int(p):016x}", min(least[k], default=None))) for (d, _), p, k in zip(rows, prints, label))


def near_rows(df):
    return sorted(repr((r.doc_id, r.fingerprint, r.component_id)) for r in df.collect())


def test_simhash_of_all_cases(spark):
    want = plain_near([r[:2] for r in cases.rows()])
    assert near_rows(simhash.near(cases.documents(spark))) == want
    assert any("'0000000000000000', 4)" in w for w in want)
    assert simhash.near(cases.nothing(spark)).count() == 0


def test_simhash_of_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    want = plain_near(rows)
    assert near_rows(simhash.op13_simhash(spark, sf_dir)) == want
    assert sum(w.split(",")[0][1:] != w.rsplit(" ", 1)[1][:-1] for w in want) > 5


def prints_with_neighbours(seed=1, n=300):
    rng = np.random.default_rng(seed)
    out = [0, 7, 2**64 - 1]
    for v in rng.integers(0, 2**63, n).tolist():
        v = v * 2 if v % 3 else v % (1 << 40)  # a third of them deep in one corner of the trie
        for flips in (0, 1, 3, 4, 6):
            for k in rng.integers(0, 64, flips).tolist():
                v ^= 1 << k
            out.append(v)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("direct", [1, 32])
def test_trie_join_finds_every_pair(monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    monkeypatch.setattr(simhash, "FRONTIER", 100)
    x = prints_with_neighbours()
    differing = np.bitwise_count(x[:, None] ^ x[None, :])
    want = {(i, j) for i, j in zip(*np.nonzero(differing <= 3)) if i < j}
    got = [(i, j) for a, b in simhash.close_pairs(x, x, True) for i, j in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    a, b = x[x < 1 << 63], x[x >= 1 << 63]
    got = {(i, j + len(a)) for p, q in simhash.close_pairs(a, b, False, 1) for i, j in zip(p.tolist(), q.tolist())}
    assert got == {(i, j) for i, j in want if i < len(a) <= j}


def test_upper_levels_agree_with_one_task(spark):
    """Small leaves: Spark expands node pairs over many levels, and loses no component."""
    from prairie.operators.graph import components

    x = prints_with_neighbours(2, 120)
    df = spark.createDataFrame([(v,) for v in x.view(np.int64).tolist()], "fp long")
    groups = []
    for leaf in (4, 1 << 15):
        roots = components(simhash.edges(df, leaf=leaf), "x", "y").collect()
        members = defaultdict(set)
        for r in roots:
            members[r.root].add(r.node)
        groups.append(sorted(map(sorted, members.values())))
    assert groups[0] == groups[1] and len(groups[0]) > 50


def test_an_edge_for_each_member_not_for_each_pair():
    dense = np.array([sum(1 << k for k in range(12) if i >> k & 1) for i in range(4096)], np.uint64)
    x, y = simhash.linked(dense, None)
    assert len(x) == 4095 and set(y.tolist()) == {0}


def test_added_columns_are_made_of_few_rows_at_a_time(spark):
    """A task that turns texts into Python strings does so for some rows of a batch only."""
    import pyarrow as pa
    from prairie.llm.batches import add_columns

    def begin():
        return lambda batch: {"seen": pa.array([batch.num_rows] * batch.num_rows, pa.int64()), "twice": [2 * t.as_py() for t in batch.column("t")]}

    rows = spark.range(1000).selectExpr("id", "cast(id as string) t").coalesce(1)
    got = add_columns(rows, "seen long, twice string", begin, drop=("t",), most=64).collect()
    assert sorted((r.id, r.twice) for r in got) == [(i, 2 * str(i)) for i in range(1000)]
    assert max(r.seen for r in got) == 64
    assert {r.seen for r in add_columns(rows, "seen long, twice string", begin).collect()} == {1000}


def test_free_memory_of_a_worker_goes_back():
    """Texts that lie between small objects that stay leave holes, which the allocator keeps unless told."""
    import re

    from prairie.llm.batches import give_back

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Private_Dirty:\s+(\d+)", f.read())[1]) / 1024

    texts, stay = [], []
    for _ in range(4000):
        texts.append(b"x" * 40_000)
        stay.append(b"y" * 600)
    full = held()
    texts.clear()
    give_back()
    assert held() < full - 80 and len(stay) == 4000


def test_idle_encoder_gives_its_pieces_up(monkeypatch):
    import time

    from prairie.llm import tokens

    monkeypatch.setattr(tokens, "IDLE", 0.3)
    monkeypatch.setattr(tokens, "_HELD", {})
    encoder = tokens.Encoder(tokens.vocabulary(), 0)
    text = ["some words, behind blanks\nand lines"]
    first = encoder.encode(text)
    assert len(encoder.worker.spaced) > 3
    time.sleep(1.5)
    assert not encoder.worker.spaced and not encoder.worker.first and not encoder.worker.watched
    assert encoder.encode(text) == first and len(encoder.worker.spaced) > 3
