"""Secret scan by trigram indexes.

A Boolean query over trigrams is derived from each rule's regular expression: every match of
the expression must satisfy it. The texts of a batch (a segment) are indexed by the trigrams
that the queries name: a postings bitmap for each trigram, over the segment's texts. A query
is answered by uniting and intersecting postings, and only the candidates that remain are
searched by the expression itself. A rule whose query says nothing scans every text.

Segments are indexed and searched where they are read: no text is shuffled, and the memory
of a task is that of one batch.

Defined results: a null text is an empty one and has no spans; repeated rows are searched
each; the other columns of the input are kept out of the way of any name; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.llm.batches import add_columns
from prairie.llm.columns import quoted
from prairie.session import table

MOST_STRINGS = 64  # of an exact set, before it is turned into trigrams
ANY = ("any",)


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those stay whose group ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    either_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    # Runs of fewer than 32 characters would fail: leaving them out of the expression drops the same matches.
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = ("assign", "access", "hex")


# Queries ---------------------------------------------------------------------------

def _both(a: tuple, b: tuple) -> tuple:
    return b if a == ANY else a if b == ANY else ("and", a, b)


def _either(queries: list[tuple]) -> tuple:
    if not queries or ANY in queries:
        return ANY
    return queries[0] if len(queries) == 1 else ("or", *queries)


def _needs(strings: set[str]) -> tuple:
    """Any of the strings occurs."""
    each = []
    for s in sorted(strings):
        grams = sorted({s[i : i + 3] for i in range(len(s) - 2)})
        each.append(ANY if not grams else ("and", *grams) if len(grams) > 1 else grams[0])
    return _either(each)


def _walk(nodes) -> tuple[set[str] | None, tuple]:
    """(all strings that the nodes can match, or None if too many; a query each match satisfies)."""
    exact: set[str] | None = {""}
    known: set[str] = {""}  # strings of which one ends where the walk is
    query = ANY
    for op, arg in nodes:
        strings, own = _one(op, arg)
        if strings is not None and len(strings) * len(known) <= MOST_STRINGS:
            known = {a + b for a in known for b in strings}
            continue
        exact = None
        query = _both(_both(query, _needs(known)), own)
        known = {""}
    if exact is None:
        return None, _both(query, _needs(known))
    return known, _needs(known)


def _one(op, arg) -> tuple[set[str] | None, tuple]:
    if op is sre.LITERAL:
        # Texts are indexed with ASCII letters lowered; other characters as they are.
        return {_fold(chr(arg))}, ANY
    if op is sre.IN:
        chars: set[str] = set()
        for kind, what in arg:
            if kind is sre.LITERAL:
                chars.add(_fold(chr(what)))
            elif kind is sre.RANGE and what[1] - what[0] < MOST_STRINGS:
                chars |= {_fold(chr(c)) for c in range(what[0], what[1] + 1)}
            else:
                return None, ANY
        return (chars, ANY) if len(chars) <= 8 else (None, ANY)
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        found = [_walk(branch) for branch in arg[1]]
        if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MOST_STRINGS:
            return set().union(*(s for s, _ in found)), ANY
        return None, _either([q for _, q in found])
    if op is sre.AT:
        return {""}, ANY
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, body = arg
        strings, own = _walk(body)
        if strings is not None and high == 1 and low == 0:
            return strings | {""}, ANY
        if strings is not None and high == low == 1:
            return strings, ANY
        if strings is not None and len(strings) == 1 and low == high and low <= 16:
            return {next(iter(strings)) * low}, ANY
        return None, own if low else ANY
    return None, ANY


def _fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def trigram_query(rule: Rule) -> tuple:
    """``ANY``, a trigram, or ``("and" | "or", query, ...)``; trigrams are of folded text."""
    return _walk(parser.parse(rule.pattern, re.ASCII))[1]


def trigrams(query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set().union(*map(trigrams, query[1:])) if query != ANY else set()


# Segments --------------------------------------------------------------------------

class Segment:
    """Postings of the given trigrams over some texts: bitmaps, one bit for each text."""

    def __init__(self, bodies: list[bytes], grams: list[str]):
        self.texts = len(bodies)
        self.slot = {g: i for i, g in enumerate(grams)}
        self.postings = np.zeros((len(grams), self.texts), bool)
        codes = np.zeros(1 << 24, np.uint16)
        for g, i in self.slot.items():
            a, b, c = g.encode("latin-1")
            codes[a << 16 | b << 8 | c] = i + 1
        lengths = np.fromiter(map(len, bodies), np.int64, self.texts)
        ends = (lengths + 1).cumsum()  # a zero byte ends each text
        first = 0
        while first < self.texts:  # some megabytes at a time
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (4 << 20), "right")))
            part = np.frombuffer(b"\0".join(bodies[first:last]) + b"\0\0\0", np.uint8).astype(np.uint32)
            found = codes[(part[:-2] << 16) | (part[1:-1] << 8) | part[2:]]
            at = np.flatnonzero(found)
            base = ends[first - 1] if first else 0
            self.postings[found[at] - 1, np.searchsorted(ends, at + base, "right")] = True
            first = last

    def candidates(self, query) -> np.ndarray:
        if query == ANY:
            return np.ones(self.texts, bool)
        if isinstance(query, str):
            return self.postings[self.slot[query]]
        parts = [self.candidates(q) for q in query[1:]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)


def _spans(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key`` and ``spans``: kind number (place in ``rules``), start, end in code points.

    One row for each row of ``docs``, spans by start and then kind; within a kind they are
    the leftmost matches that do not overlap.
    """
    queries = [trigram_query(rule) for rule in rules]
    grams = sorted(set().union(*map(trigrams, queries)))
    if any(ord(c) > 127 for g in grams for c in g):
        raise ValueError("rules must be written in ASCII")

    def begin():
        patterns = [rule.compiled() for rule in rules]

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            segment = Segment([t.encode("utf-8", "surrogatepass").lower() for t in texts], grams)
            found: list[list] = [[] for _ in texts]
            for kind, (rule, pattern, query) in enumerate(zip(rules, patterns, queries)):
                for i in np.flatnonzero(segment.candidates(query)):
                    found[i] += [(start, kind, end) for start, end in _spans(rule, pattern, texts[i])]
            return {"spans": [[{"kind": k, "start": a, "end": b} for a, k, b in sorted(f)] for f in found]}

        return make

    rows = docs.select(quoted(key).alias("_key"), quoted(text).alias("_text"))
    found = add_columns(rows, "spans array<struct<kind:int,start:int,end:int>>", begin, drop=("_text",))
    return found.withColumnRenamed("_key", key)


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    names = F.array(*(F.lit(rule.kind) for rule in RULES))
    base = [i for i, rule in enumerate(RULES) if rule.kind in BASE]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")

    def count(kind: str):
        number = next(i for i, rule in enumerate(RULES) if rule.kind == kind)
        return F.size(F.filter("spans", lambda s: s.kind == number)).cast("long").alias(f"n_{kind}")

    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(count, BASE),
        F.sha2(joined(F.filter("spans", lambda s: s.kind.isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _sql() -> str:
    """Matches and the text between them give the places: lengths are summed up."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(RULES):
        pattern = quoted(("(?i)" if r.either_case else "") + r.pattern)
        parts.append(
            f"SELECT r, {i} AS k, {quoted(r.kind)} AS kind, {r.least} AS least, regexp_extract_all(t, {pattern}) AS m, "
            f"regexp_extract_all(t, {pattern}, {r.group}) AS g, regexp_split_to_array(t, {pattern}) AS b FROM d WHERE regexp_matches(t, {pattern})"
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
a AS ({" UNION ALL ".join(parts)}),
e AS (SELECT r, k, kind, least, m, g, b, unnest(range(1, len(m) + 1)) AS i FROM a),
s AS (
  SELECT r, k, kind, list_sum(list_transform(list_slice(b, 1, i), lambda x: length(x)))
    + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0) AS start, length(m[i]) AS n
  FROM e WHERE length(g[i]) >= least),
j AS (
  SELECT r, count(*) FILTER (WHERE k = 0) AS n0, count(*) FILTER (WHERE k = 1) AS n1, count(*) FILTER (WHERE k = 2) AS n2,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, k) FILTER (WHERE k <= 2) AS base,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, k) AS spans
  FROM s GROUP BY r)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (r)"""


QUERIES = {"op1_secrets": op1_secrets}
SQL = {"op1_secrets": _sql()}
