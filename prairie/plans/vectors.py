"""Words, vocabularies and vectors of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from prairie.functions.text import run_lengths, words_ascii, words_lowered
from prairie.operators import ranking
from prairie.operators import vectors as v
from prairie.session import stored
from prairie.session import table as T

SIZE = v.SIZE  # words of the vocabulary, here and in the SQL
#: Words that carry no topic.
STOP_WORDS = ("a", "and", "as", "at", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with")


def _docs(s, d):
    return T(s, d, "documents").select("doc_id", "text", "source", "lang")


def _counts(s, d):
    return v.word_count(_docs(s, d), words_ascii("text"))


def _vocab(s, d):
    return v.vocabulary(_counts(s, d), SIZE)


def _corpus(s, d):
    return v.corpus(_docs(s, d), "doc_id", words_ascii("text"), SIZE)


def _rounded(df, *columns):
    return df.select(*(F.round(c, 8).alias(c) if c in columns else c for c in df.columns))


def sparse_counts(s, d):
    """Vectors as maps, one row per document, compared as text."""
    c = _corpus(s, d)
    rows = v.gathered(c.long, c.bags, "doc_id", "cnt")
    text = F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["idx"], e["v"].cast("long"))), ",")
    return rows.select("doc_id", text.alias("entries"))


def index_sets(s, d):
    c = _corpus(s, d)
    rows = v.gathered(c.long, c.bags, "doc_id", "cnt")
    return rows.select("doc_id", F.size("entries").cast("long").alias("n"), F.array_join(F.transform("entries", lambda e: e["idx"]), ",").alias("indices"))


def item_vectors(s, d, c):
    """Benchmark texts as vectors over the documents' vocabulary and frequencies."""
    long = v.indexed(T(s, d, "benchmark"), "item_id", words_ascii("text"), c.vocab)
    return v.tfidf_norm(long, "item_id", c.frequency(), c.n)


def moments(s, d):
    c = _corpus(s, d)
    return _rounded(v.moments(c.tfidf_raw(), c.n), "mean", "std")


def standardised(s, d):
    c = _corpus(s, d)
    raw = stored(c.tfidf_raw(), "tfidf")
    return _rounded(v.standardised(raw, "doc_id", v.moments(raw, c.n)), "v")


def with_category(s, d):
    """Vectors with the category of their path: the middle part of source/lang/id."""
    from prairie.functions.scalars import path_part

    docs = _docs(s, d).withColumn("category", path_part(F.concat_ws("/", "source", "lang", "doc_id")))
    # The category goes along with the words, so that the long table is never joined.
    return v.corpus(docs, "doc_id", words_ascii("text"), SIZE, keep=("category",)).long.where("doc_id IS NOT NULL")


def scaled(s, d):
    c = _corpus(s, d)
    return _rounded(v.scaled(c.long, "doc_id", c.vocab.select("idx", (1 / F.sqrt("n")).alias("f"))), "v")


def run_length_counts(s, d):
    return _docs(s, d).select("doc_id", F.explode(run_lengths(words_lowered("text"))).alias("w")).select("doc_id", "w.word", "w.cnt")


QUERIES = {
    "g8_word_count": _counts,
    "o3_top_words": lambda s, d: _counts(s, d).orderBy(F.desc("n"), "word").limit(SIZE),
    "o4_top_counts": lambda s, d: _counts(s, d).orderBy(F.desc("n")).limit(SIZE).select("n"),
    "o5_last_words": lambda s, d: ranking.top_k(_vocab(s, d), 10, "word", "idx").select("word", "idx"),
    "o10_first_words": lambda s, d: _counts(s, d).orderBy("word").limit(10),
    "w3_c1_vocabulary": _vocab,
    "w3_word_ranks": lambda s, d: v.all_ranks(_counts(s, d)),
    "c1_word_ranks": lambda s, d: v.word_ranks(_vocab(s, d), ["the", "and", "no such word"]),
    "j16_index_tokens": lambda s, d: _corpus(s, d).long,
    "m1_word_counts_in_row": run_length_counts,
    "m2_sparse_counts": sparse_counts,
    "m3_index_sets": index_sets,
    "m4_p12_nonzero_entries": lambda s, d: _corpus(s, d).tfidf_raw().where("doc_id = 3").select("idx", F.round("v", 8).alias("v")).orderBy("idx"),
    "m5_scaled": scaled,
    "g9_document_frequency": lambda s, d: _corpus(s, d).frequency(),
    "c2_tfidf_norm": lambda s, d: _rounded(_corpus(s, d).tfidf_norm(), "v"),
    "c3_tfidf_raw": lambda s, d: _rounded(_corpus(s, d).tfidf_raw(), "v"),
    "g10_moments": moments,
    "c4_standardised": standardised,
    "c5_new_texts": lambda s, d: _rounded(item_vectors(s, d, _corpus(s, d)), "v"),
    "c6_with_category": with_category,
    "p13_without_stop_words": lambda s, d: _vocab(s, d).where(~F.col("word").isin(*STOP_WORDS)).select("word", "idx"),
}

_W = "(SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda x: lower(x))) AS word FROM documents)"
_C = f"(SELECT word, count(*) AS n FROM {_W} GROUP BY 1)"
_V = f"(SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS idx FROM {_C} ORDER BY n DESC, word LIMIT {SIZE})"
_L = f"(SELECT doc_id, idx, count(*) AS cnt FROM {_W} JOIN {_V} USING (word) GROUP BY 1, 2)"
_WITH = f"""WITH vocab AS MATERIALIZED {_V}, l AS MATERIALIZED (SELECT doc_id, idx, count(*) AS cnt FROM {_W} JOIN vocab USING (word) GROUP BY 1, 2),
df AS MATERIALIZED (SELECT idx, count(*) AS df FROM l GROUP BY 1), n AS (SELECT count(*) AS docs FROM documents),
norm AS MATERIALIZED (SELECT doc_id, idx, cnt / sum(cnt) OVER (PARTITION BY doc_id) * log10(docs::DOUBLE / df) AS v FROM l JOIN df USING (idx), n),
raw AS MATERIALIZED (SELECT doc_id, idx, cnt * ln(docs::DOUBLE / df) AS v FROM l JOIN df USING (idx), n WHERE df < docs),
stats AS MATERIALIZED (SELECT idx, mean, CASE WHEN std < 1e-12 THEN 0.0 ELSE std END AS std FROM (SELECT idx, sum(v) / any_value(docs) AS mean,
  sqrt(greatest(sum(v * v) / any_value(docs) - (sum(v) / any_value(docs)) ** 2, 0.0)) AS std FROM raw, n GROUP BY 1)) """
SQL = {
    "g8_word_count": f"SELECT * FROM {_C}",
    "o3_top_words": f"SELECT * FROM {_C} ORDER BY n DESC, word LIMIT {SIZE}",
    "o4_top_counts": f"SELECT n FROM {_C} ORDER BY n DESC LIMIT {SIZE}",
    "o5_last_words": f"SELECT word, idx FROM {_V} ORDER BY word DESC LIMIT 10",
    "o10_first_words": f"SELECT * FROM {_C} ORDER BY word LIMIT 10",
    "w3_c1_vocabulary": f"SELECT * FROM {_V}",
    "w3_word_ranks": f"SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS idx FROM {_C}",
    "c1_word_ranks": f"SELECT word, coalesce(idx, -1) AS idx FROM (VALUES ('the'), ('and'), ('no such word')) AS q(word) LEFT JOIN {_V} USING (word)",
    "j16_index_tokens": f"{_WITH} SELECT * FROM l",
    "m1_word_counts_in_row": "SELECT doc_id, word, count(*) AS cnt FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1, 2",
    "m2_sparse_counts": f"{_WITH} SELECT doc_id, coalesce(string_agg(idx || ':' || cnt, ',' ORDER BY idx), '') AS entries FROM documents LEFT JOIN l USING (doc_id) GROUP BY 1",
    "m3_index_sets": f"{_WITH} SELECT doc_id, count(idx) AS n, coalesce(string_agg(idx::VARCHAR, ',' ORDER BY idx), '') AS indices FROM documents LEFT JOIN l USING (doc_id) GROUP BY 1",
    "m4_p12_nonzero_entries": f"{_WITH} SELECT idx, round(v, 8) AS v FROM raw WHERE doc_id = 3",
    "m5_scaled": f"{_WITH} SELECT doc_id, idx, round(cnt / sqrt(n), 8) AS v FROM l JOIN vocab USING (idx)",
    "g9_document_frequency": f"{_WITH} SELECT * FROM df",
    "c2_tfidf_norm": f"{_WITH} SELECT doc_id, idx, round(v, 8) AS v FROM norm",
    "c3_tfidf_raw": f"{_WITH} SELECT doc_id, idx, round(v, 8) AS v FROM raw",
    "g10_moments": f"{_WITH} SELECT idx, round(mean, 8) AS mean, round(std, 8) AS std FROM stats",
    "c4_standardised": f"{_WITH} SELECT doc_id, idx, round((v - mean) / std, 8) AS v FROM raw JOIN stats USING (idx) WHERE std > 0",
    "c5_new_texts": f"{_WITH}, q AS (SELECT item_id, idx, count(*) AS cnt FROM (SELECT item_id, unnest(list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda x: lower(x))) AS word FROM benchmark) JOIN vocab USING (word) GROUP BY 1, 2) SELECT item_id, idx, round(cnt / sum(cnt) OVER (PARTITION BY item_id) * log10(docs::DOUBLE / df), 8) AS v FROM q JOIN df USING (idx), n",
    "c6_with_category": f"{_WITH} SELECT doc_id, idx, cnt, lang AS category FROM l JOIN documents USING (doc_id)",
    "p13_without_stop_words": f"SELECT word, idx FROM {_V} WHERE word NOT IN {STOP_WORDS}",
}
