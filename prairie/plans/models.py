"""Regression, neighbours, outliers, co-occurrence and statistics over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from prairie.functions.scalars import prefix_label, sigmoid, snippet
from prairie.functions.text import words_ascii, words_lowered
from prairie.operators import features
from prairie.operators import models as m
from prairie.operators import neighbours as nb
from prairie.operators import products as pr
from prairie.operators import ranking
from prairie.operators import vectors as v
from prairie.plans import vectors as pv
from prairie.session import fresh_path, stored
from prairie.session import table as T


def labelled(s, d):
    """Documents with a label of their quality."""
    labels = T(s, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return T(s, d, "documents").select("doc_id", "text").join(labels, "doc_id")


def training(s, d):
    return labelled(s, d).where("doc_id % 5 <> 0")


def unseen(s, d):
    """A fifth of the labelled documents, which no model is fitted on."""
    return labelled(s, d).where("doc_id % 5 = 0")


def fitted(s, d):
    """The quality model of the training documents, with the operators' defaults."""
    return features.fit(training(s, d), "doc_id", words_ascii("text"), fresh_path(s, "model"))


_MODELS: dict[tuple[str, str], features.TextModel] = {}


def model(s, d):
    """The written model of this folder; queries of one session that only use it share it."""
    place = (s.sparkContext.applicationId, d)
    if place not in _MODELS:
        _MODELS[place] = fitted(s, d)
    return _MODELS[place]


def scores(s, d):
    """The documents that the model has not seen, scored."""
    return model(s, d).scored(unseen(s, d), "doc_id", words_ascii("text"))


def coefficients(s, d):
    """The twenty words with the largest weights, stop words left out."""
    m_ = model(s, d)
    words = m_.vocab.where(~F.col("word").isin(*pv.STOP_WORDS)).join(m_.weights, "idx").where("w > 0")
    return ranking.top_k(words, 20, "w", "idx").select("idx", "word", F.round("w", 6).alias("w"))


def false_positives(s, d):
    """The first three unseen documents that are scored as positive and are not, with a snippet."""
    bad = scores(s, d).where("label = 0 AND p >= 0.5").orderBy("doc_id").limit(3)
    texts = T(s, d, "documents").select("doc_id", snippet("text").alias("snippet"))
    return texts.join(F.broadcast(bad), "doc_id").select("doc_id", F.round("p", 6).alias("p"), "snippet")


def _language_rows(s, d, c):
    """Count vectors of all documents, labelled by their language."""
    docs = T(s, d, "documents").select("doc_id", prefix_label("lang", "fr").alias("label"))
    return v.gathered(c.long, c.bags, "doc_id", "cnt").join(docs, "doc_id")


def gradient(s, d):
    """Gradient and loss at zero weights: one fold over all rows."""
    return m.gradient(_language_rows(s, d, pv._corpus(s, d)), np.zeros(pv.SIZE)).select("idx", F.round("total", 6).alias("total"))


def weighted(s, d):
    """Each document's counts times one over the rank of the word."""
    c = pv._corpus(s, d)
    return m.scored(_language_rows(s, d, c), "doc_id", c.vocab.select("idx", (1 / (F.col("idx") + 1)).alias("w"))).select("doc_id", F.round("z", 6).alias("z"))


def part_scores(s, d):
    """A score for each part from its size and price, and a label from its type."""
    p = sigmoid((F.col("p_size") - 25) / 10)
    return T(s, d, "part").select("p_partkey", (F.col("p_type") == "PROMO").cast("int").alias("label"), F.round(p, 9).alias("p"))


def neighbours(s, d, k=5):
    """The k documents nearest to each benchmark text; every item is a query."""
    c = pv._corpus(s, d)
    asked = v.gathered(pv.item_vectors(s, d, c), T(s, d, "benchmark"), "item_id")
    return nb.nearest(c.norm_vectors(), "doc_id", asked, "item_id", k)


def labels(s, d):
    docs = T(s, d, "documents").select("doc_id", "lang")
    return nb.majority(docs.join(F.broadcast(neighbours(s, d)), "doc_id"), "lang")


def kth(s, d):
    return nb.kth_distances(T(s, d, "embeddings"), "vec_id", "embedding", 10).select("vec_id", "kth")


def baskets(s, d):
    return T(s, d, "lineitem").select("l_orderkey", "l_partkey")


def moments(s, d, by=None):
    return m.line_moments(T(s, d, "lineitem"), "l_quantity", "l_extendedprice", by)


def text_line(s, d):
    """Words of each document, and its characters: a line, nearly."""
    return T(s, d, "documents").select(F.size(words_lowered("text")).cast("double").alias("x"), F.col("n_chars").cast("double").alias("y"))


def text_conditionals(s, d):
    rows = m.line_conditionals(m.line_moments(text_line(s, d), "x", "y"), 6.0, 0.0, 200.0)
    digits = {"shape": 3, "scale": 0, "c_mean": 4, "c_var": 4, "m_mean": 4, "m_var": 8}
    return rows.select(*(F.round(c, n).alias(c) for c, n in digits.items()))


def mixture_rounds(s, d):
    """Three rounds of the mixture."""
    rounds = m.binomial_em(trials(s, d), "heads", "flips", rounds=3)
    return s.createDataFrame([(i + 1, round(a, 9), round(b, 9)) for i, (a, b) in enumerate(rounds)], "round long, a double, b double")


def conditionals(s, d):
    rows = m.line_conditionals(moments(s, d, ["l_returnflag"]), 1500.0, 100.0, 20000.0)
    digits = {"shape": 3, "scale": 0, "c_mean": 4, "c_var": 4, "m_mean": 4, "m_var": 6}
    return rows.select("l_returnflag", *(F.round(c, n).alias(c) for c, n in digits.items()))


def trials(s, d):
    """For each customer: orders, and urgent ones among them."""
    heads = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return T(s, d, "orders").groupBy("o_custkey").agg(heads.alias("heads"), F.count("*").alias("flips"))


def mixture(s, d):
    rounds = m.binomial_em(trials(s, d), "heads", "flips")
    return s.createDataFrame([(i + 1, round(a, 9), round(b, 9)) for i, (a, b) in enumerate(rounds)], "round long, a double, b double")


def mixture_sums(s, d):
    histogram = trials(s, d).groupBy("heads", "flips").agg(F.count("*").alias("n"))
    sums = m.mixture_sums(histogram, 0.79, 0.51)
    return sums.select(*(F.round(c, 6).alias(c) for c in sums.columns))


QUERIES = {
    "c8_logistic_weights": lambda s, d: fitted(s, d).weights.select("idx", F.round("w", 9).alias("w")),
    "c9_logistic_scores": lambda s, d: scores(s, d).select("doc_id", "label", F.round("p", 6).alias("p")),
    "c10_logistic_sweep": lambda s, d: m.rates(m.confusion(scores(s, d))),
    "o7_top_coefficients": coefficients,
    "p15_o9_false_positives": false_positives,
    "g11_gradient": gradient,
    "g14_confusion": lambda s, d: m.confusion(part_scores(s, d)),
    "g23_best_threshold": lambda s, d: m.best_threshold(m.confusion(part_scores(s, d))).select("threshold", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy"))),
    "g20_weighted_sum": weighted,
    "j17_w5_nearest": lambda s, d: neighbours(s, d).select("query", "doc_id", "distance", F.col("rank").cast("long").alias("rank")),
    "c7_g19_knn_label": labels,
    "w4_kth_distance": kth,
    "c13_o6_outliers": lambda s, d: nb.outliers(T(s, d, "embeddings"), "vec_id", "embedding"),
    "c14_outliers_pruned": lambda s, d: nb.pruned_outliers(T(s, d, "embeddings"), "vec_id", "embedding"),
    "c15_g18_j19_co_occurrence": lambda s, d: pr.co_occurrence(baskets(s, d), "l_orderkey", "l_partkey"),
    "m6_co_occurrence_full": lambda s, d: pr.co_occurrence(baskets(s, d), "l_orderkey", "l_partkey", symmetric=True),
    "m7_gram": lambda s, d: pr.gram(T(s, d, "lineitem"), "l_orderkey", "l_partkey", "l_quantity").select("a", "b", F.round("v", 4).alias("v")),
    "g15_line_mse": lambda s, d: m.line_mse(T(s, d, "lineitem"), "l_quantity", "l_extendedprice", 1500.0, 100.0).select(F.round("mse", 1).alias("mse")),
    "g16_line_moments": moments,
    "c16_line_conditionals": conditionals,
    "g15_text_mse": lambda s, d: m.line_mse(text_line(s, d), "x", "y", 6.0, 0.0).select(F.round("mse", 1).alias("mse")),
    "g16_text_moments": lambda s, d: m.line_moments(text_line(s, d), "x", "y"),
    "c16_text_conditionals": text_conditionals,
    "c17_three_rounds": mixture_rounds,
    "g17_mixture_sums": mixture_sums,
    "c17_binomial_em": mixture,
}

_P = "(SELECT p_partkey, (p_type = 'PROMO')::INT AS label, round(1 / (1 + exp(-(p_size - 25) / 10)), 9) AS p FROM part)"
_CONFUSION = f"""(SELECT t.threshold, count(*) FILTER (WHERE label = 1 AND p >= t.threshold) AS tp, count(*) FILTER (WHERE label = 0 AND p >= t.threshold) AS fp,
  count(*) FILTER (WHERE label = 0 AND p < t.threshold) AS tn, count(*) FILTER (WHERE label = 1 AND p < t.threshold) AS fn
  FROM {_P}, (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in m.THRESHOLDS)}]) AS threshold) t GROUP BY 1)"""
_NEAR = pv._WITH + """, q AS (SELECT item_id, idx, cnt / sum(cnt) OVER (PARTITION BY item_id) * log10(docs::DOUBLE / df) AS v FROM (SELECT item_id, idx, count(*) AS cnt FROM
  (SELECT item_id, unnest(list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda x: lower(x))) AS word FROM benchmark) JOIN vocab USING (word) GROUP BY 1, 2) JOIN df USING (idx), n),
qn AS (SELECT b.item_id, coalesce(sum(v * v), 0) AS s FROM benchmark b LEFT JOIN q USING (item_id) GROUP BY 1),
dn AS (SELECT documents.doc_id, coalesce(sum(v * v), 0) AS s FROM documents LEFT JOIN norm USING (doc_id) GROUP BY 1),
dots AS (SELECT item_id, doc_id, sum(q.v * norm.v) AS dot FROM q JOIN norm USING (idx) GROUP BY 1, 2),
far AS (SELECT item_id AS query, doc_id, round(sqrt(greatest(qn.s + dn.s - 2 * coalesce(dot, 0), 0)), 6) AS distance FROM qn CROSS JOIN dn LEFT JOIN dots USING (item_id, doc_id)),
near AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, doc_id) AS rank FROM far QUALIFY rank <= 5) """
_KTH = """(SELECT a AS vec_id, round(d, 6) AS kth FROM (SELECT x.vec_id AS a, list_distance(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) AS d,
  row_number() OVER (PARTITION BY x.vec_id ORDER BY list_distance(x.embedding::DOUBLE[], y.embedding::DOUBLE[])) AS r
  FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id) WHERE r = 10)"""
_SETS = "(SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)"
_CO = f"(SELECT x.l_partkey AS a, y.l_partkey AS b, count(*) AS n FROM {_SETS} x JOIN {_SETS} y USING (l_orderkey) WHERE {{}} GROUP BY 1, 2)"
_M = """SELECT {} count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy, sum(x * x)::DOUBLE AS sxx, sum(x * y)::DOUBLE AS sxy, sum(y * y)::DOUBLE AS syy
  FROM (SELECT l_returnflag, l_quantity::DECIMAL(30,4) AS x, l_extendedprice::DECIMAL(30,4) AS y FROM lineitem)"""
_PMF = "exp(coalesce(list_sum(list_transform(range(1, least(heads, flips - heads) + 1), lambda i: ln((flips - least(heads, flips - heads) + i) / i))), 0) + heads * ln({0}::DOUBLE) + (flips - heads) * ln(1 - {0}::DOUBLE))"
_TEXT = "(SELECT len(regexp_extract_all(lower(text), '[a-z]+'))::DOUBLE AS x, n_chars::DOUBLE AS y FROM documents)"
_TEXT_M = f"(SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy FROM {_TEXT})"
_ROUND = f"""r{{1}} AS MATERIALIZED (SELECT sum(p / (p + q) * heads) / sum(p / (p + q) * flips) AS a, sum(q / (p + q) * heads) / sum(q / (p + q) * flips) AS b
  FROM (SELECT heads, flips, {_PMF.format('a').replace('a::DOUBLE', 'a')} AS p, {_PMF.format('b').replace('b::DOUBLE', 'b')} AS q FROM t, r{{0}}))"""
SQL = {
    "g11_gradient": f"{pv._WITH} SELECT idx, round(sum((0.5 - (lang = 'fr')::INT) * cnt)::DOUBLE, 6) AS total FROM l JOIN documents USING (doc_id) GROUP BY 1 HAVING sum((0.5 - (lang = 'fr')::INT) * cnt) <> 0 UNION ALL SELECT -1, round(count(*) * ln(2.0::DOUBLE), 6) FROM documents UNION ALL SELECT -2, count(*)::DOUBLE FROM documents",
    "g14_confusion": f"SELECT * FROM {_CONFUSION}",
    "g23_best_threshold": f"WITH r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS re FROM {_CONFUSION}), f AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f FROM r) SELECT threshold, round(pr, 6) AS precision, round(re, 6) AS recall, round(f, 6) AS f1, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy FROM f ORDER BY f DESC, threshold LIMIT 1",
    "g20_weighted_sum": f"{pv._WITH} SELECT doc_id, round(coalesce(sum(cnt / (idx + 1)), 0), 6) AS z FROM documents LEFT JOIN l USING (doc_id) GROUP BY 1",
    "j17_w5_nearest": f"{_NEAR} SELECT query, doc_id, distance, rank FROM near",
    "c7_g19_knn_label": f"{_NEAR}, votes AS (SELECT query, lang, count(*) AS votes, min(rank) AS first FROM near JOIN documents USING (doc_id) GROUP BY 1, 2) SELECT query, lang, votes FROM votes QUALIFY row_number() OVER (PARTITION BY query ORDER BY votes DESC, first) = 1",
    "w4_kth_distance": f"SELECT * FROM {_KTH}",
    "c13_o6_outliers": f"SELECT * FROM {_KTH} ORDER BY kth DESC, vec_id LIMIT 5",
    "c14_outliers_pruned": f"SELECT * FROM {_KTH} ORDER BY kth DESC, vec_id LIMIT 5",
    "c15_g18_j19_co_occurrence": f"SELECT * FROM {_CO.format('x.l_partkey <= y.l_partkey')}",
    "m6_co_occurrence_full": f"SELECT * FROM {_CO.format('true')}",
    "m7_gram": "WITH e AS (SELECT l_orderkey AS r, l_partkey AS c, sum(l_quantity::DOUBLE) AS v FROM lineitem GROUP BY 1, 2) SELECT x.c AS a, y.c AS b, round(sum(x.v * y.v), 4) AS v FROM e x JOIN e y USING (r) WHERE x.c <= y.c GROUP BY 1, 2",
    "g15_line_mse": "SELECT round(avg((100.0::DOUBLE + 1500 * l_quantity - l_extendedprice) ** 2), 1) AS mse FROM lineitem",
    "g16_line_moments": _M.format(""),
    "c16_line_conditionals": f"""WITH s AS ({_M.format('l_returnflag,')} GROUP BY 1), v AS (SELECT *, 1 / (1 / 1e4::DOUBLE + n / 4e8::DOUBLE) AS vc, 1 / (1 / 1e2::DOUBLE + sxx / 4e8::DOUBLE) AS vm FROM s)
SELECT l_returnflag, round(10 + n / 2, 3) AS shape, round(1 + (1e4::DOUBLE * n + 2250000.0::DOUBLE * sxx + syy + 300000.0::DOUBLE * sx - 200 * sy - 3000 * sxy) / 2, 0) AS scale,
  round(vc * (50.0::DOUBLE / 1e4::DOUBLE + (sy - 1500 * sx) / 4e8::DOUBLE), 4) AS c_mean, round(vc, 4) AS c_var,
  round(vm * (5.0::DOUBLE / 1e2::DOUBLE + (sxy - 100 * sx) / 4e8::DOUBLE), 4) AS m_mean, round(vm, 6) AS m_var FROM v""",
    "g15_text_mse": f"SELECT round(avg((6 * x - y) ** 2), 1) AS mse FROM {_TEXT}",
    "g16_text_moments": f"SELECT * FROM {_TEXT_M}",
    "c16_text_conditionals": f"""WITH v AS (SELECT *, 1 / (1 / 1e4::DOUBLE + n / 4e4::DOUBLE) AS vc, 1 / (1 / 1e2::DOUBLE + sxx / 4e4::DOUBLE) AS vm FROM {_TEXT_M})
SELECT round(10 + n / 2, 3) AS shape, round(1 + (36 * sxx + syy - 12 * sxy) / 2, 0) AS scale, round(vc * (50.0::DOUBLE / 1e4::DOUBLE + (sy - 6 * sx) / 4e4::DOUBLE), 4) AS c_mean,
  round(vc, 4) AS c_var, round(vm * (5.0::DOUBLE / 1e2::DOUBLE + sxy / 4e4::DOUBLE), 4) AS m_mean, round(vm, 8) AS m_var FROM v""",
    "c17_three_rounds": f"""WITH t AS MATERIALIZED (SELECT count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS heads, count(*) AS flips FROM orders GROUP BY o_custkey),
r0 AS (SELECT 0.79::DOUBLE AS a, 0.51::DOUBLE AS b), {', '.join(_ROUND.format(i, i + 1) for i in range(3))}
SELECT 1 AS round, round(a, 9) AS a, round(b, 9) AS b FROM r1 UNION ALL SELECT 2, round(a, 9), round(b, 9) FROM r2 UNION ALL SELECT 3, round(a, 9), round(b, 9) FROM r3""",
    "g17_mixture_sums": f"""WITH t AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS heads, count(*) AS flips FROM orders GROUP BY 1),
l AS (SELECT heads, flips, {_PMF.format(0.79)} AS a, {_PMF.format(0.51)} AS b FROM t)
SELECT round(sum(a / (a + b) * heads), 6) AS heads_a, round(sum(a / (a + b) * flips), 6) AS flips_a, round(sum(b / (a + b) * heads), 6) AS heads_b, round(sum(b / (a + b) * flips), 6) AS flips_b FROM l""",
}
