"""Registered queries for loading, checking, cleaning and describing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillscope.functions.columns import finite_or_zero
from tillscope.operators import cleaning, distributions, neighbours, quality
from tillscope.plans.sql_parts import TXN
from tillscope.plans.views import rounded, table, transactions

# Prices below this count as unknown: a natural small share of missing values.
UNKNOWN_BELOW = 20000
_RAW = f"""raw AS (SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderpriority AS priority,
  CASE WHEN o_totalprice < {UNKNOWN_BELOW} THEN NULL ELSE o_totalprice END AS total_price FROM orders)"""
_LABELLED = """lab AS (SELECT doc_id, lang, n_chars, quality, toxic, CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END AS verdict
  FROM documents LEFT JOIN labels USING (doc_id))"""


def raw_orders(spark, d):
    """Orders as they come: mixed-case names, an empty column, every row twice, some prices unknown."""
    o = table(spark, d, "orders")
    price = F.when(F.col("o_totalprice") >= UNKNOWN_BELOW, F.col("o_totalprice"))
    one = o.select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("Customer (ID)"), F.col("o_orderpriority").alias("Priority"), price.alias("Total Price"), F.lit(None).cast("double").alias("Empty")
    )
    return one.unionAll(one)


def labelled(spark, d):
    verdict = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad")
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, d, "labels"), "doc_id", "left").withColumn("verdict", verdict)


def items(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_clean(spark, d):
    out = cleaning.clean(raw_orders(spark, d))
    return rounded(out.withColumnRenamed("customer_id", "customer"), 4)


def _outliers(method, treatment, threshold=3.0):
    def query(spark, d):
        out = cleaning.handle_outliers(transactions(spark, d).select("transaction_id", "amount"), ["amount"], method, threshold, treatment)
        return rounded(out, 6)

    return query


def _scaled(method):
    def query(spark, d):
        df = items(spark, d)
        return rounded(cleaning.fit_scaler(df, NUMBERS, method).apply(df), 6)

    return query


def q_inverse(spark, d):
    df = items(spark, d)
    s = cleaning.fit_scaler(df, NUMBERS, "standard")
    return rounded(s.invert(s.apply(df)), 2)


def _imputed(numeric):
    def query(spark, d):
        df = labelled(spark, d)
        fill = cleaning.fit_impute(df, numeric, columns=["quality", "toxic", "verdict"])
        return rounded(cleaning.impute(df, fill).select("doc_id", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic"), "verdict"))

    return query


def q_impute_nearest(spark, d):
    """Nulls of n_chars, quality and toxic filled from the 5 nearest documents (nan-Euclidean), exactly, over all documents."""
    df = labelled(spark, d).select("doc_id", *[F.col(c).cast("double").alias(c) for c in _NEAREST])
    return rounded(neighbours.fill_nearest(df, "doc_id", _NEAREST, 5))


_NEAREST = ["n_chars", "quality", "toxic"]


def _nearest_sql() -> str:
    both = lambda c: f"(q.{c} IS NOT NULL AND o.{c} IS NOT NULL)"
    shared = " + ".join(f"CAST({both(c)} AS INTEGER)" for c in _NEAREST)
    square = " + ".join(f"CASE WHEN {both(c)} THEN (q.{c} - o.{c}) * (q.{c} - o.{c}) ELSE 0 END" for c in _NEAREST)
    fills = ",\n".join(
        f"f_{c} AS (SELECT q, avg(v) AS v FROM (SELECT q, o.{c} AS v, row_number() OVER (PARTITION BY q ORDER BY d, o) AS r FROM pairs JOIN lab o ON o.doc_id = pairs.o WHERE o.{c} IS NOT NULL) WHERE r <= 5 GROUP BY q)"
        for c in _NEAREST
    )
    cols = ", ".join(f"round(coalesce(lab.{c}, f_{c}.v, (SELECT avg({c}) FROM lab)), 6) + 0.0 AS {c}" for c in _NEAREST)
    joins = " ".join(f"LEFT JOIN f_{c} ON f_{c}.q = lab.doc_id" for c in _NEAREST)
    return (
        f"WITH lab AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, CAST(quality AS DOUBLE) AS quality, CAST(toxic AS DOUBLE) AS toxic FROM documents LEFT JOIN labels USING (doc_id)),\n"
        f"pairs AS (SELECT q.doc_id AS q, o.doc_id AS o, sqrt({len(_NEAREST)}.0 / ({shared}) * ({square})) AS d FROM lab q JOIN lab o ON q.doc_id <> o.doc_id WHERE ({shared}) > 0),\n"
        f"{fills}\nSELECT lab.doc_id, {cols} FROM lab {joins}"
    )


def q_label(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return rounded(cleaning.encode(df, ["o_orderpriority", "o_orderstatus"], "label", tie="o_orderkey"))


def q_onehot(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return rounded(cleaning.encode(df, ["o_orderstatus"], "onehot"))


def q_zeroed(spark, d):
    df = labelled(spark, d)
    return rounded(df.select("doc_id", finite_or_zero("quality").alias("quality"), finite_or_zero(F.try_divide(F.col("n_chars"), F.col("toxic"))).alias("ratio")))


def q_validation(spark, d):
    out = quality.validation_report(labelled(spark, d))
    return rounded(out.drop("type"))


def q_numeric_summary(spark, d):
    return rounded(quality.numeric_summary(labelled(spark, d), ["n_chars", "quality", "toxic"]), 4)


def q_text_summary(spark, d):
    return rounded(quality.text_summary(table(spark, d, "part"), ["p_brand", "p_type"]))


def q_joined(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return rounded(quality.merge(o, c, "c_custkey", "left", "many_to_one"), 2)


def q_outer(spark, d):
    a = table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))
    b = labelled(spark, d).where(F.col("toxic") == 1).groupBy("lang").agg(F.count(F.lit(1)).alias("toxic_documents"))
    return rounded(quality.merge(a, b, "lang", "outer", "one_to_one"))


def q_drift(spark, d):
    t = transactions(spark, d).withColumn("hour", F.hour("timestamp"))
    middle = F.lit("2024-01-16").cast("timestamp")
    out = distributions.data_drift(t.where(F.col("timestamp") < middle), t.where(F.col("timestamp") >= middle), ["amount", "hour", "customer_id"])
    return rounded(out.select("feature", "ks_statistic"))


def q_drift_flags(spark, d):
    t = items(spark, d).withColumn("total", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    out = distributions.data_drift(t.where("l_linenumber <= 2"), t.where("l_linenumber > 2"), ["l_quantity", "total", "l_linenumber"])
    return rounded(out)


def q_correlation(spark, d):
    return rounded(distributions.correlations(items(spark, d), NUMBERS))


def q_histogram(spark, d):
    return rounded(distributions.histogram(transactions(spark, d), "amount"), 6)


_FENCE = {
    "zscore": "SELECT avg(amount) - 3 * stddev_pop(amount) AS lo, avg(amount) + 3 * stddev_pop(amount) AS hi FROM txn",
    "iqr": "SELECT q[1] - 3 * (q[2] - q[1]) AS lo, q[2] + 3 * (q[2] - q[1]) AS hi FROM (SELECT quantile_cont(amount, [0.25, 0.75]) AS q FROM txn)",
    "percentile": "SELECT quantile_cont(amount, 0.01) AS lo, quantile_cont(amount, 0.99) AS hi FROM txn",
}


def _fences(method: str) -> str:
    return f"WITH {TXN}, f AS ({_FENCE[method]}), b AS (SELECT min(amount) AS a, max(amount) AS z FROM txn, f WHERE amount BETWEEN lo AND hi)"


def _clip(method: str) -> str:
    limits = ("lo", "hi") if method == "iqr" else ("a", "z")
    return f"{_fences(method)} SELECT transaction_id, round(least(greatest(amount, {limits[0]}), {limits[1]}), 6) AS amount FROM txn, f, b"


_REMOVE = " SELECT transaction_id, round(amount, 6) AS amount FROM txn, f WHERE amount BETWEEN lo AND hi"
_BLANK = " SELECT transaction_id, CASE WHEN amount BETWEEN lo AND hi THEN round(amount, 6) END AS amount FROM txn, f"
_SCALE = {
    "standard": "(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ())",
    "minmax": "(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()))",
    "robust": "(({c} - {c}_q[2]) / ({c}_q[3] - {c}_q[1]))",
}


def _scale_sql(method: str) -> str:
    extra = ", (SELECT " + ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS {c}_q" for c in NUMBERS) + " FROM lineitem)" if method == "robust" else ""
    return "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, " + ", ".join(f"round({_SCALE[method].replace('{c}', c)}, 6) + 0.0 AS {c}" for c in NUMBERS) + f" FROM lineitem{extra}"


def _impute_sql(f: str) -> str:
    mode = "(SELECT {c} FROM lab WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    value = {"mean": "(SELECT avg({c}) FROM lab)", "median": "(SELECT CAST(median({c}) AS DOUBLE) FROM lab)", "most_frequent": mode}[f]
    number = lambda c: f"round(CAST(coalesce({c}, {value.replace('{c}', c)}) AS DOUBLE), 6) AS {c}"
    return f"WITH {_LABELLED} SELECT doc_id, {number('quality')}, {number('toxic')}, coalesce(verdict, {mode.replace('{c}', 'verdict')}) AS verdict FROM lab"


def _validation_sql() -> str:
    part = (
        "SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS \"rows\", CAST(count(*) - count({c}) AS BIGINT) AS nulls, round((count(*) - count({c})) * 1.0 / count(*), 6) AS null_share, "
        "CAST((count(*) - count({c})) * 1.0 / count(*) > 0.3 AS BIGINT) AS too_many_nulls, CAST(count(*) >= 30 AS BIGINT) AS enough_rows FROM lab"
    )
    return f"WITH {_LABELLED} " + " UNION ALL ".join(part.replace("{c}", c) for c in ("doc_id", "lang", "n_chars", "quality", "toxic", "verdict"))


def _summary_sql() -> str:
    part = (
        "SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, CAST(count(*) - count({c}) AS BIGINT) AS nulls, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        "round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS median, "
        "round(quantile_cont({c}, 0.75), 4) AS q75 FROM lab"
    )
    return f"WITH {_LABELLED} " + " UNION ALL ".join(part.replace("{c}", c) for c in ("n_chars", "quality", "toxic"))


def _text_sql() -> str:
    part = (
        "SELECT '{c}' AS \"column\", place, value, count, distinct_values FROM (SELECT {c} AS value, CAST(count(*) AS BIGINT) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS BIGINT) AS place, "
        "CAST(count(*) OVER () AS BIGINT) AS distinct_values FROM part GROUP BY {c}) WHERE place <= 5"
    )
    return " UNION ALL ".join(part.replace("{c}", c) for c in ("p_brand", "p_type"))


def _ks_sql(source: str, late: str, features: dict[str, str], extra: str = "") -> str:
    part = (
        "SELECT '{n}' AS feature, max(abs(ce * 1.0 / te - cl * 1.0 / tl)) AS ks_statistic, max(te) AS te, max(tl) AS tl FROM (SELECT v, sum(e) OVER (ORDER BY v) AS ce, sum(l) OVER (ORDER BY v) AS cl, sum(e) OVER () AS te, sum(l) OVER () AS tl "
        "FROM (SELECT {e} AS v, sum(CASE WHEN {late} THEN 0 ELSE 1 END) AS e, sum(CASE WHEN {late} THEN 1 ELSE 0 END) AS l FROM {s} GROUP BY 1))"
    )
    return " UNION ALL ".join(part.replace("{n}", n).replace("{e}", e).replace("{late}", late).replace("{s}", source) for n, e in features.items())


_DRIFT_TERMS = "list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * t2)))"

QUERIES = {
    "clean_orders": (
        q_clean,
        f"WITH {_RAW} SELECT order_key, customer_id AS customer, priority, round(coalesce(total_price, (SELECT median(total_price) FROM raw)), 4) AS total_price FROM raw",
    ),
    **{f"outliers_clip_{m}": (_outliers(m, "clip"), _clip(m)) for m in _FENCE},
    **{f"outliers_remove_{m}": (_outliers(m, "remove"), _fences(m) + _REMOVE) for m in _FENCE},
    "outliers_blank_iqr": (_outliers("iqr", "nan"), _fences("iqr") + _BLANK),
    **{f"scale_{m}": (_scaled(m), _scale_sql(m)) for m in _SCALE},
    "scale_inverse": (q_inverse, "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(l_quantity, 2) AS l_quantity, round(l_extendedprice, 2) AS l_extendedprice, round(l_discount, 2) AS l_discount, round(l_tax, 2) AS l_tax FROM lineitem"),
    **{f"impute_{m}": (_imputed(m), _impute_sql(m)) for m in ("mean", "median", "most_frequent")},
    "impute_nearest": (q_impute_nearest, _nearest_sql()),
    "label_encode": (
        q_label,
        "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS BIGINT) AS o_orderstatus FROM orders",
    ),
    "onehot": (
        q_onehot,
        "SELECT o_orderkey, CAST(o_orderstatus = 'O' AS BIGINT) AS \"o_orderstatus_O\", CAST(o_orderstatus = 'P' AS BIGINT) AS \"o_orderstatus_P\" FROM orders",
    ),
    "zero_fill": (q_zeroed, f"WITH {_LABELLED} SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS quality, round(coalesce(n_chars / nullif(toxic, 0), 0.0), 6) AS ratio FROM lab"),
    "validation_report": (q_validation, _validation_sql()),
    "numeric_summary": (q_numeric_summary, _summary_sql()),
    "text_summary": (q_text_summary, _text_sql()),
    "join_checked": (q_joined, "SELECT o_orderkey, o_custkey AS c_custkey, round(o_totalprice, 2) AS o_totalprice, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey"),
    "join_outer": (
        q_outer,
        f"WITH {_LABELLED}, a AS (SELECT lang, CAST(count(*) AS BIGINT) AS documents FROM lab GROUP BY lang), b AS (SELECT lang, CAST(count(*) AS BIGINT) AS toxic_documents FROM lab WHERE toxic = 1 GROUP BY lang) "
        "SELECT lang, documents, toxic_documents FROM a FULL JOIN b USING (lang)",
    ),
    "ks_drift": (
        q_drift,
        f"WITH {TXN}, k AS ({_ks_sql('txn', chr(34) + 'timestamp' + chr(34) + ' >= TIMESTAMP ' + chr(39) + '2024-01-16' + chr(39), {'amount': 'amount', 'hour': 'hour(' + chr(34) + 'timestamp' + chr(34) + ')', 'customer_id': 'customer_id'})}) "
        "SELECT feature, round(ks_statistic, 6) AS ks_statistic FROM k",
    ),
    "ks_drift_flags": (
        q_drift_flags,
        f"WITH k AS ({_ks_sql('lineitem', 'l_linenumber > 2', {'l_quantity': 'l_quantity', 'total': 'l_extendedprice * (1 - l_discount)', 'l_linenumber': 'l_linenumber'})}), "
        "t AS (SELECT feature, ks_statistic, ks_statistic * ks_statistic * te * tl / (te + tl) AS t2 FROM k), "
        f"p AS (SELECT feature, ks_statistic, CASE WHEN t2 < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, {_DRIFT_TERMS})) END AS p_value FROM t) "
        "SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value, CAST(p_value < 0.05 AS BIGINT) AS is_drifted FROM p",
    ),
    "correlation": (
        q_correlation,
        " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a in NUMBERS for b in NUMBERS if a != b)
        + " UNION ALL "
        + " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{a}' AS column_b, round(corr({a}, {a}), 6) + 0.0 AS r FROM lineitem" for a in NUMBERS),
    ),
    "histogram": (
        q_histogram,
        f"WITH {TXN}, r AS (SELECT min(amount) AS lo, max(amount) AS hi FROM txn), c AS (SELECT least(CAST(floor((amount - lo) / (hi - lo) * 50) AS BIGINT), 49) AS bin, count(*) AS n FROM txn, r GROUP BY 1), "
        "g AS (SELECT range AS bin FROM range(50)) SELECT g.bin, round(lo + g.bin * ((hi - lo) / 50), 6) AS bin_start, round(lo + (g.bin + 1) * ((hi - lo) / 50), 6) AS bin_end, CAST(coalesce(n, 0) AS BIGINT) AS count FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin",
    ),
}
