"""Registered queries that compare customer segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillscope.operators import rfm, segments
from tillscope.plans.sql_parts import PURCHASES, SEGS, long_of, rfm_of, scores_of, segments_of
from tillscope.plans.views import purchases, rounded, scored_customers
from tillscope.session import materialize

FEATURES = ["recency", "frequency", "monetary"]
TARGET = "Champions"
SNAPSHOT = "1998-04-01"


def snapshots(spark, d):
    p = purchases(spark, d)
    early = materialize(rfm.rfm(p.where(F.col("date") < F.lit(SNAPSHOT).cast("timestamp"))))
    before = rfm.rfm_segments(rfm.rfm_scores(early))
    return before, scored_customers(spark, d)


def in_cents(df):
    return df.withColumn("monetary", F.round(F.col("monetary") * 100) / 100)


def _profiles(spark, d):
    return segments.profile_table(in_cents(scored_customers(spark, d)), "segment", FEATURES)


def q_migration_matrix(spark, d):
    before, after = snapshots(spark, d)
    names = [r[0] for r in rfm.SEGMENT_RULES] + [rfm.LAST_SEGMENT]
    out = segments.migration_matrix(segments.migration(before, after, "customer_id", "segment"), names)
    return rounded(out.select("segment_before", *[F.col(f"`{n}`").alias(n.lower().replace(" ", "_")) for n in [*names, "All"]]))


_MIGRATION = f"""{PURCHASES}, early AS (SELECT * FROM purchases WHERE date < TIMESTAMP '{SNAPSHOT}'),
{rfm_of('early', 'rfm_b')}, {scores_of('rfm_b', 'scored_b')}, {segments_of('scored_b', 'before_s')},
{rfm_of('purchases')}, {scores_of('rfm')}, {segments_of('scored')},
moved AS (SELECT b.segment AS segment_before, a.segment AS segment_after FROM before_s b JOIN segs a USING (customer_id)),
cells AS (SELECT coalesce(segment_before, 'All') AS segment_before, coalesce(segment_after, 'All') AS segment_after, CAST(count(*) AS BIGINT) AS customers FROM moved GROUP BY CUBE (segment_before, segment_after))"""
_NAMES = [r[0] for r in rfm.SEGMENT_RULES] + [rfm.LAST_SEGMENT]
_LONG = long_of("segs", "segment", FEATURES)
_AVG_RANK = """rk AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY feature) AS n FROM long),
ties AS (SELECT feature, sum(CAST(c AS DOUBLE) ** 3 - c) AS t FROM (SELECT feature, value, count(*) AS c FROM long GROUP BY 1, 2) GROUP BY 1)"""
_PROF = f"""prof AS (SELECT segment, count(*) AS size, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percentage, avg(recency) AS r, avg(frequency) AS f, avg(round(monetary, 2)) AS m FROM segs GROUP BY segment),
med AS (SELECT quantile_cont(r, 0.5) AS r0, quantile_cont(f, 0.5) AS f0, quantile_cont(m, 0.5) AS m0 FROM prof)"""

QUERIES = {
    "segment_sizes": (
        lambda s, d: rounded(segments.segment_sizes(scored_customers(s, d), "segment")),
        f"WITH {SEGS}, c AS (SELECT segment, count(*) AS n FROM segs GROUP BY 1) SELECT segment, CAST(n AS BIGINT) AS count, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS percentage, "
        "round(sum(n) OVER (ORDER BY n DESC, segment ROWS UNBOUNDED PRECEDING) * 100.0::DOUBLE / sum(n) OVER (), 6) AS cumulative_pct FROM c",
    ),
    "segment_stats": (
        lambda s, d: rounded(segments.segment_statistics(scored_customers(s, d), "segment", FEATURES), 4),
        f"WITH {SEGS}, {_LONG} SELECT segment, feature, CAST(count(value) AS BIGINT) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min, round(max(value), 4) AS max, "
        "round(skewness(value), 4) + 0.0 AS skewness, round(kurtosis(value), 4) + 0.0 AS kurtosis, round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q75 FROM long GROUP BY segment, feature",
    ),
    "segment_value": (
        lambda s, d: rounded(segments.segment_value(in_cents(scored_customers(s, d)), "segment", "monetary", "frequency"), 3, total_revenue=2),
        f"WITH {SEGS} SELECT segment, round(sum(m), 2) AS total_revenue, round(avg(m), 3) AS avg_revenue, CAST(count(*) AS BIGINT) AS customer_count, round(avg(frequency), 3) AS avg_frequency, round(median(m), 3) AS median_revenue, "
        "round(sum(m) / sum(sum(m)) OVER () * 100, 3) AS revenue_share, round(sum(m) / count(*), 3) AS revenue_per_customer, round(avg(m) * avg(frequency), 3) AS clv_proxy FROM (SELECT *, round(monetary, 2) AS m FROM segs) GROUP BY segment",
    ),
    "feature_importance": (
        lambda s, d: rounded(segments.feature_importance(scored_customers(s, d), "segment", FEATURES), 6, between_variance=0, within_variance=0),
        f"WITH {SEGS}, {_LONG}, p AS (SELECT feature, segment, avg(value) AS m, var_samp(value) AS v FROM long GROUP BY 1, 2) SELECT feature, round(var_samp(m), 0) AS between_variance, round(avg(v), 0) AS within_variance, "
        "round(stddev_samp(m) / (avg(m) + 1e-10), 6) AS coefficient_of_variation, round(CASE WHEN avg(v) > 0 THEN var_samp(m) / avg(v) ELSE 0 END, 6) AS f_ratio FROM p GROUP BY feature",
    ),
    "segment_extremes": (
        lambda s, d: rounded(segments.segment_extremes(scored_customers(s, d), "segment", FEATURES)),
        f"WITH {SEGS}, {_LONG}, p AS (SELECT feature, segment, avg(value) AS m FROM long GROUP BY 1, 2) SELECT feature, arg_max(segment, m) AS highest, arg_min(segment, m) AS lowest FROM p GROUP BY feature",
    ),
    "migration": (
        lambda s, d: rounded(segments.migration(*snapshots(s, d), "customer_id", "segment")),
        f"WITH {_MIGRATION} SELECT * FROM cells",
    ),
    "migration_matrix": (
        q_migration_matrix,
        f"WITH {_MIGRATION} SELECT segment_before, " + ", ".join(f"CAST(coalesce(sum(customers) FILTER (segment_after = '{n}'), 0) AS BIGINT) AS {n.lower().replace(' ', '_') if n != 'All' else chr(34) + 'all' + chr(34)}" for n in [*_NAMES, "All"]) + " FROM cells GROUP BY segment_before",
    ),
    "kruskal": (
        lambda s, d: rounded(segments.kruskal_wallis(scored_customers(s, d), "segment", FEATURES).select("feature", "kruskal_h_statistic"), 4),
        f"WITH {SEGS}, {_LONG}, {_AVG_RANK}, g AS (SELECT feature, segment, count(*) AS k, sum(r) AS s, max(n) AS n FROM rk GROUP BY 1, 2), "
        "h AS (SELECT feature, 12.0 * sum(s * s / k) / (max(n) * (max(n) + 1.0)) - 3 * (max(n) + 1) AS h, max(n) AS n FROM g GROUP BY 1) "
        "SELECT feature, round(h / (1 - t / (CAST(n AS DOUBLE) ** 3 - n)), 4) AS kruskal_h_statistic FROM h JOIN ties USING (feature)",
    ),
    "drivers": (
        lambda s, d: rounded(segments.segment_drivers(scored_customers(s, d), "segment", FEATURES, TARGET).drop("p_value"), 4),
        f"WITH {SEGS}, {_LONG}, {_AVG_RANK}, a AS (SELECT feature, avg(value) FILTER (segment = '{TARGET}') AS tm, avg(value) FILTER (segment <> '{TARGET}') AS om, stddev_samp(value) FILTER (segment = '{TARGET}') AS ts, stddev_samp(value) FILTER (segment <> '{TARGET}') AS os, "
        f"count(*) FILTER (segment = '{TARGET}') AS na, sum(r) FILTER (segment = '{TARGET}') AS rs FROM rk GROUP BY 1) SELECT feature, round(tm, 4) AS target_mean, round(om, 4) AS other_mean, round(tm - om, 4) AS difference, round((tm - om) / (om + 1e-10) * 100, 4) AS difference_pct, "
        "round((tm - om) / sqrt((ts ** 2 + os ** 2) / 2), 4) AS effect_size, round(CAST(rs - na * (na + 1) / 2.0 AS DOUBLE), 4) AS u_statistic FROM a",
    ),
    "overlap": (
        lambda s, d: rounded(segments.segment_overlap(in_cents(scored_customers(s, d)), "segment", FEATURES), 6),
        f"WITH {SEGS.replace('sum(amount) AS monetary', 'round(sum(amount), 2) AS monetary')}, {_LONG}, sp AS (SELECT feature, segment, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1, 2), "
        "pr AS (SELECT a.feature, a.segment AS sa, b.segment AS sb, least(a.lo, b.lo) AS lo, greatest(a.hi, b.hi) AS hi FROM sp a JOIN sp b ON a.feature = b.feature AND a.segment <> b.segment), "
        "hs AS (SELECT pr.feature, sa, sb, least(CAST(floor((value - lo) / (hi - lo) * 49) AS BIGINT), 48) AS bin, count(*) FILTER (segment = sa) AS ka, count(*) FILTER (segment = sb) AS kb FROM pr JOIN long ON long.feature = pr.feature AND (long.segment = sa OR long.segment = sb) GROUP BY 1, 2, 3, 4), "
        "bc AS (SELECT feature, sa, sb, sum(sqrt(pa * pb)) AS bc FROM (SELECT *, ka * 1.0::DOUBLE / sum(ka) OVER w AS pa, kb * 1.0::DOUBLE / sum(kb) OVER w AS pb FROM hs WINDOW w AS (PARTITION BY feature, sa, sb)) GROUP BY 1, 2, 3) "
        "SELECT sa AS segment_a, sb AS segment_b, round(avg(bc), 6) AS overlap FROM bc GROUP BY 1, 2 UNION ALL SELECT segment, segment, 1.0::DOUBLE FROM segs GROUP BY segment",
    ),
    "segment_profile_table": (
        lambda s, d: rounded(_profiles(s, d), 4),
        f"WITH {SEGS.replace('sum(amount) AS monetary', 'round(sum(amount), 2) AS monetary')} SELECT segment, CAST(count(*) AS BIGINT) AS size, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS percentage, "
        + ", ".join(f"round(avg({c}), 4) AS avg_{c}, round(stddev_samp({c}), 4) AS std_{c}, round(CAST(median({c}) AS DOUBLE), 4) AS median_{c}" for c in FEATURES)
        + " FROM segs GROUP BY segment",
    ),
    "names_by_value": (
        lambda s, d: segments.cluster_names(_profiles(s, d), "segment", "value"),
        f"WITH {SEGS}, {_PROF} SELECT segment, coalesce(['Premium', 'High Value', 'Medium Value', 'Low Value', 'Budget', 'Minimal'][row_number() OVER (ORDER BY m DESC, segment)], 'Segment_' || segment) AS name FROM prof",
    ),
    "names_by_rfm": (
        lambda s, d: segments.cluster_names(_profiles(s, d), "segment", "rfm"),
        f"WITH {SEGS}, {_PROF} SELECT segment, CASE WHEN m > m0 AND f > f0 THEN 'Champions' WHEN m > m0 THEN 'Big Spenders' WHEN f > f0 THEN 'Loyal' WHEN r < r0 THEN 'Recent' ELSE 'At Risk' END AS name FROM prof, med",
    ),
    "campaigns": (
        lambda s, d: segments.campaign_texts(_profiles(s, d), "segment"),
        f"WITH {SEGS}, {_PROF}, o AS (SELECT *, row_number() OVER (ORDER BY m DESC, segment) AS place FROM prof, med) SELECT CAST(place AS BIGINT) AS place, segment, "
        "printf('%s, %d customers (%.1f%%): ', segment, size, percentage) || CASE WHEN place = 1 THEN printf('retain, mean money %.2f', m) "
        "WHEN f > f0 THEN printf('widen the basket, mean purchases %.1f', f) WHEN r < r0 THEN printf('welcome, mean days since purchase %.0f', r) "
        "ELSE printf('win back, mean days since purchase %.0f', r) END AS recommendation FROM o",
    ),
    "personas": (
        lambda s, d: segments.personas(_profiles(s, d), "segment"),
        f"WITH {SEGS}, {_PROF} SELECT segment, printf('%s, %d customers, %.1f%%: ', segment, size, percentage) || concat_ws(', ', CASE WHEN r < r0 * 0.5 THEN 'bought lately' WHEN r < r0 THEN 'bought recently' WHEN r > r0 * 1.5 THEN 'long absent' ELSE 'some time absent' END, "
        "CASE WHEN f > f0 * 1.5 THEN 'buys often' WHEN f < f0 * 0.5 THEN 'buys rarely' END, CASE WHEN m > m0 * 2 THEN 'spends much' WHEN m > m0 THEN 'spends above the median' WHEN m < m0 * 0.5 THEN 'spends little' END) "
        "|| printf('; money %.2f, purchases %.1f, days %.0f', m, f, r) AS persona FROM prof, med",
    ),
    "segment_summary": (
        lambda s, d: rounded(segments.summary_text(scored_customers(s, d), "segment", FEATURES)),
        f"WITH {SEGS}, {_LONG}, c AS (SELECT segment, count(*) AS n FROM segs GROUP BY 1), x AS (SELECT feature, arg_max(segment, m) AS hi, arg_min(segment, m) AS lo FROM (SELECT feature, segment, avg(value) AS m FROM long GROUP BY 1, 2) GROUP BY 1), "
        "t AS (SELECT sum(n) AS all_n, count(*) AS k FROM c) SELECT 1::BIGINT AS section, 0::BIGINT AS place, 'segments' AS line UNION ALL SELECT 1, 1, format('customers: {:,}', CAST(all_n AS BIGINT)) FROM t UNION ALL SELECT 1, 2, printf('segments: %d', k) FROM t "
        "UNION ALL SELECT 1, 3, 'features: 3' UNION ALL SELECT 2, row_number() OVER (ORDER BY n DESC, segment), segment || ': ' || format('{:,}', n) || printf(' (%.1f%%)', n * 100.0::DOUBLE / all_n) FROM c, t "
        "UNION ALL SELECT 3, list_position(['recency', 'frequency', 'monetary'], feature), printf('%s: most in %s, least in %s', feature, hi, lo) FROM x",
    ),
}
