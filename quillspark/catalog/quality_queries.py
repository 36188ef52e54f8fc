"""Checks on generated texts, and who generated them when."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.catalog.text_queries import keywords_sql
from quillspark.functions import quality
from quillspark.operators import running, usage


def _either(phrases) -> str:
    return "|".join(re.escape(p) for p in phrases).replace("'", "''").replace(r"\ ", " ").replace(r"\-", "-").replace(r"\#", "#")


def _sets(column: str) -> str:
    return f"(SELECT pair_id, list(w) AS k FROM {keywords_sql('pairs', 'pair_id', column, 10)} GROUP BY pair_id)"


FIRST = " + ".join(f"(CASE WHEN contains(lower(generated), '{w}') THEN 1 ELSE 0 END)" for w in fv.INFORMAL_WORDS)

CHECKED = rf"""{b.PAIRS},
facts AS (
  SELECT p.*, length(original) AS o, length(generated) AS g, lower(generated) AS low,
    ok.k AS ok, coalesce(gk.k, []) AS gk, coalesce(tk.k, []) AS tk,
    {b.sentences('generated')} AS s, {b.words('generated')} AS w,
    len(list_filter(regexp_extract_all(lower(generated), '[\p{{L}}\p{{N}}_]+'),
        lambda r: r IN ({b.quoted(fv.FIRST_PERSON)}))) AS personal
  FROM pairs p LEFT JOIN {_sets('original')} ok ON p.pair_id = ok.pair_id
  LEFT JOIN {_sets('generated')} gk ON p.pair_id = gk.pair_id
  LEFT JOIN {_sets('title')} tk ON p.pair_id = tk.pair_id),
spread AS (SELECT pair_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM facts),
grams AS (SELECT pair_id, lower(word) || ' ' || lead(lower(word)) OVER
          (PARTITION BY pair_id ORDER BY pos) AS gram FROM spread),
most AS (SELECT pair_id, max(n) AS most FROM (SELECT pair_id, gram, count(*) AS n FROM grams
         WHERE gram IS NOT NULL GROUP BY pair_id, gram) GROUP BY pair_id),
checked AS (
  SELECT f.pair_id,
    g BETWEEN floor(o * 0.7::DOUBLE) AND floor(o * 1.3::DOUBLE) AND g BETWEEN 30 AND 8000 AS length_valid,
    ok IS NULL OR len(list_intersect(ok, gk)) / len(ok)::DOUBLE >= 0.2
      OR len(list_intersect(tk, gk)) / greatest(len(tk), 1)::DOUBLE >= 0.2 AS topic_consistent,
    length({b.strip('generated')}) > 0 AS not_empty,
    g >= 30 AS not_too_short,
    NOT regexp_matches(low, '{_either(fv.LEAKAGE_PHRASES)}') AS no_prompt_leakage,
    NOT (len(s) >= 2 AND (len(list_distinct(s)) / len(s)::DOUBLE < 0.8
         OR (len(w) >= 10 AND coalesce(most, 0) > len(w) * 0.1::DOUBLE))) AS no_repetition,
    NOT ((len(w) > 0 AND personal / greatest(len(w), 1)::DOUBLE > 0.05)
         OR ({FIRST}) > 3 OR regexp_matches(low, '{_either(fv.CONVERSATIONAL)}')) AS scientific_style
  FROM facts f LEFT JOIN most m ON f.pair_id = m.pair_id)"""


def checks():
    return quality.quality_checks(F.col("original"), F.col("generated"), F.col("title"))


def _check_query(name):
    @query(f"q_{name}", f"WITH {CHECKED} SELECT pair_id, {name} AS passed FROM checked")
    def run(spark, sf):
        return b.pairs(spark, sf).select("pair_id", checks()[name].alias("passed"))


for _name in quality.CHECKS:
    _check_query(_name)

PASSED_SQL = " + ".join(f"{c}::INTEGER" for c in quality.CHECKS)


@query(
    "quality_gate",
    f"""WITH {CHECKED} SELECT pair_id, ({PASSED_SQL}) >= 5.6 AS lenient,
        not_empty AND no_prompt_leakage AS strict FROM checked""",
)
def _gate(spark, sf):
    judged = b.pairs(spark, sf).select("pair_id", *[c.alias(k) for k, c in checks().items()])
    passed = {c: F.col(c) for c in quality.CHECKS}
    return judged.select(
        "pair_id",
        quality.quality_gate(passed).alias("lenient"),
        quality.quality_gate(passed, strict=True).alias("strict"),
    )


RATES_SQL = ", ".join(f"round(avg({c}::INTEGER), 6) AS {c}" for c in quality.CHECKS)


@query(
    "quality_report",
    f"""WITH {CHECKED}, p AS (SELECT *, 'p' || ({b.draw('pair_id', 'provider')} % 3) AS provider FROM checked)
    SELECT provider, count(*) AS texts, {RATES_SQL}, count(*) FILTER (({PASSED_SQL}) >= 5.6) AS accepted
    FROM p GROUP BY provider""",
)
def _report(spark, sf):
    from quillspark.functions.hashing import draw

    provider = F.concat(F.lit("p"), (draw(42, F.col("pair_id"), "provider") % 3).cast("string"))
    judged = b.pairs(spark, sf).select(
        provider.alias("provider"), *[c.alias(k) for k, c in checks().items()]
    )
    passed = {c: F.col(c) for c in quality.CHECKS}
    return judged.groupBy("provider").agg(
        F.count(F.lit(1)).alias("texts"),
        *[F.round(F.avg(F.col(c).cast("int")), 6).alias(c) for c in quality.CHECKS],
        F.count(F.when(quality.quality_gate(passed), 1)).alias("accepted"),
    )


# --- usage: event types stand for providers ----------------------------------------

TARGETS = {"click": 0.2, "view": 0.28, "purchase": 0.2, "signup": 0.1, "error": 0.2, "idle": 0.02}
LIMITS = {"click": (1, 2), "view": (2, 1), "purchase": (3, 1), "signup": (4, 1), "error": (5, 1)}
TARGETS_SQL = "(VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in TARGETS.items()) + ") t(provider, target)"
LIMITS_SQL = (
    "(VALUES " + ", ".join(f"('{k}', {p}, {n})" for k, (p, n) in LIMITS.items()) + ") t(provider, priority, allowed)"
)


@query(
    "provider_usage",
    f"""SELECT t.provider, coalesce(n, 0)::BIGINT AS requests, round(coalesce(n, 0) / total, 6) AS share, target,
      round(abs(coalesce(n, 0) / total - target), 6) AS deviation,
      CASE WHEN abs(coalesce(n, 0) / total - target) <= 0.05::DOUBLE THEN 'within'
           WHEN abs(coalesce(n, 0) / total - target) <= 0.1::DOUBLE THEN 'near' ELSE 'over' END AS status
    FROM {TARGETS_SQL} LEFT JOIN (SELECT event_type, count(*)::DOUBLE AS n FROM events GROUP BY event_type) e
      ON e.event_type = t.provider, (SELECT count(*)::DOUBLE AS total FROM events)""",
)
def _provider_usage(spark, sf):
    return usage.provider_usage(table(spark, sf, "events").select("event_type"), "event_type", TARGETS)


@query(
    "running_usage_share",
    """SELECT event_id, provider, provider_requests, all_requests,
         round(provider_requests / all_requests::DOUBLE, 6) AS provider_share
       FROM (SELECT event_id, event_type AS provider,
         count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS provider_requests,
         count(*) OVER (ORDER BY ts, event_id) AS all_requests FROM events)""",
)
def _running(spark, sf):
    requests = table(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("provider"))
    out = running.running_usage_share(requests, "provider", ["ts", "event_id"])
    return out.drop("ts").withColumn("provider_share", F.round("provider_share", 6))


def attempts(spark, sf):
    """Each event is one attempt: errors fail, low values miss the quality gate."""
    return table(spark, sf, "events").select(
        "ts",
        F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("provider"),
        (F.col("event_type") != "error").alias("success"),
        (F.col("value") >= 2).alias("quality_ok"),
    )


@query(
    "generation_run_stats",
    """WITH a AS (SELECT ts, 'p' || (user_id % 3) AS provider, event_type <> 'error' AS ok, value >= 2 AS good
                  FROM events)
    SELECT CASE WHEN grouping(provider) = 1 THEN 'all' ELSE provider END AS provider, count(*) AS processed,
      count(*) FILTER (ok AND good) AS successful, count(*) FILTER (NOT ok) AS failed,
      count(*) FILTER (ok AND good) AS quality_passed, count(*) FILTER (ok AND NOT good) AS quality_failed,
      round(count(*) FILTER (ok AND good) / count(*)::DOUBLE, 6) AS success_rate,
      round(count(*) FILTER (ok AND good)::DOUBLE
            / ((epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6) / 60), 6) AS texts_per_minute
    FROM a GROUP BY GROUPING SETS ((provider), ())""",
)
def _run_stats(spark, sf):
    return usage.generation_run_stats(attempts(spark, sf), "ts", "provider")


MINUTE = "strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M')"


def minute(column="window_start"):
    return F.date_format(column, "yyyy-MM-dd HH:mm").alias("window_start")


RATE_SQL = f"""SELECT w AS window_start, provider, requests, allowed::BIGINT AS allowed, requests > allowed AS over_limit
    FROM (SELECT {MINUTE} AS w, event_type, count(*) AS requests FROM events GROUP BY ALL)
    JOIN {LIMITS_SQL} ON event_type = provider"""


@query("rate_window_usage", RATE_SQL)
def _rates(spark, sf):
    limits = {k: n for k, (_, n) in LIMITS.items()}
    events = table(spark, sf, "events").select("ts", "event_type")
    out = usage.rate_window_usage(events, "ts", "event_type", limits)
    return out.withColumn("window_start", minute())


DAILY = {"click": 60, "view": 70, "purchase": 80, "signup": 65, "error": 75}
DAILY_SQL = "(VALUES " + ", ".join(f"('{k}', {n})" for k, n in DAILY.items()) + ") t(provider, allowed)"


@query(
    "daily_limit_usage",
    f"""SELECT w AS window_start, provider, requests, allowed::BIGINT AS allowed, requests > allowed AS over_limit
    FROM (SELECT strftime(ts, '%Y-%m-%d') AS w, event_type, count(*) AS requests FROM events GROUP BY ALL)
    JOIN {DAILY_SQL} ON event_type = provider""",
)
def _daily(spark, sf):
    """The same window report per day, against daily limits."""
    events = table(spark, sf, "events").select("ts", "event_type")
    out = usage.rate_window_usage(events, "ts", "event_type", DAILY, "1 day")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query(
    "provider_by_priority",
    f"""WITH m AS (SELECT {MINUTE} AS w, event_type, count(*) AS n FROM events GROUP BY ALL),
    g AS (SELECT w, t.provider, priority, allowed FROM (SELECT DISTINCT w FROM m), {LIMITS_SQL})
    SELECT g.w AS window_start, min_by(provider, priority) FILTER (coalesce(n, 0) < allowed) AS provider
    FROM g LEFT JOIN m ON g.w = m.w AND g.provider = m.event_type GROUP BY g.w""",
)
def _priority(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_type")
    out = usage.provider_by_priority(events, "ts", "event_type", LIMITS)
    return out.withColumn("window_start", minute())
