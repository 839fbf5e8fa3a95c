"""Quota audit queries over ``events`` as a call log.

Fixture: key = ``user_id``; an 'error' event is an HTTP failure (429 / 500 / 404
by ``event_id % 3``) with a body that may mention quota; other events are 200.
Models for the priority pick are the click / view / purchase streams.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quota as Q
from tessera.plans.registry import register
from tessera.sources.tables import events

RPM = 1
RPD = 3
# priority, model name, requests per day, event type standing for its calls
MODELS = [(1, "alpha", 60, "click"), (2, "beta", 70, "view"), (3, "gamma", 80, "purchase")]


def call_log(spark, sf):
    e = events(spark, sf)
    k = F.col("event_id")
    status = F.when(F.col("event_type") == "error", F.element_at(F.array(F.lit(429), F.lit(500), F.lit(404)), (k % 3 + 1).cast("int"))).otherwise(200)
    body = (
        F.when(k % 2 == 0, "RESOURCE_EXHAUSTED: quota exceeded")
        .when(k % 4 == 1, "Quota exceeded for requests")
        .otherwise("Too many requests")
    )
    return e.select("event_id", "user_id", "ts", "event_type", status.alias("status"), body.alias("body"))


_STATUS_SQL = "CASE WHEN event_type = 'error' THEN [429, 500, 404][event_id % 3 + 1] ELSE 200 END"
_BODY_SQL = (
    "CASE WHEN event_id % 2 = 0 THEN 'RESOURCE_EXHAUSTED: quota exceeded' WHEN event_id % 4 = 1 THEN 'Quota exceeded for requests' "
    "ELSE 'Too many requests' END"
)


@register(
    "call_outcomes",
    f"""SELECT event_id, user_id, status,
  CASE WHEN status = 404 THEN 'not_found' WHEN status = 429 AND contains(lower(body), 'quota') THEN 'quota'
       WHEN status = 429 THEN 'rate_limited' WHEN status >= 500 THEN 'server_error' WHEN status >= 400 THEN 'http_error' ELSE 'ok' END AS outcome_data,
  CASE WHEN status = 429 AND contains(lower(body), 'quota') AND contains(body, 'RESOURCE_EXHAUSTED') THEN 'quota'
       WHEN status = 429 THEN 'rate_limited' WHEN status >= 500 THEN 'server_error' WHEN status >= 400 THEN 'http_error' ELSE 'ok' END AS outcome_template
FROM (SELECT event_id, user_id, {_STATUS_SQL} AS status, {_BODY_SQL} AS body FROM events)""",
)
def call_outcomes(spark, sf):
    c = call_log(spark, sf)
    return c.select(
        "event_id", "user_id", "status",
        Q.call_outcome("status", "body", "data").alias("outcome_data"),
        Q.call_outcome("status", "body", "template").alias("outcome_template"),
    )


@register(
    "rate_minute",
    f"""SELECT event_id, user_id, n_last_minute, n_last_minute > {RPM} AS over_rpm FROM (
  SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
         RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS n_last_minute FROM events)""",
)
def rate_minute(spark, sf):
    """Calls per user in the trailing minute (strictly < 60 s back) vs rpm."""
    c = call_log(spark, sf).select("event_id", "user_id", "ts")
    t = Q.trailing_count(c, "user_id", "ts", out_col="n_last_minute")
    return t.select("event_id", "user_id", "n_last_minute", (F.col("n_last_minute") > RPM).alias("over_rpm"))


@register(
    "quota_daily",
    f"""SELECT user_id, day, n_day, CAST(sum(n_day) OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS n_cumulative,
  n_day >= {RPD} AS exhausted_daily, sum(n_day) OVER (PARTITION BY user_id ORDER BY day) >= {RPD} AS exhausted_no_reset
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_day FROM events GROUP BY 1, 2)""",
)
def quota_daily(spark, sf):
    """Per UTC day (template/effect scripts reset daily) and cumulative (the
    data scripts never reset) against rpd."""
    d = Q.daily_counts(call_log(spark, sf), "user_id", "ts")
    return d.select(
        "user_id", "day", "n_day", "n_cumulative",
        (F.col("n_day") >= RPD).alias("exhausted_daily"), (F.col("n_cumulative") >= RPD).alias("exhausted_no_reset"),
    )


_MODELS_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"({p}, '{n}', {r}, '{t}')" for p, n, r, t in MODELS) + ") v(priority, name, rpd, event_type))"


@register(
    "fallback_pick",
    f"""WITH d AS (SELECT m.name, m.priority, m.rpd, CAST(e.ts AS DATE) AS day, count(*) AS n_day
           FROM events e JOIN {_MODELS_SQL} m USING (event_type) GROUP BY ALL),
     spent AS (SELECT day, list(name) AS s FROM d WHERE n_day >= rpd GROUP BY day),
     days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
SELECT days.day, list_filter([{', '.join(f"'{n}'" for _, n, _, _ in sorted(MODELS))}], lambda m: NOT list_contains(coalesce(s, []), m))[1] AS picked,
  CAST(coalesce(len(s), 0) AS BIGINT) AS n_spent
FROM days LEFT JOIN spent USING (day)""",
)
def fallback_pick(spark, sf):
    """Per day, first model by priority still under its daily limit."""
    c = call_log(spark, sf)
    dim = spark.createDataFrame([(n, t) for _, n, _, t in MODELS], "name string, event_type string")
    calls = c.join(F.broadcast(dim), "event_type")  # 3-row dimension
    daily = calls.groupBy("name", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_day"))
    days = c.select(F.to_date("ts").alias("day")).distinct()
    return Q.priority_pick(daily, days, [(p, n, r) for p, n, r, _ in MODELS])


@register(
    "quota_calls",
    f"""SELECT event_id, user_id, CAST(ts AS DATE) AS day,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY epoch_us(ts), event_id) AS call_no,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY epoch_us(ts), event_id) > {RPD} AS refused
FROM events""",
)
def quota_calls(spark, sf):
    """E10 per call: ordinal of each call within its (user, UTC day) and whether a
    daily limit of RPD would have refused it. The rank is bucketed (time ranges
    inside the group), so a hot user-day is spread over many tasks."""
    from tessera.operators.ordering import range_rank

    c = call_log(spark, sf).select("event_id", "user_id", F.to_date("ts").alias("day"), F.unix_micros("ts").alias("us"))
    r = range_rank(c, "us", ["user_id", "day"], ["event_id"], rank_col="call_no")
    return r.select("event_id", "user_id", "day", "call_no", (F.col("call_no") > RPD).alias("refused"))


_NAMES_SQL = "[" + ", ".join(f"'{n}'" for _, n, _, _ in sorted(MODELS)) + "]"


@register(
    "fallback_calls",
    f"""WITH c AS (SELECT event_id, epoch_us(ts) AS us, CAST(ts AS DATE) AS day, {_NAMES_SQL}[event_id % 3 + 1] AS name,
        {_STATUS_SQL} = 429 AND contains({_BODY_SQL}, 'RESOURCE_EXHAUSTED') AS refused FROM events),
     n AS (SELECT *, row_number() OVER (PARTITION BY name, day ORDER BY us, event_id) AS call_no FROM c),
     s AS (SELECT n.day, n.name, min(us) AS since FROM n JOIN {_MODELS_SQL} m USING (name) WHERE call_no >= rpd OR refused GROUP BY ALL),
     p AS (SELECT event_id, c.day, m.name, m.priority FROM c CROSS JOIN {_MODELS_SQL} m LEFT JOIN s ON s.day = c.day AND s.name = m.name
           WHERE s.since IS NULL OR s.since >= c.us)
SELECT c.event_id, c.day, min_by(p.name, p.priority) AS picked, CAST({len(MODELS)} - count(p.name) AS BIGINT) AS n_spent
FROM c LEFT JOIN p USING (event_id) GROUP BY c.event_id, c.day""",
)
def fallback_calls(spark, sf):
    """E11 per call, with the exhausted mark: a model is out for the rest of a day after its last allowed call or its
    first quota refusal (template mode); the call goes to the first model that is not. Fixture: a call's model by id."""
    models = [(p, n, r) for p, n, r, _ in MODELS]
    names = F.array(*[F.lit(n) for _, n, _ in sorted(models)])
    c = call_log(spark, sf).withColumn("name", F.element_at(names, (F.col("event_id") % 3 + 1).cast("int")))
    c = c.select("event_id", "ts", "name", Q.call_outcome("status", "body", "template").alias("outcome"))
    picked = Q.pick_at(c.select("event_id", "ts"), Q.spent_since(c, "outcome", models), models)
    return picked.select("event_id", F.to_date("ts").alias("day"), "picked", "n_spent")
