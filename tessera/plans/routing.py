"""Routing jobs: hard rule, danger tagging, confirmation tiers, quote stripping,
model budgets and the batch request handler (B27-B31, B36, F5, G10, D11).

Fixtures: requests are the user turns of ``conversations``; the hard-rule phrase
list is a parameter (the reference's phrases never occur in this prose); drafted
shell commands come from a fixed list of test commands assigned to events and
requests by id; the answers of the code/direct branches are the wrapped
conversation texts of ``plans.responses``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import routing as R
from tessera.functions import text as T
from tessera.functions.fmt import sql_fmt
from tessera.plans import fixtures as X
from tessera.plans import sql as S
from tessera.plans.registry import register
from tessera.plans.responses import _ANSWER
from tessera.sources.tables import table

FIXTURE_KEYWORDS = ["onan", "que ", "nicht", "ouen"]
# Test commands (our own) covering every danger pattern, quoting and safe commands.
COMMANDS = [
    "ls -la", "rm -rf /tmp/build", "rm -rf *", "rm -rf ~/old", "git push origin main --force",
    "git push -f origin dev", "git reset --hard HEAD~1", "git clean -fd", ":(){ :|:& };:",
    "mkfs.ext4 /dev/sdb1", "dd if=/dev/zero of=/dev/sda bs=1M", "chmod -R 777 /var/www", "npm start",
    "pip install requests", '"git status"', "'ls -la'", '"rm -rf /"', "  \"echo hi'  ", "''", "'\"quoted\"'",
]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CMDS_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"({i}, {_q(c)})" for i, c in enumerate(COMMANDS)) + ") v(idx, cmd))"


def commands_dim(spark) -> DataFrame:
    """Fixed 20-row dimension: broadcast is size-bounded by construction."""
    return F.broadcast(spark.createDataFrame(list(enumerate(COMMANDS)), "idx long, cmd string"))


def event_commands(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", (F.col("event_id") % len(COMMANDS)).alias("idx"))
    return e.join(commands_dim(spark), "idx").drop("idx")


_EV_CMDS_SQL = f"(SELECT e.event_id, c.cmd FROM events e JOIN {_CMDS_SQL} c ON e.event_id % {len(COMMANDS)} = c.idx)"


def _sql_danger(x):
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, {_q(R.python_pattern(p))}) THEN {_q(r)}" for p, r in R.DANGEROUS_PATTERNS) + " END"


def _sql_paired(x):
    c = S.strip(x)
    return (
        f"CASE WHEN length({c}) >= 2 AND left({c}, 1) = right({c}, 1) AND left({c}, 1) IN ('\"', '''') "
        f"THEN {S.strip(f'substr({c}, 2, length({c}) - 2)')} ELSE {c} END"
    )


@register(
    "danger_tags",
    f"SELECT event_id, cmd, {_sql_danger(_sql_paired('cmd'))} IS NOT NULL AS is_dangerous, {_sql_danger(_sql_paired('cmd'))} AS reason FROM {_EV_CMDS_SQL}",
)
def danger_tags(spark, sf):
    """B29 on drafted commands (after B27)."""
    c = event_commands(spark, sf).withColumn("reason", R.danger_reason(R.draft_command("cmd")))
    return c.select("event_id", "cmd", F.col("reason").isNotNull().alias("is_dangerous"), "reason")


@register(
    "confirm_tiers",
    f"""SELECT event_id, CASE WHEN {_sql_danger(_sql_paired('cmd'))} IS NOT NULL THEN '{R.TIER_DANGEROUS}' ELSE '{R.TIER_DEFAULT}' END AS confirm_level,
  {sql_fmt(R.PREVIEW, command=f"coalesce({_sql_paired('cmd')}, '')")} AS preview FROM {_EV_CMDS_SQL}""",
)
def confirm_tiers(spark, sf):
    """B30."""
    c = event_commands(spark, sf).withColumn("d", R.draft_command("cmd"))
    return c.select("event_id", R.confirm_level(R.danger_reason("d")).alias("confirm_level"), R.preview("d").alias("preview"))


@register(
    "quote_strip",
    f"""SELECT event_id, {_sql_paired('cmd')} AS paired,
  regexp_replace(cmd, '^[\"'']+|[\"'']+$', '', 'g') AS all_quotes FROM {_EV_CMDS_SQL}""",
)
def quote_strip(spark, sf):
    """B27 (one paired layer, then strip) and B28 (every quote at both ends)."""
    c = event_commands(spark, sf)
    return c.select("event_id", R.draft_command("cmd").alias("paired"), T.strip_quote_chars("cmd").alias("all_quotes"))


def _sql_kw(x, kws):
    return "(" + " OR ".join(f"contains(lower({x}), {_q(k)})" for k in kws) + ")"


@register(
    "keyword_route",
    f"SELECT conv_id, turn, {_sql_kw('text', FIXTURE_KEYWORDS)} AS is_website, {_sql_kw('text', R.WEBSITE_KEYWORDS)} AS reference_rule "
    f"FROM conversations WHERE role = 'user'",
)
def keyword_route(spark, sf):
    """B31 with the fixture phrase list, and with the reference's phrases."""
    r = table(spark, sf, "conversations").where(F.col("role") == "user")
    return r.select(
        "conv_id", "turn", R.keyword_hit("text", FIXTURE_KEYWORDS).alias("is_website"), R.keyword_hit("text").alias("reference_rule")
    )


def fixture_model_label(text_col: str = "text") -> F.Column:
    """Deterministic stand-in for the classifier head on the SQL-checked path."""
    t = F.col(text_col)
    return F.when(F.length(t) <= 60, "terminal").when(t.contains(","), "code").otherwise("direct")


_MODEL_SQL = "CASE WHEN length(text) <= 60 THEN 'terminal' WHEN contains(text, ',') THEN 'code' ELSE 'direct' END"


def classify(requests: DataFrame, model_label: F.Column, keywords=FIXTURE_KEYWORDS) -> DataFrame:
    """hard rule first, else the model's label; ``source`` records which."""
    hit = R.keyword_hit("text", keywords)
    return requests.withColumn("category", F.when(hit, "website").otherwise(model_label)).withColumn(
        "source", F.when(hit, "hard_rule").otherwise("model")
    )


def route_batch_df(spark, sf) -> DataFrame:
    """One pass over the requests; every branch is a column expression, the
    website branch's template lookup is a left join (C8)."""
    conv = table(spark, sf, "conversations").where(F.col("role") == "user")
    req = classify(conv.selectExpr("*", _ANSWER[-1]), fixture_model_label())
    tpl = X.templates(spark, sf).select(
        F.col("page_id").alias("_pid"), F.coalesce(F.get_json_object("meta", "$.id"), F.col("path")).alias("template_used")
    )
    j = req.join(tpl, (req["conv_id"] == tpl["_pid"]) & (req["category"] == "website"), "left")
    j = j.withColumn("idx", F.col("conv_id") % len(COMMANDS)).join(commands_dim(spark), "idx", "left")
    cat = F.col("category")
    drafted = R.draft_command("cmd")
    reason = R.danger_reason(drafted)
    status = (
        F.when(cat == "website", F.when(F.col("template_used").isNotNull(), "success").otherwise("no_match"))
        .when(cat == "terminal", "awaiting_confirmation")
        .otherwise("success")
    )
    return j.select(
        "conv_id",
        "turn",
        "category",
        "source",
        status.alias("status"),
        "template_used",
        F.when(cat == "terminal", drafted).alias("proposed_command"),
        F.when(cat == "terminal", R.confirm_level(reason)).alias("confirm_level"),
        F.when(cat == "terminal", reason).alias("danger_reason"),
        F.when(cat == "code", F.size(T.code_blocks("answer")).cast("long")).alias("n_code_blocks"),
        F.when(cat == "direct", F.length(T.py_strip("answer")).cast("long")).alias("response_len"),
    )


_ROUTE_SQL = f"""(WITH r AS (SELECT conv_id, turn, text, {_ANSWER[-1]},
      CASE WHEN {_sql_kw('text', FIXTURE_KEYWORDS)} THEN 'website' ELSE {_MODEL_SQL} END AS category,
      CASE WHEN {_sql_kw('text', FIXTURE_KEYWORDS)} THEN 'hard_rule' ELSE 'model' END AS source
    FROM conversations WHERE role = 'user'),
 t AS (SELECT page_id, coalesce(json_extract_string(meta, '$.id'), path) AS tid FROM {X.TEMPLATES_SQL}),
 j AS (SELECT r.*, t.tid AS template_used, c.cmd FROM r LEFT JOIN t ON r.conv_id = t.page_id AND r.category = 'website'
       LEFT JOIN {_CMDS_SQL} c ON r.conv_id % {len(COMMANDS)} = c.idx)
SELECT conv_id, turn, category, source,
  CASE WHEN category = 'website' THEN CASE WHEN template_used IS NOT NULL THEN 'success' ELSE 'no_match' END
       WHEN category = 'terminal' THEN 'awaiting_confirmation' ELSE 'success' END AS status,
  template_used,
  CASE WHEN category = 'terminal' THEN {_sql_paired('cmd')} END AS proposed_command,
  CASE WHEN category = 'terminal' THEN CASE WHEN {_sql_danger(_sql_paired('cmd'))} IS NOT NULL THEN 'strict' ELSE 'confirm' END END AS confirm_level,
  CASE WHEN category = 'terminal' THEN {_sql_danger(_sql_paired('cmd'))} END AS danger_reason,
  CASE WHEN category = 'code' THEN CAST(len(regexp_extract_all(answer, '{T.CODE_BLOCK}', 1)) AS BIGINT) END AS n_code_blocks,
  CASE WHEN category = 'direct' THEN CAST(length({S.strip('answer')}) AS BIGINT) END AS response_len
FROM j)"""


@register("route_batch", f"SELECT * FROM {_ROUTE_SQL}")
def route_batch(spark, sf):
    return route_batch_df(spark, sf)


@register(
    "alias_budget",
    f"""SELECT conv_id, turn, category, m AS model,
  CASE WHEN m IS NULL THEN NULL ELSE CAST(coalesce(MAP {{'router': 300, 'terminal': 100, 'coder': 1500}}[m], 300) AS BIGINT) END AS max_tokens
FROM (SELECT conv_id, turn, category,
  CASE category WHEN 'terminal' THEN 'terminal' WHEN 'code' THEN 'coder' WHEN 'direct' THEN 'router' END AS m FROM {_ROUTE_SQL})""",
)
def alias_budget(spark, sf):
    """Model per routed request (direct -> router alias) and its token budget."""
    r = route_batch_df(spark, sf)
    m = R.model_for("category")
    return r.select("conv_id", "turn", "category", m.alias("model"), F.when(m.isNotNull(), R.max_tokens(m)).alias("max_tokens"))


@register(
    "run_summary",
    f"SELECT category, count(*) AS n_requests, count_if(status = 'success') AS n_success FROM {_ROUTE_SQL} GROUP BY category",
)
def run_summary(spark, sf):
    """Passed / total per category."""
    r = route_batch_df(spark, sf)
    return r.groupBy("category").agg(F.count(F.lit(1)).alias("n_requests"), F.count_if(F.col("status") == "success").alias("n_success"))
