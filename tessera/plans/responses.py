"""Model-answer post-processing (B21-B26) and generated-batch parsing.

Fixtures: answers are ``conversations`` texts wrapped by ``turn % 4`` (fenced code,
closed ``<think>``, open ``<think>``, plain); raw batches are documents grouped
25 per batch (the reference's batch size) into JSON arrays with non-string and
blank elements, some fenced and some broken; envelopes wrap document texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.ordering import running_sum
from tessera.plans import sql as S
from tessera.plans.registry import ORACLE, register
from tessera.sources.tables import table

NL = "chr(10)"
_ANSWER = [
    "conv_id",
    "turn",
    f"""CASE turn % 4
  WHEN 0 THEN 'Here is the code:' || {NL} || '```' || CASE WHEN conv_id % 2 = 0 THEN 'python' ELSE '' END || {NL} || text || {NL} || '```' || {NL}
       || CASE WHEN turn % 8 = 4 THEN '```sh' || {NL} || 'ls -la' || {NL} || '```' || {NL} ELSE '' END
       || CASE WHEN conv_id % 5 = 0 THEN '```' || {NL} || 'unclosed' ELSE 'Hope this helps.' END
  WHEN 1 THEN '<think>' || text || '</think>' || {NL} || 'Answer for ' || CAST(conv_id AS STRING)
  WHEN 2 THEN 'Let me think. <think>' || text
  ELSE text END AS answer""",
]


def answers(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").selectExpr(*_ANSWER)


ANSWERS_SQL = f"(SELECT {', '.join(_ANSWER)} FROM conversations)"
P = T.CODE_BLOCK


@register(
    "code_blocks",
    f"""SELECT conv_id, turn, CAST(len(l) AS BIGINT) AS n_blocks,
  array_to_string(list_transform(l, lambda x: CASE WHEN x = '' THEN 'text' ELSE x END), ',') AS languages,
  CAST(coalesce(list_sum(list_transform(c, lambda x: length({S.strip('x')}))), 0) AS BIGINT) AS code_chars,
  {S.strip(f"regexp_replace(answer, '{P}', '', 'g')")} AS explanation
FROM (SELECT *, regexp_extract_all(answer, '{P}', 1) AS l, regexp_extract_all(answer, '{P}', 2) AS c FROM {ANSWERS_SQL})""",
)
def code_blocks(spark, sf):
    """Fenced blocks (language default 'text', code stripped) and the explanation."""
    a = answers(spark, sf).select("conv_id", "turn", T.code_blocks("answer").alias("b"), T.code_explanation("answer").alias("explanation"))
    return a.select(
        "conv_id",
        "turn",
        F.size("b").cast("long").alias("n_blocks"),
        F.array_join(F.col("b.language"), ",").alias("languages"),
        F.aggregate(F.col("b.code"), F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("code_chars"),
        "explanation",
    )


_THINK = "(?s)<think>(.*?)</think>(.*)"


@register(
    "reasoning_split",
    f"""SELECT conv_id, turn, reasoning, answer_text, (answer_text = '' AND reasoning <> '') AS truncated,
  CASE WHEN answer_text <> '' THEN answer_text ELSE answer END AS final_text FROM (
 SELECT conv_id, turn, answer,
  CASE WHEN regexp_matches(answer, '(?s)<think>.*?</think>') THEN {S.strip(f"regexp_extract(answer, '{_THINK}', 1)")}
       WHEN contains(answer, '<think>') THEN {S.strip("substr(answer, strpos(answer, '<think>') + 7)")} ELSE '' END AS reasoning,
  CASE WHEN regexp_matches(answer, '(?s)<think>.*?</think>') THEN {S.strip(f"regexp_extract(answer, '{_THINK}', 2)")}
       WHEN contains(answer, '<think>') THEN '' ELSE {S.strip('answer')} END AS answer_text
 FROM {ANSWERS_SQL})""",
)
def reasoning_split(spark, sf):
    """B22 + B23: (reasoning, answer), out-of-budget flag, answer-or-raw fallback."""
    a = answers(spark, sf).select("conv_id", "turn", "answer", T.split_reasoning("answer").alias("s"))
    return a.select(
        "conv_id",
        "turn",
        F.col("s.reasoning").alias("reasoning"),
        F.col("s.answer").alias("answer_text"),
        ((F.col("s.answer") == "") & (F.col("s.reasoning") != "")).alias("truncated"),
        F.when(F.col("s.answer") != "", F.col("s.answer")).otherwise(F.col("answer")).alias("final_text"),
    )


@register(
    "chat_answers",
    f"""SELECT conv_id, turn, finish_reason, reasoning, CASE WHEN answer_text <> '' THEN answer_text ELSE answer END AS final_text FROM (
 SELECT conv_id, turn, answer, CASE WHEN turn % 3 = 0 THEN 'unknown' WHEN turn % 3 = 1 THEN 'stop' ELSE 'length' END AS finish_reason,
  CASE WHEN regexp_matches(answer, '(?s)<think>.*?</think>') THEN {S.strip(f"regexp_extract(answer, '{_THINK}', 1)")}
       WHEN contains(answer, '<think>') THEN {S.strip("substr(answer, strpos(answer, '<think>') + 7)")} ELSE '' END AS reasoning,
  CASE WHEN regexp_matches(answer, '(?s)<think>.*?</think>') THEN {S.strip(f"regexp_extract(answer, '{_THINK}', 2)")}
       WHEN contains(answer, '<think>') THEN '' ELSE {S.strip('answer')} END AS answer_text
 FROM {ANSWERS_SQL})""",
)
def chat_answers(spark, sf):
    """B6 -> B22 -> B23: chat response -> message content and finish reason -> reasoning and answer-or-raw text.
    Fixture: the answers wrapped as chat responses, every third turn without a finish reason."""
    reason = F.when(F.col("turn") % 3 == 1, "stop").when(F.col("turn") % 3 == 2, "length")
    choice = F.struct(F.struct(F.col("answer").alias("content")).alias("message"), reason.alias("finish_reason"))
    raw = answers(spark, sf).select("conv_id", "turn", F.to_json(F.struct(F.array(choice).alias("choices"))).alias("response"))
    m = raw.select("conv_id", "turn", T.chat_message("response").alias("m")).select("conv_id", "turn", "m.content", "m.finish_reason")
    m = m.withColumn("s", T.split_reasoning("content"))
    final = F.when(F.col("s.answer") != "", F.col("s.answer")).otherwise(F.col("content"))
    return m.select("conv_id", "turn", "finish_reason", F.col("s.reasoning").alias("reasoning"), final.alias("final_text"))


def _count(col: str, sub: str) -> F.Column:
    c = F.col(col)
    return ((F.length(c) - F.length(F.replace(c, F.lit(sub), F.lit("")))) / len(sub)).cast("long")


def _sql_count(col, sub):
    return f"CAST((length({col}) - length(replace({col}, '{sub}', ''))) / {len(sub)} AS BIGINT)"


@register(
    "response_diagnostics",
    f"""SELECT conv_id, turn, CAST(length(answer) AS BIGINT) AS n_chars, contains(answer, '<think>') AS has_think,
  contains(answer, '</think>') AS has_end_think, contains(answer, '###') AS has_heading, contains(answer, '```') AS has_fence,
  contains(answer, 'def ') AS has_def, {_sql_count('answer', '<think>')} AS n_think, {_sql_count('answer', '</think>')} AS n_end_think,
  CASE WHEN contains(answer, '<think>') THEN {_sql_count('answer', '<think>')} = {_sql_count('answer', '</think>')} END AS balanced
FROM {ANSWERS_SQL}""",
)
def response_diagnostics(spark, sf):
    """Length, tag presence, tag counts, balance (only when a <think> exists)."""
    a = answers(spark, sf)
    c = F.col("answer")
    return a.select(
        "conv_id",
        "turn",
        F.length(c).cast("long").alias("n_chars"),
        c.contains("<think>").alias("has_think"),
        c.contains("</think>").alias("has_end_think"),
        c.contains("###").alias("has_heading"),
        c.contains("```").alias("has_fence"),
        c.contains("def ").alias("has_def"),
        _count("answer", "<think>").alias("n_think"),
        _count("answer", "</think>").alias("n_end_think"),
        F.when(c.contains("<think>"), _count("answer", "<think>") == _count("answer", "</think>")).alias("balanced"),
    )


CHUNK = 500


def chunks(df: DataFrame, text_col: str, size: int = CHUNK) -> DataFrame:
    """Fixed-size pieces with 1-based number and [start, end) offsets; an
    empty text yields no chunk. Whole texts are cut, nothing is dropped."""
    n = F.length(text_col)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    e = df.select("*", F.posexplode(starts).alias("_i", "start_off"))
    return e.select(
        *[c for c in df.columns if c != text_col],
        (F.col("_i") + 1).cast("long").alias("chunk_no"),
        F.col("start_off").cast("long").alias("start_off"),
        F.least(F.col("start_off") + size, n).cast("long").alias("end_off"),
        F.col(text_col).substr(F.col("start_off") + 1, F.lit(size)).alias("chunk"),
    )


@register(
    "chunks_500",
    f"""SELECT doc_id, CAST(i // {CHUNK} + 1 AS BIGINT) AS chunk_no, CAST(i AS BIGINT) AS start_off,
  CAST(least(i + {CHUNK}, length(text)) AS BIGINT) AS end_off, md5(substr(text, i + 1, {CHUNK})) AS chunk_md5
FROM (SELECT doc_id, text, unnest(range(0, length(text), {CHUNK})) AS i FROM documents)""",
)
def chunks_500(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    c = chunks(d, "text")
    return c.select("doc_id", "chunk_no", "start_off", "end_off", F.md5("chunk").alias("chunk_md5"))


@register(
    "previews",
    """SELECT conv_id, turn, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS head,
  CASE WHEN length(text) > 200 THEN '...' || substr(text, length(text) - 199) END AS tail FROM conversations""",
)
def previews(spark, sf):
    """B26."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.head_preview("text").alias("head"), T.tail_preview("text").alias("tail"))


# ------------------------------------------------------------------ raw batches
BATCH = 25


def raw_batches(spark, sf, where: str | None = None, by_label: bool = False) -> DataFrame:
    """JSON-array batches of 25 documents (bounded groups; per label when
    ``by_label``). Elements: the text, or a number (doc_id % 9 = 4), a blank
    string (% 11 = 3), an object (% 13 = 6). Batch % 3 = 1 is fenced, % 5 = 2 is
    broken JSON."""
    d = table(spark, sf, "documents").select("doc_id", "text", "n_chars", F.col("lang").alias("label"))
    if where:
        d = d.where(where)
    k = F.col("doc_id")
    as_json = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    elem = (
        F.when(k % 9 == 4, F.col("n_chars").cast("string"))
        .when(k % 11 == 3, F.lit('"   "'))
        .when(k % 13 == 6, F.concat(F.lit('{"x": '), F.col("n_chars").cast("string"), F.lit("}")))
        .otherwise(as_json)
    )
    keys = ["label", "batch_id"] if by_label else ["batch_id"]
    g = d.select("label", (k / BATCH).cast("long").alias("batch_id"), F.struct(k.alias("doc_id"), elem.alias("e")).alias("s"))
    b = g.groupBy(*keys).agg(F.array_sort(F.collect_list("s")).alias("l"))
    arr = F.concat(F.lit("["), F.array_join(F.col("l.e"), ", "), F.lit("]"))
    bid = F.col("batch_id")
    raw = F.when(bid % 3 == 1, F.concat(F.lit("```json\n"), arr, F.lit("\n```"))).otherwise(arr)
    raw = F.when(bid % 5 == 2, F.concat(raw, F.lit(" trailing"))).otherwise(raw)
    return b.select(*keys, F.concat(F.lit(" "), raw, F.lit("\n")).alias("raw"))


def items_sql(where: str = "TRUE", by_label: bool = False) -> str:
    """DuckDB twin of ``raw_batches`` + ``parse_string_batch``: (label?, batch_id, pos, item)."""
    keys = "lang AS label, doc_id // 25 AS batch_id" if by_label else "doc_id // 25 AS batch_id"
    kc = "label, batch_id" if by_label else "batch_id"
    return f"""(WITH b AS (
  SELECT {keys}, list(CASE WHEN doc_id % 9 = 4 THEN CAST(n_chars AS VARCHAR)
      WHEN doc_id % 11 = 3 THEN '"   "' WHEN doc_id % 13 = 6 THEN '{{"x": ' || CAST(n_chars AS VARCHAR) || '}}'
      ELSE to_json(text)::VARCHAR END ORDER BY doc_id) AS l FROM documents WHERE {where} GROUP BY ALL),
r AS (SELECT {kc}, '[' || array_to_string(l, ', ') || ']' AS arr FROM b),
f AS (SELECT {kc}, CASE WHEN batch_id % 3 = 1 THEN '```json' || chr(10) || arr || chr(10) || '```' ELSE arr END AS raw0 FROM r),
g AS (SELECT {kc}, ' ' || CASE WHEN batch_id % 5 = 2 THEN raw0 || ' trailing' ELSE raw0 END || chr(10) AS raw FROM f),
c AS (SELECT {kc}, CASE WHEN starts_with({S.strip('raw')}, '```') THEN
          regexp_replace(regexp_replace({S.strip('raw')}, '^```[a-zA-Z]*' || chr(10), ''), chr(10) || '```$', '')
        ELSE {S.strip('raw')} END AS cleaned FROM g),
j AS (SELECT {kc}, CAST(cleaned AS JSON) AS js FROM c WHERE json_valid(cleaned) AND json_type(CAST(cleaned AS JSON)) = 'ARRAY'),
e AS (SELECT {kc}, unnest(range(0, CAST(json_array_length(js) AS BIGINT))) AS pos, js FROM j),
s AS (SELECT {kc}, pos, json_extract(js, '$[' || pos || ']') AS el FROM e)
SELECT {kc}, CAST(pos AS INTEGER) AS pos, item FROM
 (SELECT {kc}, pos, {S.strip("json_extract_string(el, '$')")} AS item FROM s WHERE json_type(el) = 'VARCHAR')
WHERE item <> '')"""


def _wrapped(x: F.Column) -> tuple[F.Column, F.Column]:
    """The text as the first value of an object whose second key is the text's own digest, parsed strictly, and
    that key. Only a text that is one whole JSON value leaves exactly these two keys: junk behind the
    value, a second value, single quotes or raw control characters end in a syntax error or other keys, and
    no text can hold its own digest. Duplicate keys and NaN are rejected too."""
    k = F.concat(F.lit("k"), F.sha2(x, 256))
    w = F.try_parse_json(F.concat(F.lit('{"v":'), x, F.lit(',"'), k, F.lit('":1}')))
    return F.try_variant_get(w, "$", "map<string,variant>"), k


def strict_parse_json(x: F.Column) -> F.Column:
    """Parse JSON that must span the whole text (like ``json.loads``), as a variant; else null."""
    m, k = _wrapped(x)
    return F.when((F.size(m) == 2) & F.map_contains_key(m, k), F.try_element_at(m, F.lit("v")))


def strict_json_valid(x: F.Column) -> F.Column:
    """The whole text is one JSON value."""
    m, k = _wrapped(x)
    return F.coalesce((F.size(m) == 2) & F.map_contains_key(m, k), F.lit(False))


def parse_string_batch(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """B5 + B7: strip fences, parse JSON; only a top-level array contributes; keep
    string elements, stripped, non-blank. Bad JSON contributes nothing."""
    v = df.withColumn("_v", strict_parse_json(T.strip_code_fences(raw_col, final_strip=False)))
    arr = v.where(F.schema_of_variant("_v").startswith("ARRAY"))
    e = arr.select("*", F.posexplode(F.expr("variant_get(_v, '$', 'array<variant>')")).alias("pos", "_e"))
    s = e.where(F.schema_of_variant("_e") == "STRING").withColumn("item", T.py_strip(F.expr("variant_get(_e, '$', 'string')")))
    return s.where(F.col("item") != "").drop("_v", "_e", raw_col)


@register(
    "batch_parse",
    f"SELECT batch_id, pos, md5(item) AS item_md5, CAST(length(item) AS BIGINT) AS item_len FROM {items_sql()}",
)
def batch_parse(spark, sf):
    p = parse_string_batch(raw_batches(spark, sf))
    return p.select("batch_id", "pos", F.md5("item").alias("item_md5"), F.length("item").cast("long").alias("item_len"))


@register(
    "batch_growth",
    """WITH items AS (SELECT batch_id, item_md5 FROM ({bp})),
firsts AS (SELECT item_md5, min(batch_id) AS first_batch FROM items GROUP BY 1),
nb AS (SELECT first_batch AS batch_id, count(*) AS n FROM firsts GROUP BY 1),
allb AS (SELECT DISTINCT doc_id // 25 AS batch_id FROM documents)
SELECT a.batch_id, coalesce(n, 0) AS n_new, CAST(sum(coalesce(n, 0)) OVER (ORDER BY a.batch_id) AS BIGINT) AS total
FROM allb a LEFT JOIN nb USING (batch_id)""".replace("{bp}", ORACLE["batch_parse"]),
)
def batch_growth(spark, sf):
    """New distinct items per batch (an item counts in the first batch that
    has it) and the running total in batch order."""
    items = parse_string_batch(raw_batches(spark, sf)).select("batch_id", F.sha2("item", 256).alias("k"))
    firsts = items.groupBy("k").agg(F.min("batch_id").alias("batch_id"))
    nb = firsts.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    allb = table(spark, sf, "documents").select((F.col("doc_id") / BATCH).cast("long").alias("batch_id")).distinct()
    j = allb.join(nb, "batch_id", "left").select("batch_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_new"))
    return running_sum(j, "batch_id", "n_new", "total")


# ------------------------------------------------------------------ envelopes
# Envelope error messages and the default finish reason.
MSG_NO_CANDIDATES = "No candidates in response"
MSG_EMPTY_TEXT = "Empty text in response"
DEFAULT_FINISH = "unknown"
_ENV_SCHEMA = "candidates array<struct<content: struct<parts: array<struct<text: string>>>>>"


def envelopes(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text", "source")
    k = F.col("doc_id") % 10
    p1 = F.struct(F.when(k == 9, F.lit(" ")).otherwise(F.col("text")).alias("text"))
    p2 = F.struct(F.when(k >= 8, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" ("), "source", F.lit(")"))).alias("text"))
    cand = F.when(k == 7, F.array().cast(f"array<struct<content: struct<parts: array<struct<text: string>>>>>")).otherwise(
        F.array(F.struct(F.struct(F.array(p1, p2).alias("parts")).alias("content")))
    )
    body = F.to_json(F.struct(cand.alias("candidates")))
    chat = F.concat(
        F.lit('{"choices": [{"message": {"content": "x"}'),
        F.when(F.col("doc_id") % 3 == 0, F.lit(', "finish_reason": "length"')).otherwise(F.lit("")),
        F.lit("}]}"),
    )
    return d.select("doc_id", body.alias("body"), chat.alias("chat"))


def envelope_text(body: str) -> F.Column:
    """Concatenated ``candidates[0].content.parts[*].text`` (missing text = '')."""
    e = F.from_json(F.col(body), _ENV_SCHEMA)
    return F.array_join(F.transform(F.get(e["candidates"], 0)["content"]["parts"], lambda p: F.coalesce(p["text"], F.lit(""))), "")


@register(
    "envelope_extract",
    f"""WITH e AS (SELECT doc_id,
   CASE WHEN doc_id % 10 = 7 THEN 0 ELSE 1 END AS n_cand,
   CASE WHEN doc_id % 10 = 7 THEN NULL ELSE CASE WHEN doc_id % 10 = 9 THEN ' ' ELSE text END
        || CASE WHEN doc_id % 10 >= 8 THEN '' ELSE ' (' || source || ')' END END AS t,
   CASE WHEN doc_id % 3 = 0 THEN 'length' ELSE '{DEFAULT_FINISH}' END AS finish_reason FROM documents)
SELECT doc_id, CASE WHEN n_cand = 0 THEN '{MSG_NO_CANDIDATES}' WHEN {S.strip('t')} = '' THEN '{MSG_EMPTY_TEXT}' END AS error,
  CASE WHEN n_cand > 0 AND {S.strip('t')} <> '' THEN md5(t) END AS text_md5, finish_reason FROM e""",
)
def envelope_extract(spark, sf):
    """Text from a generate-content envelope with its two error cases, and the
    chat-form finish reason defaulting to 'unknown'."""
    e = envelopes(spark, sf)
    n = F.size(F.from_json("body", _ENV_SCHEMA)["candidates"])
    t = envelope_text("body")
    err = F.when(F.coalesce(n, F.lit(0)) <= 0, MSG_NO_CANDIDATES).when(T.py_strip(t) == "", MSG_EMPTY_TEXT)
    return e.select(
        "doc_id",
        err.alias("error"),
        F.when(err.isNull(), F.md5(t)).alias("text_md5"),
        F.coalesce(F.get_json_object("chat", "$.choices[0].finish_reason"), F.lit(DEFAULT_FINISH)).alias("finish_reason"),
    )
