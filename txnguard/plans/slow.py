"""Queries: explanations, narratives, text anomaly and the slow path."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txnguard import constants as K
from txnguard.functions import scalars as X
from txnguard.operators import explain, slowpath, text
from txnguard.plans.registry import query
from txnguard.plans.rules import scorecard
from txnguard.plans.sql_base import DOMAIN_OF, EVENT_COLS, NIGHT, cte, oracle
from txnguard.sources import fixtures as fx

TOP = 5
_TERMS = {"log_amount": (0.75, "ln(1 + amount)"), "is_night": (0.9, f"CASE WHEN {NIGHT.format('event_timestamp_ms')} THEN 1 ELSE 0 END"),
          "is_high_amount": (1.1, "CASE WHEN amount > 147 THEN 1 ELSE 0 END"),
          "p_email_missing": (0.8, f"CASE WHEN {DOMAIN_OF.format('merchant_name')} IN ('missing', 'nan', 'anonymous.com') THEN 1 ELSE 0 END"),
          "dist1": (0.00005, "geo_distance_km")}
cte("ctall", " UNION ALL ".join(f"SELECT event_id, decision, '{n}' AS feature_name, ({v})::DOUBLE AS feature_value, {w} * (({v})::DOUBLE - (SELECT avg(({v})::DOUBLE) FROM tx)) AS shap_value FROM sc"
                                for n, (w, v) in _TERMS.items()), "sc", "tx")
cte("ct", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(shap_value) DESC, feature_name) AS rank
  FROM ctall WHERE decision <> 'ALLOW') WHERE rank <= {TOP}""", "ctall")
_LABEL = "CASE feature_name " + " ".join(f"WHEN '{n}' THEN '{t}'" for n, t in K.FEATURE_LABELS.items()) + " ELSE feature_name END"
cte("sig", f"""SELECT event_id, first(feature_name ORDER BY rank) FILTER (WHERE shap_value > 0) AS un, first({_LABEL} ORDER BY rank) FILTER (WHERE shap_value > 0) AS up, first(feature_value ORDER BY rank) FILTER (WHERE shap_value > 0) AS uv,
  first(shap_value ORDER BY rank) FILTER (WHERE shap_value > 0) AS us, first({_LABEL} ORDER BY rank) FILTER (WHERE shap_value < 0) AS dn,
  first(feature_value ORDER BY rank) FILTER (WHERE shap_value < 0) AS dv, first(shap_value ORDER BY rank) FILTER (WHERE shap_value < 0) AS ds FROM ct GROUP BY event_id""", "ct")
cte("enr", f"""SELECT {EVENT_COLS.replace('event_id', 's.event_id', 1)}, fraud_score, decision, model_name, model_version, scored_at_ms, scoring_latency_ms, feature_completeness,
  'Transaction ' || left(s.event_id, 8) || ' for $' || format('{{:,.2f}}', amount) || ' at ' || merchant_name || ' was classified ' || decision || ' with a fraud score of ' || printf('%.3f', fraud_score)
  || ' (feature completeness ' || printf('%.0f', feature_completeness * 100) || '%).'
  || CASE WHEN up IS NULL THEN '' ELSE ' The strongest signal pushing toward FRAUD was ' || up || ' (value ' || printf('%.4g', uv) || ', impact +' || printf('%.3f', us) || ').' END
  || CASE WHEN dn IS NULL THEN '' ELSE ' The strongest signal pushing toward LEGITIMATE was ' || dn || ' (value ' || printf('%.4g', dv) || ', impact ' || printf('%.3f', ds) || ').' END AS narrative,
  'TEMPLATE' AS narrator_mode, true AS narrative_grading_passed, scored_at_ms + 40 AS enriched_at_ms, 35 AS enrichment_latency_ms
  FROM sc s JOIN sig USING (event_id)""", "sc", "sig")


def enriched(spark, d) -> DataFrame:
    means = slowpath.feature_means(fx.transactions(spark, d), scorecard())
    return slowpath.enrich(fx.scored(spark, d), scorecard(), means, TOP, F.col("scored_at_ms") + 40, F.lit(35).cast("long"))


@query("f2_slow_path", oracle(f"SELECT *, {TOP} AS contributors FROM enr", "enr"), "fraud_score", digits=8)
def f2(spark, d) -> DataFrame:
    """Flagged events explained, narrated and graded."""
    return enriched(spark, d).withColumn("contributors", F.size("top_contributors")).drop("top_contributors")


@query("g5_linear_contributions", oracle("SELECT event_id, feature_name, feature_value, shap_value FROM ctall", "ctall"), "feature_value shap_value")
def g5(spark, d) -> DataFrame:
    m, tx = scorecard(), fx.transactions(spark, d)
    s = fx.scored(spark, d).withColumn("_means", slowpath.feature_means(tx, m))
    every = explain.linear_contributions(m.weights, m.values(), {n: F.col(f"_means.{n}") for n in m.weights})
    return s.select("event_id", F.explode(every).alias("c")).select("event_id", "c.*")


@query("e4_top_contributors", oracle("SELECT event_id, rank, feature_name, shap_value FROM ct", "ct"), "shap_value")
def e4(spark, d) -> DataFrame:
    rows = enriched(spark, d).select("event_id", F.posexplode("top_contributors").alias("pos", "c"))
    return rows.select("event_id", (F.col("pos") + 1).alias("rank"), "c.feature_name", "c.shap_value")


@query("b21_feature_labels", oracle("SELECT feature_name, " + _LABEL + " AS label, count(*) AS n FROM (SELECT unnest([" + ", ".join(f"'{f}'" for f in K.FEATURES) + "]) AS feature_name FROM tx) GROUP BY 1, 2", "tx"))
def b21(spark, d) -> DataFrame:
    names = F.explode(F.array(*[F.lit(f) for f in K.FEATURES]))
    rows = fx.transactions(spark, d).select(names.alias("feature_name"))
    return rows.groupBy("feature_name", explain.friendly(F.col("feature_name")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("c7_contributor_rows", oracle("""SELECT event_id, rank, feature_name AS feature, CASE WHEN feature_value = -999 THEN 'missing on live event' ELSE printf('%.4f', feature_value) END AS value, shap_value AS shap FROM ct""", "ct"), "shap", digits=4)
def c7(spark, d) -> DataFrame:
    return explain.unnest(enriched(spark, d))


@query("c6_live_contributors", oracle("SELECT DISTINCT event_id FROM ct WHERE feature_value <> -999", "ct"))
def c6(spark, d) -> DataFrame:
    return enriched(spark, d).where(explain.has_live_feature(F.col("top_contributors"))).select("event_id")


@query("c8_contributor_containment", oracle("SELECT DISTINCT event_id FROM ct WHERE feature_name = 'is_night'", "ct"))
def c8(spark, d) -> DataFrame:
    return enriched(spark, d).where(explain.names_feature(F.col("top_contributors"), "is_night")).select("event_id")


@query("d22_explanation_coverage", oracle("SELECT count(*) AS enriched, count(*) AS with_live_feature FROM enr", "enr"))
def d22(spark, d) -> DataFrame:
    return slowpath.live_coverage(enriched(spark, d))


@query("d40_feature_frequency", oracle("SELECT feature_name AS feature, count(*) AS events FROM ct WHERE decision = 'BLOCK' GROUP BY 1", "ct"))
def d40(spark, d) -> DataFrame:
    return slowpath.feature_frequency(enriched(spark, d))


@query("e7_alert_feed", oracle("SELECT event_id, customer_id, amount, decision, fraud_score, narrative FROM enr", "enr"), "fraud_score", digits=8)
def e7(spark, d) -> DataFrame:
    return slowpath.alert_feed(enriched(spark, d))


# Texts from elsewhere: one names a feature the model did not use, one turns a sign around, one is too long.
_OTHER = """CASE id % 4 WHEN 0 THEN 'Driven by the ' || up || '.' WHEN 1 THEN 'Driven by the card-network frequency.'
  WHEN 2 THEN 'The strongest signal pushing toward LEGITIMATE was ' || up || '.' ELSE repeat('word ', 81) END"""


@query("f3_grounding", oracle(f"""SELECT event_id, CASE id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false ELSE false END AS passed
  FROM (SELECT event_id, event_id::BIGINT AS id, up FROM sig WHERE up IS NOT NULL)""", "sig"))
def f3(spark, d) -> DataFrame:
    e = enriched(spark, d).withColumn("up", F.try_element_at(F.filter("top_contributors", lambda c: c["shap_value"] > 0), F.lit(1)))
    e = e.where(F.col("up").isNotNull()).withColumn("up", explain.friendly(F.col("up.feature_name"))).withColumn("id", F.col("event_id").cast("long"))
    told = e.withColumn("told", F.expr(_OTHER.replace("||", "||")))
    return told.select("event_id", explain.grade(F.col("told"), F.col("top_contributors"), F.lit("GEMINI")).alias("passed"))


@query("b24_prompts", oracle("""SELECT event_id, 'Transaction features:' || chr(10) || '  amount:           ' || printf('%.2f', amount) || ' ' || currency || chr(10) || '  amount_usd:       ' || printf('%.2f', amount_fx_normalised) || chr(10)
  || '  merchant_name:    ' || merchant_name || chr(10) || '  mcc:              ' || mcc || chr(10) || '  merchant_country: ' || merchant_country || chr(10) || '  geo_distance_km:  ' || printf('%.1f', geo_distance_km) || chr(10)
  || '  card_token:       ' || left(card_token, 12) || '...' || chr(10) || '  ip_hash:          ' || left(ip_address_hash, 12) || '...' || chr(10) || '  device_hash:      ' || left(device_fingerprint_hash, 12) || '...' || chr(10)
  || '  source:           ' || source_label || chr(10) || chr(10) || 'Return JSON with fraud_score and reason.' AS prompt FROM tx""", "tx"))
def b24(spark, d) -> DataFrame:
    return fx.transactions(spark, d).select("event_id", explain.scoring_prompt().alias("prompt"))


@query("b24_contributor_lines", oracle(f"""SELECT event_id, string_agg('  - ' || {_LABEL} || ': value=' || printf('%.4g', feature_value) || ', shap=' || printf('%+.4f', shap_value) || ' (pushes toward ' || CASE WHEN shap_value > 0 THEN 'FRAUD' ELSE 'LEGIT' END || ')', chr(10) ORDER BY rank) AS lines FROM ct GROUP BY event_id""", "ct"))
def b24_lines(spark, d) -> DataFrame:
    return enriched(spark, d).select("event_id", explain.contributor_lines(F.col("top_contributors")).alias("lines"))


_ANSWER = """CASE id % 5 WHEN 0 THEN concat('{"fraud_score": ', cast(amount / 100 AS varchar(20)), ', "reason": "  high amount  "}') WHEN 1 THEN '{"fraud_score": -2, "reason": "odd"}'
  WHEN 2 THEN '{"reason": "no score"}' WHEN 3 THEN concat('{"fraud_score": "0.25", "reason": "', repeat('long ', 100), '"}') ELSE 'not json' END"""


@query("b25_scorer_answers", oracle("""SELECT event_id, CASE id % 5 WHEN 0 THEN least(1.0, amount / 100) WHEN 3 THEN 0.25 ELSE 0.0 END AS llm_score,
  CASE id % 5 WHEN 0 THEN 'high amount' WHEN 1 THEN 'odd' WHEN 2 THEN 'no score' WHEN 3 THEN left(trim(repeat('long ', 100)), 300) ELSE '' END AS llm_reason FROM txx""", "txx"), "llm_score")
def b25(spark, d) -> DataFrame:
    a = fx.with_event_columns(fx.base(spark, d)).withColumn("answer", F.expr(_ANSWER))
    return a.select("event_id", *[c.alias(n) for n, c in explain.parse_score_answer(F.col("answer")).items()])


@query("b25_grader_answers", oracle("""SELECT event_id, id % 3 <> 2 AS factual, id % 3 = 0 AS actionable, CASE id % 3 WHEN 0 THEN 'fine' WHEN 1 THEN left(repeat('x', 300), 200) ELSE '' END AS grade_reason FROM txx""", "txx"))
def b25_grader(spark, d) -> DataFrame:
    a = fx.with_event_columns(fx.base(spark, d)).withColumn("answer", F.expr(
        """CASE id % 3 WHEN 0 THEN concat('```json', chr(10), '{"factual": true, "actionable": true, "reason": "fine"}', chr(10), '```')
           WHEN 1 THEN concat('{"factual": true, "actionable": false, "reason": "', repeat('x', 300), '"}') ELSE '{"reason": ""}' END"""))
    return a.select("event_id", *[c.alias(n) for n, c in explain.parse_grade_answer(F.col("answer")).items()])


@query("b26_perplexity", oracle("""SELECT event_id, CASE WHEN m IS NULL THEN 0 ELSE least(-m, 30) END::DOUBLE AS log_perplexity, CASE WHEN m IS NULL THEN 0 ELSE 1 / (1 + exp(-(least(-m, 30) - 6) * 0.5)) END AS text_anomaly_score,
  CASE WHEN m IS NOT NULL AND least(-m, 30) >= 6 THEN 'SUSPICIOUS' ELSE 'NORMAL' END AS text_anomaly_label, CASE WHEN m IS NULL THEN 0 ELSE ln(exp(least(-m, 30))) END AS log_of_perplexity
  FROM (SELECT event_id, CASE WHEN k % 10 = 0 THEN NULL ELSE -value / 10 END AS m FROM txx)""", "txx"), "log_perplexity text_anomaly_score log_of_perplexity")
def b26(spark, d) -> DataFrame:
    b = fx.with_event_columns(fx.base(spark, d)).withColumn("m", F.when(F.col("k") % 10 != 0, -F.col("value") / 10))
    out = b.withColumns(X.perplexity(F.col("m")))
    logged = F.when(F.col("m").isNull(), 0.0).otherwise(F.log("perplexity"))
    return out.select("event_id", "log_perplexity", "text_anomaly_score", "text_anomaly_label", logged.alias("log_of_perplexity"))


@query("b29_text_helpers", oracle("""SELECT event_id, left(event_id, 3) AS head, split_part(merchant_name, '-', 1) AS part, strftime(make_timestamp((event_timestamp_ms + 19800000) * 1000), '%H:%M:%S') AS ist,
  regexp_full_match(card_token, '[0-9a-f]{16}|null') AS token_ok, nullif(merchant_country, '00') AS country, json_extract_string(props, '$.k') AS k FROM (SELECT * FROM tx) t JOIN (SELECT event_id AS e, props FROM events) ON e::VARCHAR = t.event_id""", "tx"))
def b29(spark, d) -> DataFrame:
    props = fx.table(spark, d, "events").selectExpr("cast(event_id AS string) AS event_id", "props")
    t = fx.transactions(spark, d).join(props, "event_id")
    return t.select("event_id", F.substring("event_id", 1, 3).alias("head"), F.element_at(F.split("merchant_name", "-"), 1).alias("part"),
                    X.clock_text("event_timestamp_ms").alias("ist"), F.col("card_token").rlike("^([0-9a-f]{16}|null)$").alias("token_ok"),
                    F.nullif(F.col("merchant_country"), F.lit("00")).alias("country"), F.get_json_object("props", "$.k").alias("k"))


@query("b30_word_count", """SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS words FROM (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS t FROM documents)""")
def b30(spark, d) -> DataFrame:
    return fx.table(spark, d, "documents").select("doc_id", X.word_count("text").alias("words"))


# --- text anomaly ---------------------------------------------------------------------

SUSPICIOUS = 2.6  # chosen for this model; 6.0 belonged to another
_NORM = "trim(regexp_replace(lower(coalesce({0}, '')), '[\\x09-\\x0D\\x20]+', ' ', 'g'))"
_TRI = "substr('^^' || w || '$', unnest(range(1, len(w) + 2)), 3)"
cte("tri", f"""SELECT tri, sum(n)::BIGINT AS n FROM (SELECT {_TRI} AS tri, n FROM (SELECT w, count(*) AS n FROM (SELECT unnest(string_split({_NORM.format('text')}, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY w)) GROUP BY tri""")
cte("ctx", "SELECT left(tri, 2) AS ctx, sum(n)::BIGINT AS ctx_n FROM tri GROUP BY 1", "tri")


def _score_sql(source: str) -> str:
    return f"""ts AS (SELECT text, CASE WHEN m IS NULL THEN 0 ELSE least(-m, 30) END AS log_perplexity, CASE WHEN m IS NULL THEN 0 ELSE 1 / (1 + exp(-(least(-m, 30) - {SUSPICIOUS}) * 0.5)) END AS text_anomaly_score,
  CASE WHEN m IS NOT NULL AND least(-m, 30) >= {SUSPICIOUS} THEN 'SUSPICIOUS' ELSE 'NORMAL' END AS text_anomaly_label FROM (
  SELECT x.text, avg(ln((coalesce(tri.n, 0) + 0.5) / (coalesce(ctx_n, 0) + 0.5 * (SELECT count(DISTINCT substr(tri, 3, 1)) FROM tri)))) FILTER (WHERE g.tri IS NOT NULL) AS m
  FROM (SELECT DISTINCT text FROM ({source})) x LEFT JOIN (SELECT text, {_TRI} AS tri FROM (SELECT text, unnest(string_split({_NORM.format('text')}, ' ')) AS w FROM (SELECT DISTINCT text FROM ({source}))) WHERE w <> '') g ON g.text = x.text
  LEFT JOIN tri ON tri.tri = g.tri LEFT JOIN ctx ON ctx.ctx = left(g.tri, 2) GROUP BY x.text))"""


_DOM = "CASE WHEN strpos(merchant_name, '-MERCHANT-') > 0 THEN trim(substr(merchant_name, strpos(merchant_name, '-MERCHANT-') + 10)) ELSE merchant_name END"
_TS = _score_sql(f"SELECT {_DOM} AS text FROM tx")


def model(spark, d) -> text.TrigramModel:
    return text.fit(fx.table(spark, d, "documents"))


@query("g12_trigram_counts", oracle("SELECT tri, n FROM tri", "tri"))
def g12_counts(spark, d) -> DataFrame:
    return model(spark, d).trigrams


def merchant_text(spark, d) -> DataFrame:
    e = fx.scored(spark, d).withColumn("domain_text", X.text_domain("merchant_name"))
    return text.score(e, "domain_text", model(spark, d), SUSPICIOUS)


@query("g12_merchant_text_scores", oracle(f", {_TS} SELECT event_id, log_perplexity, text_anomaly_score, text_anomaly_label FROM tx JOIN ts ON ts.text = {_DOM}", "tx", "ctx"), "log_perplexity text_anomaly_score")
def g12(spark, d) -> DataFrame:
    return merchant_text(spark, d).select("event_id", "log_perplexity", "text_anomaly_score", "text_anomaly_label")


@query("g12_page_host_scores", oracle(f", {_score_sql('SELECT regexp_extract(url, $re$^[a-z]+://([^/:?#]+)$re$, 1) AS text FROM pages')} SELECT page_id, log_perplexity, text_anomaly_score, text_anomaly_label FROM pages JOIN ts ON ts.text = regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)", "ctx"), "log_perplexity text_anomaly_score")
def g12_pages(spark, d) -> DataFrame:
    pages = fx.table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1).alias("host"))
    return text.score(pages, "host", model(spark, d), SUSPICIOUS, key="page_id").select("page_id", "log_perplexity", "text_anomaly_score", "text_anomaly_label")


cte("txt", f"SELECT s.*, log_perplexity, text_anomaly_score, text_anomaly_label FROM sc s JOIN ts ON ts.text = {_DOM}", "sc", "ts")
cte("ts", _TS.removeprefix("ts AS (")[:-1], "tx", "ctx")


@query("d20_silver_summary", oracle(f"SELECT decision, count(*) AS n, avg(text_anomaly_score) AS avg_text_anomaly, count(*) FILTER (WHERE log_perplexity >= {SUSPICIOUS}) AS suspicious_count FROM txt GROUP BY decision", "txt"), "avg_text_anomaly")
def d20(spark, d) -> DataFrame:
    """The flag, then the summary per decision."""
    rows = merchant_text(spark, d).withColumn("text_suspicious", F.col("log_perplexity") >= SUSPICIOUS)
    return slowpath.silver_summary(rows)


@query("d21_text_label_summary", oracle("SELECT text_anomaly_label AS label, count(*) AS merchants_checked, avg(text_anomaly_score) AS avg_score FROM txt WHERE decision <> 'ALLOW' GROUP BY 1", "txt"), "avg_score")
def d21(spark, d) -> DataFrame:
    return slowpath.text_summary(merchant_text(spark, d).where(X.flagged("decision")))


@query("d21_text_coverage", oracle("SELECT count(*) AS enriched, count(*) FILTER (WHERE event_id::BIGINT % 9 <> 0) AS checked FROM txt WHERE decision <> 'ALLOW'", "txt"))
def d21_coverage(spark, d) -> DataFrame:
    rows = merchant_text(spark, d).where(X.flagged("decision"))
    return slowpath.text_coverage(rows.withColumn("text_anomaly_label", F.when(F.col("event_id").cast("long") % 9 != 0, F.col("text_anomaly_label"))))


@query("e6_latest_text_scores", oracle("SELECT merchant_name, text_anomaly_label AS label, round(text_anomaly_score, 3) AS score FROM txt ORDER BY scored_at_ms DESC, event_id LIMIT 5", "txt"))
def e6_text(spark, d) -> DataFrame:
    top = merchant_text(spark, d).orderBy(F.desc("scored_at_ms"), "event_id").limit(5)
    return top.select("merchant_name", F.col("text_anomaly_label").alias("label"), F.round("text_anomaly_score", 3).alias("score"))
