"""Contributions, narratives and their grading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.functions import scalars as X


def friendly(name: Column) -> Column:
    return F.coalesce(X.lookup(name, K.FEATURE_LABELS), name)


def linear_contributions(weights: dict[str, float], values: dict[str, Column], means: dict[str, Column]) -> Column:
    """Exact contributions of a linear model: weight * (value - mean)."""
    return F.array(*[
        F.struct(F.lit(n).alias("feature_name"), values[n].cast("double").alias("feature_value"),
                 (F.lit(w) * (values[n] - means[n])).cast("double").alias("shap_value"))
        for n, w in weights.items()])


def top_contributors(all_of_them: Column, n: int = K.TOP_CONTRIBUTORS) -> Column:
    """Largest contributions by absolute value, names breaking ties."""
    ranked = F.sort_array(F.transform(all_of_them, lambda c: F.struct(
        (-F.abs(c["shap_value"])).alias("o"), c["feature_name"].alias("feature_name"),
        c["feature_value"].alias("feature_value"), c["shap_value"].alias("shap_value"))))
    return F.transform(F.slice(ranked, 1, n), lambda c: F.struct(
        c["feature_name"].alias("feature_name"), c["feature_value"].alias("feature_value"),
        c["shap_value"].alias("shap_value")))


def _signal(c: Column, towards: str, sign: str) -> Column:
    return F.concat(F.lit(f"The strongest signal pushing toward {towards} was "), friendly(c["feature_name"]),
                    F.lit(" (value "), X.general_number(c["feature_value"]), F.lit(f", impact {sign}"),
                    F.format_string("%.3f", c["shap_value"]), F.lit(")."))


def template_narrative(contributors: Column) -> Column:
    """Header sentence, then the strongest signal in each direction when there is one."""
    head = F.concat(
        F.lit("Transaction "), F.substring("event_id", 1, 8), F.lit(" for $"), F.format_number("amount", 2),
        F.lit(" at "), F.coalesce("merchant_name", F.lit("an unknown merchant")), F.lit(" was classified "), F.col("decision"),
        F.lit(" with a fraud score of "), F.format_string("%.3f", F.col("fraud_score").cast("double")),
        F.lit(" (feature completeness "), F.rint(F.col("feature_completeness").cast("double") * 100).cast("long").cast("string"), F.lit("%)."))
    up = F.try_element_at(F.filter(contributors, lambda c: c["shap_value"] > 0), F.lit(1))
    down = F.try_element_at(F.filter(contributors, lambda c: c["shap_value"] < 0), F.lit(1))
    return F.concat_ws(" ", head, F.when(up.isNotNull(), _signal(up, "FRAUD", "+")),
                       F.when(down.isNotNull(), _signal(down, "LEGITIMATE", "")))


def grade(text: Column, contributors: Column, mode: Column, max_words: int = K.MAX_NARRATIVE_WORDS) -> Column:
    """True when the narrative may be shown.

    Templates are judged on length alone. Any other text must also be
    grounded: every known feature it names is among the contributors, and none
    is named as pushing the other way. This stands in for a second language
    model as the judge.
    """
    short = X.word_count(text) <= max_words
    labels = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("label")) for n, t in K.FEATURE_LABELS.items()])

    def wrong(entry: Column) -> Column:
        named = text.contains(entry["label"])
        listed = F.exists(contributors, lambda c: c["feature_name"] == entry["name"])
        up = F.exists(contributors, lambda c: (c["feature_name"] == entry["name"]) & (c["shap_value"] > 0))
        says_up = text.contains(F.concat(F.lit("toward FRAUD was "), entry["label"]))
        says_down = text.contains(F.concat(F.lit("toward LEGITIMATE was "), entry["label"]))
        return (named & ~listed) | (says_up & ~up) | (says_down & up)

    return F.when(mode == "TEMPLATE", short).otherwise(short & ~F.exists(labels, wrong))


def unnest(enriched: DataFrame) -> DataFrame:
    """Contributors as rows with their rank; missing inputs are spelled out."""
    rows = enriched.select("event_id", F.posexplode("top_contributors").alias("pos", "c"))
    value = F.when(F.col("c.feature_value") == K.SENTINEL, "missing on live event").otherwise(
        F.format_string("%.4f", F.col("c.feature_value").cast("double")))
    return rows.select("event_id", (F.col("pos") + 1).alias("rank"), F.col("c.feature_name").alias("feature"),
                       value.alias("value"), F.round("c.shap_value", 4).alias("shap"))


def has_live_feature(contributors: Column) -> Column:
    return F.exists(contributors, lambda c: c["feature_value"] != K.SENTINEL)


def names_feature(contributors: Column, name: str) -> Column:
    return F.exists(contributors, lambda c: c["feature_name"] == name)


# --- prompts and answers ---------------------------------------------------------

def scoring_prompt() -> Column:
    """Tokenised transaction block for an external scorer; hashes are cut to 12 characters."""
    def cut(c: str) -> Column:
        return F.concat(F.substring(c, 1, 12), F.lit("..."))

    lines = [
        ("amount", F.concat(F.replace(F.format_number("amount", 2), F.lit(","), F.lit("")), F.lit(" "), F.col("currency"))),
        ("amount_usd", F.replace(F.format_number("amount_fx_normalised", 2), F.lit(","), F.lit(""))),
        ("merchant_name", F.col("merchant_name")), ("mcc", F.col("mcc")), ("merchant_country", F.col("merchant_country")),
        ("geo_distance_km", F.replace(F.format_number("geo_distance_km", 1), F.lit(","), F.lit(""))),
        ("card_token", cut("card_token")), ("ip_hash", cut("ip_address_hash")),
        ("device_hash", cut("device_fingerprint_hash")), ("source", F.col("source_label"))]
    width = max(len(n) for n, _ in lines) + 1
    body = [F.concat(F.lit("  " + f"{n}:".ljust(width) + " "), v) for n, v in lines]
    return F.concat_ws("\n", F.lit("Transaction features:"), *body, F.lit(""),
                       F.lit("Return JSON with fraud_score and reason."))


def contributor_lines(contributors: Column) -> Column:
    """One line per contributor for a narration prompt."""
    def line(c: Column) -> Column:
        sign = F.when(c["shap_value"] >= 0, "+").otherwise("")
        way = F.when(c["shap_value"] > 0, "FRAUD").otherwise("LEGIT")
        return F.concat(F.lit("  - "), friendly(c["feature_name"]), F.lit(": value="), X.general_number(c["feature_value"]),
                        F.lit(", shap="), sign, F.format_number(c["shap_value"], 4), F.lit(" (pushes toward "), way, F.lit(")"))

    return F.array_join(F.transform(contributors, line), "\n")


def parse_score_answer(answer: Column) -> dict[str, Column]:
    """Score clamped to [0, 1] (0 when absent or unreadable) and a reason of at most 300 characters."""
    parsed = F.from_json(answer, "fraud_score string, reason string")
    score = F.coalesce(parsed["fraud_score"].try_cast("double"), F.lit(0.0))
    return {"llm_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)),
            "llm_reason": F.substring(F.trim(F.coalesce(parsed["reason"], F.lit(""))), 1, 300)}


def parse_grade_answer(answer: Column) -> dict[str, Column]:
    """A judge's verdict, code fences removed; missing booleans are false."""
    bare = F.trim(F.regexp_replace(F.coalesce(answer, F.lit("")), "(?m)^```(json)?|```$", ""))
    parsed = F.from_json(bare, "factual boolean, actionable boolean, reason string")
    return {"factual": F.coalesce(parsed["factual"], F.lit(False)),
            "actionable": F.coalesce(parsed["actionable"], F.lit(False)),
            "grade_reason": F.substring(F.coalesce(parsed["reason"], F.lit("")), 1, 200)}
