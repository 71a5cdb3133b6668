"""Prompts: choice per codelist and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conceptmill import vocab as v
from conceptmill.operators.labels import with_positions
from conceptmill.operators.skew import spread_join

DEFAULT_KEY = "default"


def prompts_for_schemes(schemes: DataFrame, prompts: DataFrame) -> DataFrame:
    """(scheme, system_message, user_message): the scheme's own prompt or the default.

    ``prompts`` is (scheme, system_message, user_message) with a row for the
    scheme ``default``; without such a row the built-in default is used.
    """
    own = schemes.select("scheme").distinct().join(prompts, "scheme", "left")
    default = prompts.where(F.col("scheme") == DEFAULT_KEY)
    system = default.agg(F.min("system_message").alias("x")).scalar()
    user = default.agg(F.min("user_message").alias("x")).scalar()
    return own.select(
        "scheme",
        F.coalesce("system_message", system, F.lit(v.DEFAULT_SYSTEM_MESSAGE)).alias("system_message"),
        F.coalesce("user_message", user, F.lit(v.DEFAULT_USER_MESSAGE)).alias("user_message"),
    )


def render(template: Column, code_list: Column, decision_text: Column) -> Column:
    """Fill every ``{code_list}`` and ``{decision_text}`` in one pass.

    Doubled braces become single ones; any other brace is an error. Inserted
    text is never looked at again, so it may contain placeholders.
    """
    pieces = F.regexp_extract_all(
        template, F.lit(r"\{\{|\}\}|\{code_list\}|\{decision_text\}|[^{}]+"), F.lit(0)
    )
    filled = F.transform(
        pieces,
        lambda x: F.when(x == "{code_list}", code_list)
        .when(x == "{decision_text}", decision_text)
        .when(x == "{{", F.lit("{"))
        .when(x == "}}", F.lit("}"))
        .otherwise(x),
    )
    whole = F.length(F.array_join(pieces, "")) == F.length(template)
    return F.when(whole, F.array_join(filled, "")).otherwise(
        F.raise_error(F.concat(F.lit("unknown placeholder in prompt: "), template)).cast("string")
    )


def label_prompt(template: Column, code_list: Column, decision_text: Column) -> Column:
    """User message that asks for labels: the rendered prompt and the reply format."""
    return F.concat(render(template, code_list, decision_text), F.lit(v.REPLY_INSTRUCTION))


def impact_prompt(content: Column, label: Column) -> Column:
    return F.concat(
        F.lit("Policy text: "), content, F.lit("\nLabel: "), label,
        F.lit("\n\nProvide a structured impact assessment."),
    )


def impact_format() -> str:
    """What a plain text model has to be told: the fields of an assessment and their values."""
    directions, levels = (", ".join(f'"{x}"' for x in values) for values in (v.IMPACT_URIS, v.CONFIDENCE_LEVELS))
    return (
        "\n\nAnswer with one JSON object and nothing else. Its text fields are label, reasoning and summary, "
        f"impact_direction (one of {directions}) and confidence (one of {levels}); its lists of texts are "
        "direct_effects, second_order_effects and key_uncertainties. All eight fields have to be there."
    )


def random_labels(rows: DataFrame, codelist: DataFrame) -> DataFrame:
    """Columns of ``rows`` (scheme, decision, ..) and ``label``: one of the scheme that looks random, fixed by the decision (test provider).

    A hash of the decision names a position in the scheme's list, and the label there is joined by (scheme,
    position): no row holds a list. Rows of a scheme without labels are left out.
    """
    placed = with_positions(codelist).select("scheme", "label", F.col("ord").alias("_ord"))
    sizes = placed.groupBy("scheme").agg(F.count(F.lit(1)).alias("_size"))
    number = F.conv(F.substring(F.md5("decision"), 1, 8), 16, 10).cast("bigint")
    sized = spread_join(rows, sizes, ["scheme"], "inner", spread=["decision"])
    wanted = sized.withColumn("_ord", F.pmod(number, F.col("_size"))).drop("_size")
    found = spread_join(wanted, placed, ["scheme", "_ord"], "inner", spread=["decision"])
    return found.select(*rows.columns, "label")
