"""Prompt and request assembly.

All wording is our own; a user who needs other text passes other templates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quillgate.functions import text

# -- template text (fixed values) --------------------------------------------

TONE_GUIDES = {
    "formal": "Write formally: full sentences, polite requests, precise terms.",
    "direct": "Write directly: open with an imperative verb and keep clauses short.",
    "casual": "Write casually: sound like a colleague proposing an idea to the team.",
}

SCHEDULE_GUIDE = (
    "State when it runs: daily, weekly, monthly or every few hours, with a start and, if useful, an end."
)

COMPLEXITY_GUIDES = {
    "simple": (
        "Name one customer segment from one or two indicators, one action and one schedule. "
        "Use 25 to 50 words on one line and no comparison symbols."
    ),
    "medium": (
        "Combine the indicators into one segment, add a conditional reward, a limit on the "
        "audience and a schedule. Use 50 to 75 words on one line and no comparison symbols."
    ),
    "complex": (
        "Use some indicators for the segment and the others for branches with different offers, "
        "add exclusions and exact dates. Use 75 to 110 words on one line and no comparison symbols."
    ),
}

KPI_HEADER = "Indicators to build on:"
KPI_FOOTER = "Put these indicators into everyday business language."
GENERATE_OPENING = "You write one campaign instruction for a telecom operator."
GENERATE_CLOSING = "Answer with the instruction alone."

EXTRACT_SYSTEM = (
    "Turn a campaign instruction into JSON with two fields: normal_statements, a list of "
    "self-contained statements, one per branch and without any timing, and schedule, the timing "
    "text or an empty string."
)
EXTRACT_USER = "Structure this instruction:\n"

#: the JSON schema sent with an extraction request
OUTPUT_SCHEMA = (
    '{"type":"object","properties":{"normal_statements":{"type":"array",'
    '"items":{"type":"string"}},"schedule":{"type":"string"}},'
    '"required":["normal_statements","schedule"]}'
)

FEEDBACK_OPENING = "Structure this instruction again and settle the feedback."
NO_FEEDBACK = "The judges left no remark."

JUDGE_FAITHFULNESS = (
    "Do the statements cover every targeting rule, action, condition and limit of the "
    "instruction, and nothing else? Timing is kept apart, so ignore it. "
    "Begin the answer with YES or NO and give a short reason."
)
JUDGE_SCHEDULE = (
    "Does the schedule text hold exactly the timing of the instruction and no targeting or "
    "action? Begin the answer with YES or NO and give a short reason."
)

# Word range, forbidden marks and forbidden words the prompts ask
# for.
CONTRACT_WORDS = {"simple": (25, 50), "medium": (50, 75), "complex": (75, 110)}
CONTRACT_MARKS = {
    "simple": ["<", ">", "=="],
    "medium": ["<", ">", "&&", "||"],
    "complex": ["<", ">", "!", "&&", "||"],
}
CONTRACT_BANNED = {"simple": ["AND", "OR"], "medium": [], "complex": []}


def by_value(key: Column, table: dict, default) -> Column:
    """Constant look-up by a handful of known keys."""
    out = reduce(
        lambda acc, item: F.when(key == item[0], F.lit(item[1])).otherwise(acc),
        table.items(),
        F.lit(default),
    )
    return out


# -- generation --------------------------------------------------------------


def kpi_section(kpis: Column) -> Column:
    """``KPI i: description`` blocks in draw order between header and footer."""
    blocks = F.transform(
        kpis,
        lambda k, i: F.concat(
            F.lit("KPI "), (i + 1).cast("string"), F.lit(": "), F.coalesce(k["description"], F.lit(""))
        ),
    )
    return F.concat_ws("\n\n", F.lit(KPI_HEADER), F.array_join(blocks, "\n\n"), F.lit(KPI_FOOTER))


def generation_prompt(kpis: Column, complexity: Column, tone: Column) -> Column:
    """Whole generation prompt; unknown complexities use the complex guide."""
    return F.concat_ws(
        "\n\n",
        F.lit(GENERATE_OPENING),
        kpi_section(kpis),
        by_value(tone, TONE_GUIDES, ""),
        F.lit(SCHEDULE_GUIDE),
        F.concat(F.lit("Complexity: "), F.upper(complexity)),
        by_value(complexity, COMPLEXITY_GUIDES, COMPLEXITY_GUIDES["complex"]),
        F.lit(GENERATE_CLOSING),
    )


# -- extraction --------------------------------------------------------------


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def generation_messages(prompt: Column) -> Column:
    return F.array(message("user", prompt))


def extraction_user(utterance: Column) -> Column:
    return F.concat(F.lit(EXTRACT_USER), utterance)


def extraction_messages(user: Column) -> Column:
    """System and user message of an extraction request."""
    return F.array(message("system", F.lit(EXTRACT_SYSTEM)), message("user", user))


def request_text(messages: Column) -> Column:
    """One text per request, the key and payload of a completion call."""
    return F.array_join(
        F.transform(messages, lambda m: F.concat(m["role"], F.lit(":\n"), m["content"])), "\n\n"
    )


def feedback_lines(metric_results: Column, metrics: list[str]) -> Column:
    """``- Metric: reason`` per metric that gave a reason, else the fallback."""
    lines = [
        F.when(
            F.coalesce(metric_results[m]["reason"], F.lit("")) != "",
            F.concat(F.lit("- "), F.initcap(F.lit(m)), F.lit(": "), metric_results[m]["reason"]),
        )
        for m in metrics
    ]
    joined = F.concat_ws("\n", *lines)
    return F.when(joined == "", F.lit(NO_FEEDBACK)).otherwise(joined)


def feedback_prompt(
    utterance: Column, previous_json: Column, metric_results: Column, metrics: list[str]
) -> Column:
    return F.concat_ws(
        "\n\n",
        F.lit(FEEDBACK_OPENING),
        F.concat(F.lit("Instruction:\n"), utterance),
        F.concat(F.lit("Previous result:\n"), previous_json),
        F.concat(F.lit("Feedback:\n"), feedback_lines(metric_results, metrics)),
    )


# -- judging -----------------------------------------------------------------


def joined_statements(statements: Column) -> Column:
    return F.array_join(F.coalesce(statements, F.array().cast("array<string>")), "\n")


def faithfulness_prompt(utterance: Column, statements: Column) -> Column:
    return F.concat_ws(
        "\n\n",
        F.lit(JUDGE_FAITHFULNESS),
        F.concat(F.lit("Instruction:\n"), utterance),
        F.concat(F.lit("Statements:\n"), joined_statements(statements)),
    )


def schedule_prompt(utterance: Column, schedule: Column) -> Column:
    return F.concat_ws(
        "\n\n",
        F.lit(JUDGE_SCHEDULE),
        F.concat(F.lit("Instruction:\n"), utterance),
        F.concat(F.lit("Schedule:\n"), F.coalesce(schedule, F.lit(""))),
    )


# -- contract audit ----------------------------------------------------------


def audit_contract(records: DataFrame) -> DataFrame:
    """What the generation prompt asks for, checked: length, marks, one line."""
    complexity, utterance = F.col("complexity"), F.col("utterance")

    def marked(name: str) -> Column:
        found = text.contains_any(utterance, CONTRACT_MARKS[name])
        for word in CONTRACT_BANNED[name]:
            found = found | F.array_contains("_words", word)
        return found

    def by_class(value) -> Column:
        return (
            F.when(complexity == "simple", value("simple"))
            .when(complexity == "medium", value("medium"))
            .otherwise(value("complex"))
        )

    counted = records.withColumn("_words", text.words(utterance)).withColumns({
        "n_words": F.size("_words"),
        "has_marks": by_class(marked),
        "many_lines": text.has_line_end(text.strip(utterance)),
    })
    in_range = by_class(lambda name: F.col("n_words").between(*CONTRACT_WORDS[name]))
    return counted.drop("_words").withColumn("bad_length", ~in_range).withColumn(
        "in_contract", ~(F.col("bad_length") | F.col("has_marks") | F.col("many_lines"))
    )


def contract_summary(audited: DataFrame) -> DataFrame:
    return audited.groupBy("complexity").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if("bad_length").alias("bad_length"),
        F.count_if("has_marks").alias("has_marks"),
        F.count_if("many_lines").alias("many_lines"),
        F.count_if("in_contract").alias("in_contract"),
    )
