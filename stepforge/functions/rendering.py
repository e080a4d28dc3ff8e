"""Texts built from sample columns: requests, prompts, answers, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.functions import regions as R
from stepforge.functions import text as T


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def quoted_text(c: Column, controls: bool = True) -> Column:
    """Text in single quotes, in double quotes when it holds a single quote.

    Without ``controls`` line ends and tabs stay as they are.
    """
    escaped = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    if controls:
        escaped = F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    single = F.contains(c, F.lit("'"))
    double = F.contains(c, F.lit('"'))
    return (
        F.when(single & ~double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def reasoning_request(task: Column, screen_text: Column, action_type: Column, step_index: Column,
                      total_steps: Column, description: Column, coordinates: Column,
                      text: Column, previous_action: str = "none", verbatim: bool = False) -> Column:
    """User part of an annotation request.

    ``verbatim``: an empty screen text stays empty, control characters of the typed text
    are not escaped, and where a line is NULL so is the request.
    """
    number = lambda x: F.when(x.isNotNull(), T.fixed(x, 3))
    point = F.when(
        F.size(coordinates) > 0,
        F.concat(F.lit("Coordinates: ["), number(coordinates[0]), F.lit(", "), number(coordinates[1]), F.lit("]")),
    ).otherwise("Coordinates: N/A")
    typed = F.when(_blank(text) != "", F.concat(F.lit("Text: "), quoted_text(text, not verbatim))).otherwise("Text: N/A")
    start = F.substring(screen_text, 1, D.REQUEST_TEXT_CHARS)
    screen = start if verbatim else F.when(_blank(screen_text) != "", start).otherwise("No OCR text available")
    described = F.when(_blank(description) != "", description).otherwise("no description")
    # ---- fixed values: request layout ----
    lines = [
        F.concat(F.lit("TASK: "), task),
        F.lit(""),
        F.lit("CURRENT SCREEN (OCR text detected):"),
        screen,
        F.lit(""),
        F.lit("ACTION TAKEN:"),
        F.concat(F.lit("  Type: "), action_type),
        F.concat(F.lit("  "), point),
        F.concat(F.lit("  "), typed),
        F.concat(F.lit("  Description: "), described),
        F.lit(""),
        F.lit("STEP CONTEXT:"),
        F.concat(F.lit("  Step number: "), step_index.cast("string")),
        F.concat(F.lit("  Total steps seen so far: "), total_steps.cast("string")),
        F.lit(f"  Previous action: {previous_action}"),
        F.lit(""),
        F.lit("Write the reasoning annotation for this action."),
    ]
    # concat_ws skips NULL lines, concat does not
    return F.concat(*[x for line in lines for x in (F.lit("\n"), line)][1:]) if verbatim else F.concat_ws("\n", *lines)


def total_steps(step_index: Column) -> Column:
    return F.greatest(step_index + 1, F.lit(5))


def difficulty_request(task: Column, total: Column, action_type: Column, step_index: Column,
                       n_regions: Column) -> Column:
    # ---- fixed values: request layout ----
    return F.concat_ws(
        "\n",
        F.concat(F.lit("TASK: "), task),
        F.concat(F.lit("TOTAL STEPS IN TRAJECTORY: "), total.cast("string")),
        F.concat(F.lit("ACTION TYPE: "), action_type),
        F.concat(F.lit("SCREEN COMPLEXITY: "), n_regions.cast("string"), F.lit(" text regions detected")),
        F.concat(F.lit("STEP INDEX: "), step_index.cast("string"), F.lit(" of "), total.cast("string")),
    )


def human_turn(task: Column, step_index: Column, regions: Column, raw_text: Column,
               action_type: Column, coordinates: Column, description: Column,
               stage: Column, previous_description: Column | None = None) -> Column:
    """Prompt side of a training example.

    The planning line repeats the row's own description unless
    ``previous_description`` (for instance a lag over the session) is given.
    """
    chosen = F.transform(R.prompt_regions(regions, action_type, coordinates), R.region_line)
    screen = (
        F.when(F.size(regions) > 0, F.array_join(F.concat(F.array(F.lit("\nScreen content:")), chosen), "\n"))
        .when(_blank(raw_text) != "", F.concat(F.lit("\nScreen text: "), F.substring(raw_text, 1, D.RAW_TEXT_CHARS)))
    )
    previous = description if previous_description is None else previous_description
    planning = F.when(
        stage == D.STAGE_PLANNING,
        F.concat(F.lit("\nPrevious action description: "), _blank(previous)),
    )
    # concat_ws skips the NULL parts
    return F.concat_ws(
        "\n",
        F.lit("<image>"),
        F.concat(F.lit("Task: "), task),
        F.concat(F.lit("Step: "), step_index.cast("string")),
        screen,
        planning,
        F.lit("\nWhat is the next action?"),
    )


def action_json(action_type: Column, coordinates: Column, text: Column, key: Column,
                description: Column) -> Column:
    """Action object with ', ' and ': ' separators; absent parts left out."""
    point = F.when(
        F.size(coordinates) >= 2,
        F.concat(F.lit('"coordinates": ['), T.decimal_text(coordinates[0]), F.lit(", "),
                 T.decimal_text(coordinates[1]), F.lit("]")),
    )
    field = lambda name, c: F.concat(F.lit(f'"{name}": '), T.json_string(c))
    parts = F.concat_ws(
        ", ",
        field("type", action_type),
        point,
        F.when(text.isNotNull(), field("text", text)),
        F.when(key.isNotNull(), field("key", key)),
        F.when(_blank(description) != "", field("description", description)),
    )
    return F.concat(F.lit("{"), parts, F.lit("}"))


def fallback_reasoning(task: Column, description: Column) -> Column:
    return F.concat(
        F.lit("Looking at the current screen for the task: "), task,
        F.lit(". The next action is to "), F.lower(description), F.lit("."),
    )


def assistant_turn(task: Column, reasoning: Column, description: Column, action: Column) -> Column:
    thought = (
        F.when(F.length(T.strip(_blank(reasoning))) > 10, T.strip(reasoning))
        .when(F.length(T.strip(_blank(description))) > 5, fallback_reasoning(task, description))
        .otherwise(F.concat(F.lit("Executing the next required step for: "), task, F.lit(".")))
    )
    return F.concat(
        F.lit("<think>\n"), thought, F.lit("\n</think>\n<action>"), action, F.lit("</action>")
    )


def stage_prompt(stage: Column, agent: str = D.AGENT_NAME) -> Column:
    texts = {s: p.format(agent=agent) for s, p in D.STAGE_PROMPTS.items()}
    return F.coalesce(
        *[F.when(stage == s, F.lit(p)) for s, p in texts.items()],
        F.lit(texts[D.STAGE_ACTION]),
    )


def example_line(human: Column, assistant: Column, image: Column, system: Column) -> Column:
    """One training example as a JSON line."""
    return F.concat(
        F.lit('{"conversations": [{"from": "human", "value": '), T.json_string(human),
        F.lit('}, {"from": "gpt", "value": '), T.json_string(assistant),
        F.lit('}], "images": ['), T.json_string(image),
        F.lit('], "system": '), T.json_string(system), F.lit("}"),
    )


def legacy_action_json(action_type: Column, coordinates: Column, text: Column, key: Column,
                       direction: Column, amount: Column, description: Column) -> Column:
    """Two-space indented action object, ASCII only."""
    point = F.when(
        F.size(coordinates) >= 2,
        F.concat(F.lit('  "coordinates": [\n    '), T.decimal_text(coordinates[0]),
                 F.lit(",\n    "), T.decimal_text(coordinates[1]), F.lit("\n  ]")),
    )
    field = lambda name, c: F.concat(F.lit(f'  "{name}": '), T.json_string_ascii(c))
    steps = F.when(F.coalesce(amount, F.lit(0)) == 0, 3).otherwise(amount)
    described = F.when(_blank(description) != "", description).otherwise(
        F.concat(F.lit("Performing "), action_type)
    )
    parts = F.concat_ws(
        ",\n",
        field("type", action_type),
        point,
        F.when(text.isNotNull(), field("text", text)),
        F.when(key.isNotNull(), field("key", key)),
        F.when(direction.isNotNull(), field("direction", direction)),
        F.when(direction.isNotNull(), F.concat(F.lit('  "amount": '), steps.cast("string"))),
        field("description", described),
    )
    return F.concat(F.lit("{\n"), parts, F.lit("\n}"))


def legacy_answer(task: Column, action_type: Column, reasoning: Column, description: Column,
                  action: Column) -> Column:
    goal = F.when(_blank(description) != "", description).otherwise(action_type)
    thought = F.when(_blank(reasoning) != "", reasoning).otherwise(
        F.concat(F.lit("I need to "), goal, F.lit(" to complete the task: "), task)
    )
    return F.concat(
        F.lit("<think>\n"), thought, F.lit("\n</think>\n<action>\n"), action, F.lit("\n</action>")
    )


def legacy_question(task: Column) -> Column:
    return F.concat(
        F.lit("<image>\nTask: "), task, F.lit("\n\nWhat is the next action to complete this task?")
    )


def prebuilt_answer(reasoning: Column, action: Column) -> Column:
    thought = F.when(
        _blank(reasoning) != "", F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n"))
    ).otherwise("")
    return F.concat(thought, F.lit("<action>\n"), action, F.lit("\n</action>"))


def prebuilt_question(task: Column) -> Column:
    return F.concat(F.lit("<image>\nTask: "), task, F.lit("\nNext action?"))


def legacy_example_line(system: Column, user: Column, assistant: Column, image: Column) -> Column:
    turn = lambda role, c: F.concat(F.lit(f'{{"role": "{role}", "value": '), T.json_string(c), F.lit("}"))
    return F.concat(
        F.lit('{"conversations": ['), turn("system", system), F.lit(", "), turn("user", user),
        F.lit(", "), turn("assistant", assistant), F.lit('], "images": ['), T.json_string(image),
        F.lit("]}"),
    )


def change_type(ratio: Column, active_regions: Column) -> Column:
    """Kind of screen change from the changed share and the number of active regions."""
    return (
        F.when(ratio < 0.001, "no_change")
        .when(ratio < 0.02, "minor_change")
        .when(ratio > 0.50, "full_screen")
        .when((ratio > 0.15) & (active_regions >= 5), "layout_shift")
        .when(ratio.between(0.05, 0.15) & (active_regions <= 2), "new_element")
        .when(ratio.between(0.02, 0.05), "text_update")
        .otherwise("minor_change")
    )


def active_regions(ratios: Column) -> Column:
    """How many of the nine region ratios exceed the activity threshold."""
    return F.size(F.filter(ratios, lambda r: r > D.ACTIVE_REGION))


def ranked_regions(ratios: Column) -> Column:
    """Names of changed regions, most changed first, ties in grid order."""
    ranked = F.array_sort(
        F.transform(
            F.arrays_zip(ratios.alias("ratio"), F.array(*[F.lit(n) for n in D.SCREEN_REGIONS]).alias("name")),
            lambda r, i: F.struct((-r["ratio"]).alias("rank"), i.alias("position"), r["name"].alias("name")),
        )
    )
    return F.transform(F.filter(ranked, lambda r: r["rank"] < 0), lambda r: r["name"])


def most_changed(ratios: Column) -> Column:
    best = F.array_max(ratios)
    return F.element_at(
        F.array(*[F.lit(n) for n in D.SCREEN_REGIONS]), F.array_position(ratios, best).cast("int")
    )


def change_summary(kind: Column, changed: Column, ratio: Column) -> Column:
    where = F.when(F.size(changed) > 0, F.array_join(F.slice(changed, 1, 3), ", ")).otherwise("unknown area")
    share = F.concat(T.fixed(ratio * 100, 1), F.lit("%"))
    # ---- fixed values: summary sentences ----
    return (
        F.when(kind == "no_change", "No meaningful change detected")
        .when(kind == "minor_change", F.format_string("Minor change in %s — likely cursor or clock (%s of pixels)", where, share))
        .when(kind == "text_update", F.format_string("Text updated in %s (%s of pixels changed)", where, share))
        .when(kind == "new_element", F.format_string("New element appeared in %s (%s of pixels changed)", where, share))
        .when(kind == "element_removed", F.format_string("Element removed from %s (%s of pixels changed)", where, share))
        .when(kind == "layout_shift", F.format_string("Major layout change across %s — possible new window (%s)", where, share))
        .when(kind == "full_screen", F.format_string("Full screen change — application likely switched (%s)", share))
        .otherwise("Unknown screen change detected")
    )
