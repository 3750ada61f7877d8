"""Prompt building: system prompts, choice prompts, grader prompts, message
arrays and conversation transcripts. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalframe.functions import prompt_texts as T
from evalframe.functions.templates import render


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_system_prompt(template: str, fields: dict[str, str | Column]) -> Column:
    """A system prompt filled from row columns in one pass (see templates)."""
    return render(template, fields)


def choice_lines(choices) -> Column:
    """``A) first``, ``B) second`` ... joined by newlines, in array order."""
    return F.array_join(F.transform(_col(choices), lambda c, i: F.concat(F.chr(F.lit(65) + i), F.lit(") "), c)),
                        "\n")


def choice_letters(choices) -> Column:
    return F.array_join(F.transform(_col(choices), lambda c, i: F.chr(F.lit(65) + i)), ",")


def render_choice_prompt(question, choices, cot: bool = False) -> Column:
    """Question, lettered choices, then the answer-format instruction."""
    instr = T.CHOICE_INSTRUCTION + (T.CHOICE_COT_SUFFIX if cot else "")
    return F.concat(_col(question), F.lit("\n\n"), choice_lines(choices), F.lit("\n\n"),
                    render(instr, {"letters": choice_letters(choices)}))


def render_judge_prompt(question, rubric, answer, template: str = T.RUBRIC_JUDGE_TEMPLATE,
                        instructions: str = T.RUBRIC_JUDGE_INSTRUCTIONS) -> Column:
    return render(template, {"question": _col(question), "rubric": _col(rubric), "answer": _col(answer),
                             "instructions": F.lit(instructions)})


def build_judge_messages(input_col, target_col, completion_col) -> Column:
    """``array<struct<role, content>>``: the JSON grader's system message and
    the user message holding question, ground truth and response."""
    user = render(T.JSON_JUDGE_USER_TEMPLATE, {"input": _col(input_col), "target": _col(target_col),
                                               "completion": _col(completion_col)})
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(T.JSON_JUDGE_SYSTEM_PROMPT).alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))


def assemble_transcript(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", sep: str = "\n\n",
                        piece_turns: int = 256) -> DataFrame:
    """One row per conversation: ``role: text`` of every turn in turn order.

    The transcript is itself the whole group, so its bytes must meet in one
    row; the work does not have to. Turns are first sorted and joined in
    pieces of ``piece_turns`` consecutive turns (bounded groups spread over
    tasks); the per-conversation step only orders and joins piece strings. A row
    holds at most 2 GiB, so a longer conversation fails instead of being cut."""
    line = F.concat(F.col(role_col), F.lit(": "), F.coalesce(F.col(text_col), F.lit("")))
    piece = (turns.select(conv_col, F.col(turn_col).alias("_turn"), line.alias("_line"),
                          F.floor(F.col(turn_col) / F.lit(piece_turns)).alias("_piece"))
             .groupBy(conv_col, "_piece")
             .agg(F.array_sort(F.collect_list(F.struct("_turn", "_line"))).alias("_t"))
             .select(conv_col, "_piece", F.size("_t").alias("_n"),
                     F.array_join(F.transform("_t", lambda x: x["_line"]), sep).alias("_text")))
    return (piece.groupBy(conv_col)
            .agg(F.array_sort(F.collect_list(F.struct("_piece", "_text"))).alias("_p"),
                 F.sum("_n").cast("bigint").alias("n_turns"))
            .select(conv_col, "n_turns", F.array_join(F.transform("_p", lambda x: x["_text"]), sep).alias("transcript")))


def last_completion(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The final assistant message of each conversation (partial aggregate:
    only one candidate per conversation crosses the shuffle per map task)."""
    return (turns.filter(F.col(role_col) == "assistant").groupBy(conv_col)
            .agg(F.max_by(F.col(text_col), F.col(turn_col)).alias("completion"),
                 F.max(turn_col).alias("turn")))
