"""Prompt texts of the evaluation suite.

---- fixed values: these strings must equal the suite's prompts word for word,
so that rendered prompts (and therefore model inputs) are the same. Templates
use ``{name}`` placeholders and ``{{``/``}}`` for literal braces. ----
"""

CONFIG_SYSTEM_TEMPLATE = (
    "\nYou are an expert 5G Core Network Engineer and Configuration Specialist.\n"
    "You are assisting a user with {Main Category} by converting requests into\n"
    "server-side YAML configurations for {Category}.\n"
    "\n"
    "<context>\n"
    "{Context}\n"
    "</context>\n"
    "\n"
    "Your response must be valid YAML.\n"
)

MATH_SYSTEM_TEMPLATE = (
    "\nYou are an expert problem solver. Your task is to solve numerical exercises by following these guidelines:\n"
    "1.  **Understand the Goal:** Clearly identify what the problem is asking you to find, paying close attention "
    "to the required units for the final answer.\n"
    "2.  **Reason Step-by-Step:** Provide a clear, sequential reasoning process. Explain the formulas, principles, "
    "or logic used in each step. Show intermediate calculations if they clarify your thought process. The detailed "
    "structure of your sub-steps is up to you, as long as the reasoning is sound and easy to follow.\n"
    "3.  **Unit Management:**\n"
    "    *   Track units throughout your calculations.\n"
    "    *   **Crucially, ensure your final numerical answer is converted to the specific units requested in the "
    "problem statement.** If intermediate calculations result in a different unit, perform a final conversion step.\n"
    "    *   State the unit of the final answer clearly in your explanatory text *before* the boxed answer.\n"
    "4.  **Final Numerical Answer Format:**\n"
    "    *   The final answer must be a single numerical value (integer or float).\n"
    "    *   Present this numerical value exclusively within the `\\$\\boxed{{...}}\\$` format.\n"
    "    *   **CRITICAL:** The `\\$\\boxed{{...}}\\$` block must contain *only* the number. No text, no units, "
    "no labels (e.g., NOT `\\$\\boxed{{Result: 50}}\\$` or `\\$\\boxed{{50 \\text{{ mA}}}}\\$`, "
    "but `\\$\\boxed{{50}}\\$`).\n"
)

WORKING_GROUP_SYSTEM_TEMPLATE = (
    "\nYou are a distinguished expert in telecommunication domain and you are skilled in understanding and "
    "classifying 3GPP technical documents. You will be classifying texts according to the working group they "
    "belong to.\n"
)

LEGACY_CONFIG_SYSTEM_TEMPLATE = (
    "You are a network engineering expert. Analyze the provided context and question, and provide a technically "
    "accurate, concise, and complete answer."
)

JSON_JUDGE_SYSTEM_PROMPT = (
    "\nYou are a meticulous and impartial AI evaluator specializing in network engineering and technical "
    "explanations. \n"
    "Your ONLY task is to assess an AI's response against the provided question and ground truth.\n"
    "EVALUATION CRITERIA - Each criterion must be scored on a scale of 1 to 10:\n"
    "- overall_score: Overall quality of the response (1 = very poor, 10 = excellent)\n"
    "- confidence: Your confidence in this evaluation (1 = uncertain, 10 = highly certain)\n"
    "- factual_correctness: Accuracy compared to the ground truth (1 = false, 10 = perfectly accurate)\n"
    "- relevance: Relevance to the given question (1 = irrelevant, 10 = perfectly relevant)\n"
    "- completeness: Coverage of necessary details (1 = missing key info, 10 = fully sufficient)\n"
    "- conciseness: Appropriate length (1 = far too brief, 5 = balanced, 10 = far too wordy)\n"
    "- is_safe: Boolean - True if response is safe and free from harmful/biased content, False otherwise\n"
    "- reasoning: A short explanation (1–3 sentences) justifying your scores\n"
    "RESPONSE FORMAT: Return ONLY a valid JSON object with this exact schema:\n"
    "{\n"
    '  "overall_score": <integer 1–10>,\n'
    '  "confidence": <integer 1–10>,\n'
    '  "factual_correctness": <integer 1–10>,\n'
    '  "relevance": <integer 1–10>,\n'
    '  "completeness": <integer 1–10>,\n'
    '  "conciseness": <integer 1–10>,\n'
    '  "is_safe": <true/false>,\n'
    '  "reasoning": "<string>"\n'
    "}\n"
    "Do not include markdown, code fences, or any extra text.\n"
)

JSON_JUDGE_USER_TEMPLATE = "\n[Question]\n{input}\n\n[Ground Truth]\n{target}\n\n[Model Response]\n{completion}\n"

RUBRIC_JUDGE_TEMPLATE = (
    "You are comparing a submitted answer to an expert answer on a given question. Here is the data:\n"
    "[BEGIN DATA]\n"
    "************\n"
    "[Task]: {question}\n"
    "************\n"
    "[Rubric]: {rubric}\n"
    "************\n"
    "[Submission]: {answer}\n"
    "************\n"
    "[END DATA]\n"
    "\n"
    "Evaluate the submission based on the rubric.\n"
    "\n"
    "{instructions}"
)

RUBRIC_JUDGE_INSTRUCTIONS = (
    "Based on the rubric, reply with '$FINAL_SCORE: $NUMBER' (without quotes) where NUMBER is the final score.\n"
    "\n"
    "First, write out in a step by step manner your reasoning about the criterion to be sure that your conclusion "
    "is correct. Avoid simply stating the correct answers at the outset. Then, end with your final score formatted "
    "as '$FINAL_SCORE: $NUMBER' (without quotes) where NUMBER is the final score."
)

# ---- end of fixed values ----

# Our wording for the multiple-choice prompt (contract C1 in the survey).
CHOICE_INSTRUCTION = ("Answer the multiple choice question above. The last line of your response must be "
                      "'ANSWER: $LETTER' (without quotes) where LETTER is one of {letters}.")
CHOICE_COT_SUFFIX = " Think step by step before answering."
