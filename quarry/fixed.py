"""Fixed values that must equal the curated-data semantics we reproduce.

Everything in this module is a literal the output depends on: role texts,
keyword lists, the prompt template and the recipe table. They are kept here
together, as plain text and in their natural order, so every other module
refers to them by name.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — keyword lists used by the chat builders.
# ---------------------------------------------------------------------------

# static_reviewer: a conversation qualifies when any of these occurs in the
# lowercased first 500 characters of its messages joined by one space.
REVIEW_KEYWORDS = ("python", "def ", "import ", "class ", ".py", "pytest", "pip install")

# performance_optimizer: the first message must contain one word of each group.
OPTIMIZATION_KEYWORDS = (
    "optimize", "optimise", "faster", "slow", "performance", "efficient",
    "efficiency", "speed up", "time complexity", "space complexity",
    "memory usage", "big o", "bottleneck", "profil",
)
OPTIMIZATION_LANG_KEYWORDS = ("python", "def ", "import ")

# security_auditor: accepted values of the lowercased, stripped `lang` column.
SECURITY_LANGS = ("python", "python3", "py")

# ---------------------------------------------------------------------------
# FIXED VALUES — constant instruction texts per role.
# ---------------------------------------------------------------------------

TEST_GENERATOR_INSTRUCTION = "Generate comprehensive Python unit tests for the following code."
TEST_GENERATOR_FALLBACK_INSTRUCTION = "Generate Python test assertions for the following function."
SECURITY_INSTRUCTION = (
    "Audit the following Python code for security vulnerabilities. "
    "Identify all issues with CWE references where applicable, "
    "explain the risks, and provide a secure implementation."
)
OPTIMIZATION_INSTRUCTION = (
    "Analyze the following Python code for performance issues and provide an "
    "optimized version with explanation."
)
DOCS_INSTRUCTION = (
    "Generate a comprehensive Python docstring for the following function. "
    "Include a description, Args, Returns, and Raises sections where applicable."
)

# ---------------------------------------------------------------------------
# FIXED VALUES — section headings of the builders' inputs and outputs.
# ---------------------------------------------------------------------------

# test_generator
PROBLEM_HEADING = "## Problem\n"
TASK_HEADING = "## Task\n"
IMPLEMENTATION_HEADING = "\n\n## Implementation\n```python\n"
# security_auditor
VULNERABILITY_HEADING = "## Vulnerability Context\n"
CODE_TO_AUDIT_HEADING = "\n\n## Code to Audit\n```python\n"
SECURITY_ANALYSIS_HEADING = "## Security Analysis\n"
SECURE_IMPLEMENTATION_HEADING = "\n\n## Secure Implementation\n```python\n"
# docs_generator, and the end of every code section
CODE_OPEN = "```python\n"
CODE_CLOSE = "\n```"

# ---------------------------------------------------------------------------
# FIXED VALUES — limits used by the builders.
# ---------------------------------------------------------------------------

MIN_OUTPUT_CHARS = 20        # code_writer output, docs_generator docstring
MAX_CODE_CHARS = 5000        # docs_generator code (inclusive)
MAX_UNIT_TESTS = 5           # test_generator: first five tests, then drop blanks
KEYWORD_WINDOW = 500         # static_reviewer: characters per message searched
MIN_TURNS = 2                # chat builders

# ---------------------------------------------------------------------------
# FIXED VALUES — prompt rendering.
# ---------------------------------------------------------------------------

# Instruction template; an empty input still prints its heading.
INSTRUCTION_HEADINGS = ("### Instruction:\n", "\n\n### Input:\n", "\n\n### Response:\n")
# Chat rendering without a tokenizer template: "<|role|>\ncontent", joined by "\n".
CHAT_ROLE_OPEN, CHAT_ROLE_CLOSE, CHAT_JOIN = "<|", "|>\n", "\n"
CHAT_DEFAULT_ROLE = "user"

# Packing: separator label and the fallback separator id.
IGNORE_LABEL = -100
DEFAULT_EOS_ID = 0

# ---------------------------------------------------------------------------
# FIXED VALUES — recipe table (role, format, max_seq_length, packing).
# ---------------------------------------------------------------------------

RECIPES = (
    ("code_writer", "instruction", 4096, True),
    ("test_generator", "instruction", 2048, True),
    ("static_reviewer", "chat", 4096, False),
    ("security_auditor", "instruction", 4096, True),
    ("performance_optimizer", "instruction", 4096, True),
    ("docs_generator", "instruction", 2048, True),
)
INSTRUCTION_FIELDS = {"instruction": "instruction", "input": "input", "output": "output"}
CHAT_FIELDS = {"messages": "messages"}

# Defaults of the split and the shuffle.
EVAL_FRACTION = 0.05
SEED = 42

# Metric monitors.
DIVERGENCE_THRESHOLD = 1.5
DIVERGENCE_PATIENCE = 3
GPU_HOUR_PRICE = 1.14          # configured price
GPU_HOUR_PRICE_DEFAULT = 1.10  # price when none is configured

# Storage schemes accepted by the URI resolver ("" = plain local path).
SUPPORTED_SCHEMES = ("s3", "", "file")

#: Sequence length of a role that is added without one (ours; no fixed value).
NEW_ROLE_MAX_LEN = 4096
