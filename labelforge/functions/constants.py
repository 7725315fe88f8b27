"""Fixed values that must equal the source workflow's for byte-identical output.

Everything here is data, kept as plain text in its natural order.
"""

# --- fixed values: ordered label schema (38 labels, NONE last) -------------
LABEL_SCHEMA = [
    "Anti-Assignment",
    "Audit Rights",
    "Cap on Liability",
    "Change of Control",
    "Competitive Restriction Exception",
    "Covenant Not to Sue",
    "Effective Date",
    "Exclusivity",
    "Expiration Date",
    "Governing Law",
    "Insurance",
    "IP Ownership Assignment",
    "Joint IP Ownership",
    "License Grant",
    "Liquidated Damages",
    "Minimum Commitment",
    "Most Favored Nation",
    "Non-Compete",
    "Non-Disparagement",
    "Non-Solicit of Customers",
    "Non-Solicit of Employees",
    "Non-Transferable License",
    "Notice to Terminate Renewal",
    "Post-Termination Services",
    "Price Restriction",
    "Renewal Term",
    "Revenue/Profit Sharing",
    "Right of First Refusal",
    "Source Code Escrow",
    "Termination for Convenience",
    "Third Party Beneficiary",
    "Uncapped Liability",
    "Volume Restriction",
    "Warranty Duration",
    "Affiliate License-Licensee",
    "Affiliate License-Licensor",
    "Irrevocable License",
    "NONE",
]
NONE_LABEL = "NONE"
PARSING_ERROR = "PARSING_ERROR"

# --- fixed values: classification prompt (JSON object, keys in this order) --
CLASSIFY_TASK = "classify_legal_clause"
CLASSIFY_INSTRUCTIONS = (
    "Analyze the legal clause and provide a detailed rationale for why it belongs to a specific "
    "category, then classify it according to the provided schema. IMPORTANT: First explain your "
    "reasoning thoroughly, then provide the label. Your output must be valid JSON. Example format: "
    '{"rationale": "This clause describes... because...", "label": "Termination for Convenience"}'
)
SCHEMA_RATIONALE_DESC = "Detailed explanation of why the clause belongs to this category"
SCHEMA_LABEL_DESC = "The classification category from the list of valid labels"

# --- fixed values: rationale-generation prompt ------------------------------
RATIONALE_PROMPT_TEMPLATE = """[[TASK]]
Analyze the contract clause below and provide a rationale for its classification.

[[CONTEXT]]
CLAUSE: {clause}

CLAUSE WITH CONTEXT: {clause_with_context}

CONTRACT TYPE: {contract_type}

CLASSIFICATION: {label}

[[INSTRUCTIONS]]
Explain WHY this clause was classified as '{label}'. Identify specific language or elements in the clause that led to this categorization. If the classification is "NONE", explain why it doesn't fall into any contract category.

Take your time to think through all aspects carefully. Consider:
1. Key terms and phrases in the clause
2. Function of this clause in a contract
3. How it relates to the contract type
4. Why it fits or doesn't fit specific categories

[[FORMAT]]
Your response should be:
- Concise
- Focus on specific clause language that justifies the classification
- Include legal reasoning where appropriate
- Formatted with Markdown for readability"""

# --- fixed values: teacher messages (system + two few-shot pairs) -----------
TEACHER_SYSTEM = (
    "You are an expert legal AI. Your task is to analyze a legal clause and classify it. Your ONLY "
    "output must be a single, valid JSON object with 'rationale' and 'label' keys. Do not include "
    "markdown fences, explanations, or any other text outside the JSON structure."
)
FEW_SHOT = [
    ("user", '{"task": "classify_legal_clause", "inputs": {"clause": "This Agreement shall be governed by the laws of the State of Delaware."}}'),
    ("assistant", '{"rationale": "The clause explicitly states that the agreement is governed by the laws of a specific jurisdiction, which is the defining characteristic of a Governing Law provision.", "label": "Governing Law"}'),
    ("user", '{"task": "classify_legal_clause", "inputs": {"clause": "The parties shall meet on the first Monday of each month to review progress."}}'),
    ("assistant", '{"rationale": "This clause describes a routine operational arrangement but does not pertain to any of the specified legal categories.", "label": "NONE"}'),
]

# --- fixed values: chat turn markers -----------------------------------------
USER_TURN_MARKER = "<start_of_turn>user\n"
MODEL_TURN_MARKER = "<start_of_turn>model\n"

# --- fixed values: parser diagnostics ---------------------------------------
RAW_SNIPPET_CHARS = 600
DIAG_NO_RESPONSE = ("NO_RESPONSE", "Model returned empty response.")
DIAG_NO_JSON = ("NO_JSON_FOUND", "Could not find brace-delimited JSON in response.")
DIAG_DECODE = ("JSON_DECODE_ERROR", "JSONDecodeError: invalid JSON")
DIAG_MISSING = ("MISSING_LABEL_FIELD", "Parsed JSON but no usable 'label' found.")
DIAG_INVALID = "INVALID_LABEL"  # detail: Label '<x>' not in valid label set.
LABEL_KEY_WRAPPERS = ["output", "response", "data", "result"]
LABEL_KEY_NAMES = ["label", "category", "class", "prediction"]

# --- fixed values: simple parser outcomes -----------------------------------
SIMPLE_DEFAULT = "N/A"
SIMPLE_NO_OBJECT = "Parsing Error"
SIMPLE_BAD_JSON = "JSON Error"
SIMPLE_NULL_INPUT = "Unknown Error: 'NoneType' object has no attribute 'find'"

# --- fixed values: prediction records, generation defaults ------------------
RESPONSE_TRUNCATE = 500
INFERENCE_ERROR_PREFIX = "Error during inference: "
SKIPPED_RESPONSE = "Skipped: predictor not configured."
GEN_DEFAULTS = {"model": "deepseek/deepseek-r1", "temperature": 0.6, "top_p": 0.95, "max_tokens": 1500}

# --- fixed values: run summary bands ----------------------------------------
STATUS_BANDS = [(0.8, "Excellent"), (0.6, "Good")]
STATUS_ELSE = "Needs Improvement"

# --- fixed values: sequence budgets and training step parameters ------------
MAX_SEQ_LENGTH = {"1b": 1024, "4b": 2048, "12b": 4096}
BATCH_SIZE = 2
GRAD_ACCUMULATION = 4
NUM_EPOCHS = 2

# --- fixed values: split file names ------------------------------------------
SPLIT_FILE_SUFFIX = "_data_with_rationales.jsonl"

# Python's str.strip() whitespace set, derived by rule from the interpreter.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
