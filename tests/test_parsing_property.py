"""Property test: responses generated together with the outcome they must have."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from labelforge.functions.constants import LABEL_SCHEMA
from labelforge.operators import parsing as Rp

from .test_parsing import F3, VALID

# (value, diagnostic label, diagnostic code, strict label under the exact key)
VALUES = st.sampled_from(
    [(v, v, None, v) for v in VALID[:5]]
    + [(" Insurance ", "Insurance", None, "Insurance"), ("", None, "MISSING_LABEL_FIELD", ""),
       ("Not A Label", None, "INVALID_LABEL", "Not A Label"), ("NONE", None, "INVALID_LABEL", "NONE"),
       (None, None, "MISSING_LABEL_FIELD", None), (5, None, "INVALID_LABEL", None), (True, None, "INVALID_LABEL", None),
       (1.5, None, "INVALID_LABEL", None), ([1], None, "INVALID_LABEL", None), ({"a": 1}, None, "INVALID_LABEL", None)])
KEYS = st.sampled_from(["label", "Label", "LABEL", "category", "Class", "prediction"])
assert "NONE" in LABEL_SCHEMA


@st.composite
def case(draw):
    """(response, (label, code), strict label)"""
    kind = draw(st.sampled_from(["object", "object", "object", "junk", "text", "blank"]))
    if kind == "text":
        return "no braces", ("PARSING_ERROR", "NO_JSON_FOUND"), None
    if kind == "blank":
        return draw(st.sampled_from([None, "", "  "])), ("PARSING_ERROR", "NO_RESPONSE"), None
    key, (value, label, code, strict) = draw(KEYS), draw(VALUES)
    pairs = [("rationale", "r")] if draw(st.booleans()) else []
    exact = strict if key == "label" else None
    if draw(st.booleans()):                  # an earlier case variant of the key, overruled
        variant = key.swapcase() if key.swapcase() != key else key.upper()
        first = draw(VALUES)
        pairs.append((variant, first[0]))
        if variant == "label":
            exact = first[3]
    pairs.append((key, value))
    if draw(st.booleans()):
        pairs.append(("note", "n"))
    body = "{" + ", ".join(f"{json.dumps(k)}: {json.dumps(v)}" for k, v in pairs) + "}"
    if draw(st.booleans()):                  # inside a wrapper, where the strict parser does not look
        body = '{"%s": %s}' % (draw(st.sampled_from(["output", "response", "data", "result"])), body)
        exact = None
    if kind == "junk":
        return body + " }", ("PARSING_ERROR", "JSON_DECODE_ERROR"), None
    text = {"plain": body, "json_fence": f"{F3}json\n{body}\n{F3}", "fence": f"{F3}\n{body}\n{F3}",
            "prose": f"Answer: {body} -- done"}[draw(st.sampled_from(["plain", "json_fence", "fence", "prose"]))]
    return text, (label or "PARSING_ERROR", code), exact


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(case(), min_size=40, max_size=40))
def test_generated_responses_have_their_outcome(spark, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "item_id long, response string")
    d = Rp.with_strict_label(Rp.parse_diagnostics(df, labels=VALID), "response", "strict")
    got = {r["item_id"]: r for r in d.collect()}
    for i, (text, diag, strict) in enumerate(cases):
        assert (got[i]["pred_label"], got[i]["error_code"]) == diag, text
        assert got[i]["strict"] == strict, text
