"""Pure-Python twin of the fixture stub predictor (used inside mapInPandas)."""

from __future__ import annotations

from ..functions.constants import LABEL_SCHEMA, PY_WHITESPACE


def stub_text(item_id: int, label: str | None, k: int) -> str | None:
    shape = (item_id * 17 + k * 5) % 22
    gold = label.strip(PY_WHITESPACE) if label is not None else "NONE"
    wrong = LABEL_SCHEMA[(item_id * 7 + k) % 38]

    def obj(x):
        return '{"rationale": "r", "label": "' + x + '"}'
    if shape <= 4:
        return obj(gold)
    if shape <= 6:
        return obj(wrong)
    return {
        7: "```json\n" + obj(gold) + "\n```",
        8: "Here is my analysis: " + obj(gold) + " Hope this helps.",
        9: '{"output": {"Category": "' + gold + '"}}',
        10: '{"label": "' + gold + '"} trailing }',
        11: "{'label': '" + gold + "'}",
        12: "no json here",
        13: None,
        14: '{"label": null}',
        15: '{"label": "Not A Label"}',
        16: "[" + obj(gold) + "] or [" + obj(wrong) + "]",
        17: obj(gold) + '] junk [{"x": 1}',
        18: obj(gold) + "]}",
        19: obj(gold) + "][{}",
        20: '{"label": "' + gold + '", "LABEL": "' + wrong + '"}',
        21: '{"LABEL": "' + wrong + '", "label": "' + gold + '"}',
    }[shape]
