"""Deterministic stand-ins for models, with the same behaviour as SQL text."""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle

LABELS = ("High quality", "low_quality", "Tox", "nonsense")

# Replies by document: plain JSON, fenced, inside chatter, bare list, wrong types, garbage.
_Q, _BS, _NL, _FENCE = "chr(34)", "chr(92)", "chr(10)", "repeat(chr(96), 3)"
_CLASSES = f"concat('[', {_Q}, source, {_Q}, ', ', {_Q}, 'say ', {_BS}, {_Q}, 'hi', {_BS}, {_Q}, {_Q}, ']')"
_OBJECT = f"concat('{{', {_Q}, 'designated_classes', {_Q}, ': ', {_CLASSES}, ', ', {_Q}, 'n', {_Q}, ': 1}}')"


def _only(value: str) -> str:
    return f"concat('{{', {_Q}, 'designated_classes', {_Q}, ': {value}}}')"


_A = f"concat({_Q}, 'a', {_Q})"
REPLY_SQL = (
    f"CASE doc_id % 12 WHEN 0 THEN {_OBJECT} "
    f"WHEN 1 THEN concat('Sure:', {_NL}, {_FENCE}, 'json', {_NL}, {_OBJECT}, {_NL}, {_FENCE}, ' done') "
    f"WHEN 2 THEN concat('I think ', {_OBJECT}, ' fits') "
    f"WHEN 3 THEN {_CLASSES} "
    f"WHEN 4 THEN {_only('[1, 2]')} "
    f"WHEN 5 THEN concat('no json in ', text) "
    f"WHEN 6 THEN {_only('[]')} "
    f"WHEN 7 THEN concat('  ', {_NL}, {_OBJECT}, {_NL}, ' ') "
    f"WHEN 8 THEN {_only('[null]')} "
    f"WHEN 9 THEN {_only('null')} "
    f"WHEN 10 THEN concat({_FENCE}, {_NL}, 'not json', {_NL}, {_FENCE}, ' but ', {_OBJECT}) "
    f"ELSE concat('{{', {_Q}, 'other', {_Q}, ': ', {_CLASSES}, '}}') END"
)
DIRECTION_SQL = (
    "CASE doc_id % 5 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' "
    "WHEN 3 THEN 'uncertain' ELSE 'mixed' END"
)


def _field(name: str, value: str) -> str:
    return f"{_Q}, '{name}', {_Q}, ': ', {value}"


def _quoted(value: str) -> str:
    return f"{_Q}, {value}, {_Q}"


IMPACT_SQL = (
    "concat('{', "
    + ", ', ', ".join(
        [
            _field("label", _quoted("source")),
            _field("impact_direction", _quoted(DIRECTION_SQL)),
            _field("confidence", _quoted("CASE doc_id % 7 WHEN 0 THEN 'sure' WHEN 1 THEN 'low' ELSE 'high' END")),
            _field("reasoning", "CASE WHEN doc_id % 11 = 0 THEN '3' ELSE concat(" + _quoted("lang") + ") END"),
            _field("direct_effects", f"'[', {_quoted('lang')}, ', ', {_quoted('source')}, ']'"),
            _field("second_order_effects", "'[]'"),
            _field("key_uncertainties", f"CASE WHEN doc_id % 13 = 0 THEN '[null]' ELSE concat('[', {_quoted('lang')}, ']') END"),
            _field("summary", _quoted("concat('doc ', doc_id)")),
        ]
    )
    + ", '}')"
)


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def chat_factory() -> Callable[[str, str], str]:
    """Answers with labels picked by a hash of the prompt, in varying dress."""

    def answer(system: str, user: str) -> str:
        number = _number(user)
        label = LABELS[number // 6 % len(LABELS)]
        reply = json.dumps({"designated_classes": [label]})
        shape = number % 6
        if shape == 1:
            return f"Here:\n```json\n{reply}\n```"
        if shape == 2:
            return f"I pick {reply}, as asked."
        if shape == 3:
            return json.dumps({"designated_classes": []})
        if shape == 4:
            return json.dumps({"designated_classes": [label, "toxic"]})
        if shape == 5:
            return "cannot say"
        return reply

    return answer


def broken_factory() -> Callable[[str, str], str]:
    """Fails on some prompts and answers the others as ``chat_factory`` does."""
    chat = chat_factory()

    def answer(system: str, user: str) -> str:
        if _number(user) % 6 in (0, 1, 2):
            raise TimeoutError("late")
        return chat(system, user)

    return answer


def patient_factory() -> Callable[[str, str], str]:
    """Answers every prompt with one label picked by its hash."""
    return lambda system, user: json.dumps({"designated_classes": [LABELS[_number(user) // 6 % len(LABELS)]]})


def impact_factory() -> Callable[[str, str], str]:
    """Answers with a direction picked by a hash of the prompt."""

    def answer(system: str, user: str) -> str:
        direction = ["positive", "negative", "neutral", "uncertain", "mixed"][_number(user) % 5]
        return json.dumps(
            {
                "label": "x", "impact_direction": direction, "confidence": "low", "reasoning": "r",
                "direct_effects": [], "second_order_effects": ["e"], "key_uncertainties": [], "summary": "s",
            }
        )

    return answer


def scorer_factory() -> Callable[[pd.Series], list[list[float]]]:
    """Four logits per text from the digits of its hash; refuses some texts."""

    def score(texts: pd.Series) -> list[list[float]]:
        rows = []
        for text in texts:
            digest = hashlib.md5(text.encode()).hexdigest()
            if digest[31] == "0":
                raise ValueError("cannot score")
            rows.append([int(digest[i], 16) / 2.0 - 4.0 for i in range(4)])
        return rows

    return score


# The stand-ins travel to Python workers with the code that calls them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
