"""Documents read and marked by hand: 1 for a list, a table or junk, 0 for running prose.

They are whole texts as they come in test tables, none written for the purpose, in three parts of equal make-up: base
(which always joins the training, with weak labels), calibration and test.
"""

import json
from functools import cache
from pathlib import Path


@cache
def marked(part: str) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """(texts, marks) of a part."""
    with open(Path(__file__).with_suffix(".jsonl"), encoding="utf-8") as lines:
        rows = [r for r in map(json.loads, lines) if r["part"] == part]
    return tuple(r["text"] for r in rows), tuple(r["junk"] for r in rows)
