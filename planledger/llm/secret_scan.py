"""Secret scans: all rules in one pass of one automaton over the bytes of every text.

``scan_secrets`` adds the spans found; ``redact_secrets`` writes a placeholder
over them. The rules' patterns are compiled together (see ``automaton``). A match
is a maximal matched stretch; where it begins is found by the same rule's pattern,
searched forwards from the last place that no match crosses. Spans are in code points, end exclusive,
leftmost and without overlap within a kind; a match whose secret part is shorter
than the rule's ``least`` is dropped after it has been passed over.

Null and empty texts have no spans. Any other column stays as it is, also one
that has a name of the operator's own: such a column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from planledger.llm.automaton import Automaton, compile_rules
from planledger.llm.textbytes import text_blocks


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``least`` characters.

    ``scan``: what the automaton looks for instead, where the pattern itself would
    match nearly everywhere. Its matches must be those that are long enough.
    """

    kind: str
    pattern: str
    group: int
    least: int
    fold: bool = False
    scan: str | None = None


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The three base kinds, then well-known key formats that the automaton takes along for free.
RULES = (
    Rule("assign", _ASSIGN, 2, 12, fold=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16, scan=r"[0-9a-f]{16,}"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
)
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@lru_cache(maxsize=4)
def _compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, tuple[re.Pattern, ...]]:
    machine = compile_rules([(rule.scan or rule.pattern, rule.fold) for rule in rules])
    whole = tuple(re.compile(r.pattern.encode(), re.IGNORECASE * r.fold) for r in rules)
    return machine, whole


def _start(data: bytes, whole: re.Pattern, low: int, matched: int, end: int) -> re.Match | None:
    """The leftmost start at or behind ``low`` from which the rule matches up to ``end``."""
    return next((m for m in whole.finditer(data, low, end) if m.end() == end and m.start() < matched), None)


def find_secrets(texts: pa.Array, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[str, int, int]]]:
    """The spans of each text: by start, then by the rules' order."""
    machine, whole = _compiled(rules)
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(texts))]
    for first, end, buf, offsets in text_blocks(texts, 1 << 21):
        # A line feed behind each text resets the automaton.
        spread = np.arange(len(offsets))
        padded = np.full(len(buf) + len(offsets) - 1, 0x0A, np.uint8)
        padded[np.arange(len(buf)) + np.repeat(spread[:-1], np.diff(offsets))] = buf
        begins = offsets + spread
        data = None
        for order, (rule, pattern, (on, off)) in enumerate(zip(rules, whole, machine.match_ends(padded), strict=True)):
            # Matches don't overlap: each begins behind the one before, which tells most short ones.
            before = np.append(0, off[:-1])
            long = off - before >= rule.least
            for a, b, passed in zip(on[long].tolist(), off[long].tolist(), before[long].tolist(), strict=True):
                data = data if data is not None else padded.tobytes()
                row = int(np.searchsorted(begins, a, "right")) - 1
                # Back to the last byte that resets the automaton: no match crosses it.
                low = _reset_before(machine, padded, a, max(passed, int(begins[row])))
                m = _start(data, pattern, low, a + 1, b)
                if m is None:
                    raise AssertionError(f"the automaton and the pattern of {rule.kind} differ")
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    out[first + row].append((order, m.start() - int(begins[row]), b - int(begins[row])))
        for row in range(end - first):
            if found := out[first + row]:
                raw = buf[offsets[row] : offsets[row + 1]]
                points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
                found.sort(key=lambda x: (x[1], x[0]))
                out[first + row] = [(rules[o].kind, int(points[a]), int(points[b])) for o, a, b in found]
    return out


def _reset_before(machine: Automaton, buf: np.ndarray, at: int, floor: int) -> int:
    """The place behind the last byte before ``at`` that resets the automaton, ``floor`` at least."""
    width = 256
    while True:
        low = max(floor, at - width)
        hits = np.flatnonzero(machine.resets[buf[low:at]])
        if len(hits) or low == floor:
            return low + int(hits[-1]) + 1 if len(hits) else floor
        width *= 4


def scan_secrets(
    docs: DataFrame, text: str = "text", spans: str = "spans", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Add ``spans``, an array of (kind, start, end), to every row."""
    own = docs.drop(spans)
    # One string column goes through Python beside what stays; a narrow map, no shuffle.
    schema = own.select("*", F.expr(f"cast(null as {SPANS})").alias(spans)).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in row] for row in find_secrets(batch.column(at), rules)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, spans])

    return own.mapInArrow(scan, schema)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Write ``mark`` over every span in ``text``; overlapping spans share one mark.
    Other columns stay, and so does a null or clean text."""
    found = "__spans"
    own = scan_secrets(docs, text, found)
    # Left to right: the text so far, and where the last span ended.
    folded = F.expr(f"""aggregate({found},
        named_struct('done', cast('' as string), 'at', cast(0 as bigint)),
        (a, s) -> named_struct(
            'done', case when s.start >= a.at
                then concat(a.done, substring({text}, cast(a.at + 1 as int), cast(s.start - a.at as int)), '{mark}')
                else a.done end,
            'at', greatest(a.at, s.end)),
        a -> concat(a.done, substring({text}, cast(a.at + 1 as int))))""")
    clean = F.when(F.size(found) > 0, folded).otherwise(F.col(text))
    return own.withColumn(text, clean).drop(found)
