"""Secret scans by a trigram inverted index.

Each rule's regex gives a Boolean query over trigrams that any match must hold. Texts are indexed block by
block, a block being part of an Arrow batch: the index has, per trigram that some rule asks for, the sorted
list of texts that hold it. A rule's query intersects and unites these lists, and its regex runs over the
remaining texts only. Rules without mandatory trigrams scan every text. Blocks keep an index next to its
texts, so that nothing is shuffled and memory is bounded by a block.

Trigrams are taken with A-Z in lower case, so that one index serves rules of either case. All rules are ASCII,
so regexes run over UTF-8 bytes, and spans are turned into code points afterwards.

Defined cases: missing or empty texts have no spans; repeated rows are scanned each; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagtable.llm.store import map_batches
from tagtable.llm.words import Texts, chunks


@dataclass(frozen=True)
class Rule:
    """A kind of secret: spans of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False


# The kinds of the task's contract, in its order.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Public formats of other secrets.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

# A query is True (no condition), a trigram, or ("and" | "or", queries).
Query = bool | bytes | tuple


def trigram_query(pattern: str) -> Query:
    """A condition on the lower-cased trigrams of a text that every match of ``pattern`` fulfils."""
    strings = _strings(list(parser.parse(pattern)))
    if strings is None or not strings or any(len(s) < 3 for s in strings):
        return True
    return _any([_all([s[i : i + 3].lower().encode() for i in range(len(s) - 2)]) for s in strings])


def _strings(items: list) -> list[str] | None:
    """Literal strings of which every match holds one, the best run of the sequence; None if there is none."""
    best: list[str] | None = None
    run: list[str] = [""]
    for code, value in [*items, (None, None)]:
        choices = _choices(code, value)
        if choices is not None and len(run) * len(choices) <= 64:
            run = [a + b for a in run for b in choices]
            continue
        best = _better(best, run)
        run = choices if choices is not None else [""]
        if choices is None and code is op.SUBPATTERN:
            best = _better(best, _strings(list(value[3])))
    return best


def _better(a: list[str] | None, b: list[str] | None) -> list[str] | None:
    score = lambda x: min(map(len, x)) if x else 0
    return b if score(b) > score(a) else a


def _choices(code, value) -> list[str] | None:
    """All strings that a part of a regex can match, if they are few."""
    if code is op.LITERAL:
        return [chr(value)]
    if code is op.SUBPATTERN:
        return _sequence(list(value[3]))
    if code is op.BRANCH:
        parts = [_sequence(list(branch)) for branch in value[1]]
        return None if any(p is None for p in parts) else [s for p in parts for s in p]
    if code is op.MAX_REPEAT and value[1] is not op.MAXREPEAT and value[1] <= 3:
        one = _sequence(list(value[2]))
        if one is None:
            return None
        out = []
        for n in range(value[0], value[1] + 1):
            out += reduce(lambda left, _: [a + b for a in left for b in one], range(n), [""])
        return out
    if code is op.IN and all(c is op.LITERAL for c, _ in value) and len(value) <= 5:
        return [chr(v) for _, v in value]
    return None


def _sequence(items: list) -> list[str] | None:
    out = [""]
    for code, value in items:
        choices = _choices(code, value)
        if choices is None or len(out) * len(choices) > 64:
            return None
        out = [a + b for a in out for b in choices]
    return out


def _all(parts: list) -> Query:
    return parts[0] if len(parts) == 1 else ("and", tuple(dict.fromkeys(parts)))


def _any(parts: list) -> Query:
    return parts[0] if len(parts) == 1 else ("or", tuple(dict.fromkeys(parts)))


def trigrams_of(query: Query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


class BlockIndex:
    """For each wanted trigram, the sorted numbers of the texts of a block that hold it."""

    def __init__(self, texts: Texts, wanted: Sequence[bytes], table: np.ndarray):
        data = texts.lower().data.astype(np.uint32)
        self.size = len(texts)
        self.postings: dict[bytes, np.ndarray] = {}
        none = np.zeros(0, dtype=np.int64)
        if len(data) < 3 or not wanted:
            self.postings = dict.fromkeys(wanted, none)
            return
        number = table[data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)]
        at = np.flatnonzero(number)
        row = np.searchsorted(texts.offsets, at, side="right") - 1
        inside = at + 3 <= texts.offsets[row + 1]
        pairs = np.unique(number[at[inside]].astype(np.int64) * self.size + row[inside])
        for i, trigram in enumerate(wanted, 1):
            lo, hi = np.searchsorted(pairs, [i * self.size, (i + 1) * self.size])
            self.postings[trigram] = pairs[lo:hi] - i * self.size

    def find(self, query: Query) -> np.ndarray:
        """The numbers of the texts that fulfil a query."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings[query]
        lists = sorted((self.find(part) for part in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists)


@lru_cache(maxsize=8)
def _prepared(rules: tuple[Rule, ...]) -> tuple:
    queries = tuple(trigram_query(rule.pattern) for rule in rules)
    wanted = tuple(sorted(set().union(*map(trigrams_of, queries))))
    table = np.zeros(1 << 24, dtype=np.uint8 if len(wanted) < 256 else np.uint16)
    for i, t in enumerate(wanted, 1):
        table[t[0] | t[1] << 8 | t[2] << 16] = i
    regexes = tuple(re.compile(rule.pattern.encode(), re.IGNORECASE if rule.any_case else 0) for rule in rules)
    return queries, wanted, table, regexes


def spans_of_block(texts: Texts, rules: tuple[Rule, ...]) -> dict[int, list[tuple[int, int, int]]]:
    """Per text with secrets its ``(start, rule, end)`` in code points, sorted by start, then rule."""
    queries, wanted, table, regexes = _prepared(rules)
    index = BlockIndex(texts, wanted, table)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for number, (rule, query, regex) in enumerate(zip(rules, queries, regexes, strict=True)):
        for i in index.find(query).tolist():
            data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
            for match in regex.finditer(data.tobytes()):
                start, end = match.span(rule.group)
                if end - start >= rule.least:
                    found.setdefault(i, []).append((match.start(), number, match.end()))
    for i, spans in found.items():
        data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
        points = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        found[i] = sorted((int(points[a]), rule, int(points[b])) for a, rule, b in spans)
    return found


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *MORE), text: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``kind, start, end`` (code points, end exclusive), of each row."""
    fixed = tuple(rules)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                found = spans_of_block(texts, fixed)
                rows = [
                    [{"kind": fixed[rule].kind, "start": a, "end": b} for a, rule, b in found.get(i, ())]
                    for i in range(len(texts))
                ]
                arrays = [batch.column(0)[first:end], pa.array(rows, pa.list_(span))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", text), scan, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def digest(spans: Sequence[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
