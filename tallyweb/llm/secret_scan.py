"""Secret scans over a trigram inverted index.

Each rule is a regex. From its parse tree a Boolean query over trigrams is derived that
every match satisfies (texts and trigrams with A-Z lowered). The texts of a shard, about a
megabyte, are indexed by the trigrams that some rule asks for; a rule's postings are
intersected and united, and only the candidates are scanned with the regex. A rule without
mandatory trigrams scans every text.

Base kinds: assign, access, hex (see RULES); further kinds add spans and never replace
these. Matches of a kind are leftmost and don't overlap; one that is too short is dropped
after it has been matched. Spans are in code points, end exclusive.

No shuffle: one pass, memory bounded by a shard of text. Defined cases: a null or empty
text has no spans; repeated rows are scanned one by one; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import steps


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of the group
    flags: int = re.ASCII


#: The base kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
#: Further kinds: widely documented token formats.
MORE = (
    Rule("private", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

#: A query: None (always true), a trigram, or ("and" | "or", frozenset of queries).
Query = None | str | tuple
_MOST_STRINGS, _MOST_CLASS = 64, 10


def _and(*parts: Query) -> Query:
    own = frozenset(p for p in parts if p is not None)
    return None if not own else next(iter(own)) if len(own) == 1 else ("and", own)


def _or(*parts: Query) -> Query:
    own = frozenset(parts)
    return None if None in own else next(iter(own)) if len(own) == 1 else ("or", own)


def _strings_query(strings: set[str]) -> Query:
    """One of these strings occurs."""
    return _or(*(_and(*(s[i : i + 3] for i in range(len(s) - 2))) for s in strings)) if strings else None


def _analyse(tree: list) -> tuple[set[str] | None, Query]:
    """(all strings that the tree can match, lowered, if they are few; a query that every match satisfies)."""
    exact: set[str] | None = {""}
    run: set[str] = {""}
    found: Query = None

    def flush() -> None:
        nonlocal run, found, exact
        found, run, exact = _and(found, _strings_query(run)), {""}, None

    for op, arg in tree:
        some: set[str] | None = None
        query: Query = None
        ends = False
        if op is sre.LITERAL:
            some = {chr(arg).lower() if arg < 128 else chr(arg)}
        elif op is sre.IN:
            chars: set[str] | None = set()
            for kind, value in arg:
                if kind is sre.LITERAL:
                    chars.add(chr(value).lower() if value < 128 else chr(value))
                elif kind is sre.RANGE and value[1] - value[0] < _MOST_CLASS:
                    chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    chars = None
                    break
            some = chars if chars and len(chars) <= _MOST_CLASS else None
        elif op is sre.SUBPATTERN:
            some, query = _analyse(arg[3])
        elif op is sre.BRANCH:
            each = [_analyse(b) for b in arg[1]]
            some = set().union(*(e for e, _ in each)) if all(e is not None for e, _ in each) else None
            query = _or(*(_and(q, _strings_query(e)) if e is not None else q for e, q in each))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, body = arg
            inner, q = _analyse(body)
            if least == 0:
                some = inner | {""} if most == 1 and inner is not None else None
            else:
                query, ends = q, most > 1 or least > 1
                some = inner
                if inner is not None and 1 < least <= 4 and len(inner) ** least <= _MOST_STRINGS:
                    some = {"".join(p) for p in product(inner, repeat=least)}
                    ends = most > least
        elif op is sre.AT:
            continue
        found = _and(found, query)
        if some is not None and len(run) * len(some) <= _MOST_STRINGS:
            run = {a + b for a in run for b in some}
            if ends:
                flush()
        else:
            flush()
            if some is not None and len(some) <= _MOST_STRINGS:
                run = some
                if ends:
                    flush()
    if exact is not None and len(run) <= _MOST_STRINGS:
        return run, found
    return None, _and(found, _strings_query(run))


def trigram_query(rule: Rule) -> Query:
    """A query over lowered ASCII trigrams that every text with a match satisfies; None if there is none."""
    exact, query = _analyse(list(sre_parse.parse(rule.pattern, rule.flags)))
    return _and(query, _strings_query(exact)) if exact is not None else query


def _trigrams(query: Query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1]))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Scanner:
    """Rules with their queries, and the table that maps a trigram to its postings list."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(_long_runs(r), r.flags), trigram_query(r)) for r in rules]
        wanted = sorted({t for _, _, q in self.rules for t in _trigrams(q) if t.isascii()})
        self.slot = {t: k + 1 for k, t in enumerate(wanted)}
        self.table = np.zeros(1 << 24, dtype=np.uint16)
        for t, k in self.slot.items():
            a, b, c = t.encode()
            self.table[a << 16 | b << 8 | c] = k

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The inverted index of a shard: postings[slot, text]."""
        out = np.zeros((len(self.slot) + 1, len(offsets) - 1), dtype=bool)
        if len(data) >= 3:
            low = _LOWER[data].astype(np.uint32)
            slots = self.table[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
            at = np.flatnonzero(slots)
            text = np.searchsorted(offsets, at, side="right") - 1
            whole = at + 3 <= offsets[text + 1]
            out[slots[at[whole]], text[whole]] = True
        return out

    def _candidates(self, query: Query, postings: np.ndarray) -> np.ndarray:
        if query is None or (isinstance(query, str) and query not in self.slot):
            return np.ones(postings.shape[1], dtype=bool)
        if isinstance(query, str):
            return postings[self.slot[query]]
        each = [self._candidates(q, postings) for q in query[1]]
        return np.logical_and.reduce(each) if query[0] == "and" else np.logical_or.reduce(each)

    def scan(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, rule, end) of every text, by start, then rule."""
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        begin = (offsets - offsets[0]).tolist()
        postings = self.postings(data, offsets - offsets[0])
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        held: dict[int, str] = {}
        for k, (rule, regex, query) in enumerate(self.rules):
            for i in np.flatnonzero(self._candidates(query, postings)).tolist():
                if (text := held.get(i)) is None:
                    text = held[i] = data[begin[i] : begin[i + 1]].tobytes().decode("utf-8", "replace")
                for m in regex.finditer(text):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), k, m.end()))
        for spans in out:
            spans.sort()
        return out


def _long_runs(rule: Rule) -> str:
    """A bare class+ with a least length matches the same runs as class{least,}, without the many that would be dropped."""
    bare = re.fullmatch(r"(\[[^\]]*\])\+", rule.pattern)
    return f"{bare[1]}{{{rule.least},}}" if bare and rule.group == 0 and rule.least else rule.pattern


@lru_cache(maxsize=4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every document, by start, then in the rules' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _scanner(rules)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for part, texts in steps(batch, "_text"):
                spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in x] for x in own.scan(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, type=pa.list_(kind))], names=["doc_id", "spans"])

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int>>"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """doc_id, number of spans of each base kind, SHA-256 of the base spans, and all spans as kind:start:end."""
    kinds = [r.kind for r in base]
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    own = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(written(own), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """The text with its spans replaced (overlapping ones together)."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
