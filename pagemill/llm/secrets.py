"""Secret scans through trigram postings.

Each rule's regular expression is parsed into a Boolean query over trigrams that every match must
contain. Documents are indexed in segments, as they are read: a segment is a bounded block of rows,
its inverted index maps each trigram of the rules' vocabulary to the rows that hold it. A rule's
query intersects and unites postings, and only the rows left are verified with the expression itself.
Rules without a mandatory trigram scan every row. Nothing is shuffled, and memory is bounded by a block.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, flat_bytes, row_blocks, utf8

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # older Pythons
    import sre_constants as sre
    import sre_parse

#: Alternatives that are followed at once before a piece of an expression counts as "anything".
MOST_STRINGS, MOST_IN_CLASS = 64, 4
BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``group`` is measured against ``least`` characters after a match; shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: Fixed patterns: the three base kinds, and further ones that the method adds.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

Query = frozenset  # of frozensets of trigrams: any of them, all its members; empty: no mandatory trigram


def trigram_query(pattern: str) -> Query:
    """The mandatory trigrams of an expression in lower case, as a union of intersections.

    An empty query means that some match needs no trigram: the rule must scan fully.
    """

    def simplest(sets) -> Query:
        sets = set(sets)
        return frozenset() if frozenset() in sets else frozenset(s for s in sets if not any(o < s for o in sets))

    def both(a: Query, b: Query) -> Query:
        if not a or not b or len(a) * len(b) > MOST_STRINGS:
            return min((x for x in (a, b) if x), key=len, default=frozenset())
        return simplest(x | y for x, y in product(a, b))

    def of_strings(strings: set[str]) -> Query:
        return simplest(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)

    def walk(nodes) -> tuple[set[str] | None, Query]:
        """(all strings it can match, if few; else its query)."""
        run, query, exact = {""}, frozenset(), True
        for op, arg in nodes:
            strings, inner = one(op, arg)
            if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
                run = {a + b for a, b in product(run, strings)}
                continue
            exact = False
            query = both(query, of_strings(run))
            if strings is not None:
                run = strings
            else:
                query, run = both(query, inner), {""}
        return (run, frozenset()) if exact else (None, both(query, of_strings(run)))

    def one(op, arg) -> tuple[set[str] | None, Query]:
        if op is sre.LITERAL:
            return {chr(arg).lower()}, frozenset()
        if op is sre.IN and all(k is sre.LITERAL for k, _ in arg) and len(chars := {chr(v).lower() for _, v in arg}) <= MOST_IN_CLASS:
            return chars, frozenset()
        if op is sre.SUBPATTERN:
            return walk(arg[-1])
        if op is sre.BRANCH:
            parts = [walk(x) for x in arg[1]]
            if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MOST_STRINGS:
                return set().union(*(s for s, _ in parts)), frozenset()
            each = [q if s is None else of_strings(s) for s, q in parts]
            return None, simplest(x for q in each for x in q) if all(each) else frozenset()
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            strings, inner = walk(body)
            if (low, high) == (0, 1) and strings is not None:
                return strings | {""}, frozenset()
            if low == high == 1:
                return strings, inner
            return None, (of_strings(strings) if strings is not None else inner) if low else frozenset()
        return ({""} if op is sre.AT else None), frozenset()

    strings, query = walk(sre_parse.parse(pattern))
    return of_strings(strings) if strings is not None else query


class Segment:
    """The inverted index of one block of rows, over a fixed vocabulary of trigrams."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, slots: np.ndarray, words: list[str]):
        self.rows = len(offsets) - 1
        self.postings: dict[str, np.ndarray] = {w: np.zeros(0, np.int64) for w in words}
        if len(flat) < 3 or not words:
            return
        low = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint32)
        slot = slots[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(slot)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(slot[at[inside]].astype(np.int64) * self.rows + row[inside])
        for k, w in enumerate(words, 1):
            lo, hi = np.searchsorted(pairs, (k * self.rows, (k + 1) * self.rows))
            self.postings[w] = pairs[lo:hi] - k * self.rows

    def candidates(self, query: Query) -> np.ndarray:
        if not query:
            return np.arange(self.rows)
        found = np.zeros(self.rows, bool)
        for needed in query:
            rows = None
            for w in sorted(needed, key=lambda w: len(self.postings[w])):
                rows = self.postings[w] if rows is None else np.intersect1d(rows, self.postings[w], assume_unique=True)
                if not len(rows):
                    break
            found[rows] = True
        return np.flatnonzero(found)


class Scanner:
    """Rules with their queries and vocabulary, ready for blocks of rows."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern.encode()), trigram_query(r.pattern)) for r in rules]
        self.words = sorted({w for *_, q in self.rules for s in q for w in s if w.isascii()})
        self.slots = np.zeros(1 << 24, np.uint16)
        for k, w in enumerate(self.words, 1):
            a, b, c = w.encode()
            self.slots[a << 16 | b << 8 | c] = k

    def block(self, flat: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each row its spans (start, rule number, end) in code points, sorted."""
        index = Segment(flat, offsets, self.slots, self.words)
        texts, out = {}, [[] for _ in range(index.rows)]
        for k, (rule, regex, query) in enumerate(self.rules):
            for row in index.candidates(query):
                text = texts.get(row)
                if text is None:
                    text = texts[row] = flat[offsets[row] : offsets[row + 1]].tobytes()
                for m in regex.finditer(text):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[row].append((m.start(), k, m.end()))
        for row, spans in enumerate(out):
            if spans:
                spans.sort()
                text = texts[row]
                if not text.isascii():
                    point = {x: len(text[:x].decode("utf-8", "replace")) for s in spans for x in (s[0], s[2])}
                    out[row] = [(point[a], k, point[b]) for a, k, b in spans]
        return out


_scanners: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules)
    return _scanners[rules]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows (id, spans) for every row of ``docs``; spans: array of (kind, start, end, base).

    Spans are leftmost and non-overlapping within a kind, in code points, end exclusive, by start and
    then in the order of the rules. Null and empty texts have none; repeated rows and null ids are kept
    row by row; other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    kinds = [(r.kind, r.base) for r in rules]

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = flat_bytes(batch.column(1))
        s, found = scanner(rules), []
        for a, b in row_blocks(offsets, BLOCK_BYTES):
            found += s.block(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        spans = [[{"kind": kinds[k][0], "start": x, "end": y, "base": kinds[k][1]} for x, k, y in row] for row in found]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["id", "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = arrow_map(docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")), scan, f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    return out.withColumnRenamed("id", id_col)


def joined_spans(spans: Column | str) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.format_string("%s:%d:%d", s["kind"], s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found span of ``text_col`` replaced by ``mask``; overlapping spans merge.

    All rows and columns stay; a text without spans, a null among them, is returned unchanged.
    """
    names = docs.columns
    at = names.index(text_col)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = flat_bytes(batch.column(at).fill_null("").cast(pa.binary()))
        s, new, texts = scanner(rules), {}, batch.column(at)
        for a, b in row_blocks(offsets, BLOCK_BYTES):
            for i, spans in enumerate(s.block(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), a):
                if spans:
                    text, done, parts = texts[i].as_py(), 0, []
                    for x, _, y in spans:
                        if x >= done:
                            parts += [text[done:x], mask]
                        done = max(done, y)
                    new[i] = "".join([*parts, text[done:]])
        if new:
            values = texts.to_pylist()
            for i, t in new.items():
                values[i] = t
            batch = batch.set_column(at, batch.schema.field(at), pa.array(values, texts.type))
        return batch

    return arrow_map(docs, scan, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
