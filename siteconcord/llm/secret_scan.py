"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams follows: what any match must contain. Every slice of
about `SEGMENT_BYTES` of documents in a task is a segment with an inverted index of its own: postings from each trigram some query names to the
documents that hold it, case folded. The query's postings are united and intersected, and the rule's expression runs over the
candidates only. Rules without a mandatory trigram (runs of hexadecimal digits) scan every document. Segments are
independent, so a lost executor costs its own segments only, and memory is bounded by the bytes of one.

Defined cases: null text is empty and has no spans; one row out for each row in, equal rows alike; empty tables give an empty
result; offsets are code points, ends exclusive; other columns are ignored by `secret_spans` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from re import _parser  # the standard library's own parse of an expression

from siteconcord.llm.batches import as_bytes, chunks


@dataclass(frozen=True)
class Rule:
    """A match counts if `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# Fixed values of the query contract, in its order.
BASE_RULES: tuple[Rule, ...] = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Published formats of keys. One that opens with an unbounded run starts where that run does: a long run is read once, not from each of its places.
MORE_RULES: tuple[Rule, ...] = (
    Rule("pem", r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
# Bytes of text in a segment: while it is indexed a worker holds some twenty bytes for each of them.
SEGMENT_BYTES = 1 << 20


# --- trigram queries --------------------------------------------------------------------------------------------------
#
# A query is None (anything may match), a trigram, or ("and" | "or", queries).


def _and(parts: list) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _or(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return None if None in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _grams(text: str) -> object:
    """All trigrams of a literal, in lower case; letters outside ASCII are left to the verification."""
    folded = text.lower()
    cut = [folded[i : i + 3] for i in range(len(folded) - 2)]
    return _and([g for g in cut if g.isascii()])


# More spellings than this of one stretch are not listed; the query is then looser, never wrong.
_SPELLINGS = 64


def _walk(items) -> tuple[list[str] | None, object]:
    """(all spellings of the expression or None if there are too many, query that any match satisfies)."""
    open_runs: list[str] | None = [""]  # spellings of the stretch that ends here
    queries: list = []

    def close() -> None:
        nonlocal open_runs
        if open_runs:
            queries.append(_or([_grams(r) for r in open_runs]))
        open_runs = [""]

    whole = True
    for op, argument in items:
        name = str(op)
        spellings, query = None, None
        if name == "LITERAL":
            spellings = [chr(argument)]
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in argument) and len(argument) <= 8:
            spellings = [chr(a) for _, a in argument]
        elif name == "SUBPATTERN":
            spellings, query = _walk(argument[-1])
        elif name == "BRANCH":
            branches = [_walk(b) for b in argument[1]]
            lists = [s for s, _ in branches]
            spellings = None if None in lists else [s for part in lists for s in part]
            query = _or([q for _, q in branches])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = argument
            inner, inner_query = _walk(body)
            if inner is not None and int(high) == 1:
                spellings = inner if low == 1 else ["", *inner]
            elif inner is not None and low == high and len(inner) == 1 and low <= 64:
                spellings = [inner[0] * int(low)]
            elif low >= 1:
                query = inner_query
        if spellings is not None and len(spellings) * len(open_runs) <= _SPELLINGS:
            open_runs = list(dict.fromkeys(a + b for a in open_runs for b in spellings))
        else:
            whole = False
            close()
            queries.append(query if spellings is None else _or([_grams(s) for s in spellings]))
    if whole:
        return open_runs, _or([_grams(r) for r in open_runs])
    close()
    return None, _and(queries)


def trigram_query(pattern: str) -> object:
    return _walk(_parser.parse(pattern))[1]


def named(query: object) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*[named(q) for q in query[1]])


def answer(query: object, postings: dict[str, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """Ascending numbers of the documents that satisfy the query."""
    if query is None:
        return everything
    if isinstance(query, str):
        return postings[query]
    found = [answer(q, postings, everything) for q in query[1]]
    out = found[0]
    for more in found[1:]:
        out = np.intersect1d(out, more, assume_unique=True) if query[0] == "and" else np.union1d(out, more)
    return out


_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[ord("A") : ord("Z") + 1] += 32


def segment_postings(texts: list[bytes], grams: Sequence[str]) -> dict[str, np.ndarray]:
    """The inverted index of a segment, for the given trigrams."""
    # A zero byte after each text keeps trigrams from reaching into the next.
    joined = np.frombuffer(b"\0".join(texts) + b"\0\0\0", np.uint8)
    folded = _FOLD[joined]
    codes = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]
    # A table of first two bytes leaves few places to compare in full.
    lookup = np.zeros(1 << 16, bool)
    wanted = {int.from_bytes(g.encode("ascii"), "big"): g for g in grams}
    lookup[[code >> 8 for code in wanted]] = True
    places = np.flatnonzero(lookup[codes >> 8])
    codes = codes[places]
    starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    postings = {}
    for code, gram in wanted.items():
        postings[gram] = np.unique(np.searchsorted(starts, places[codes == code], "right") - 1)
    return postings


# --- the scan ---------------------------------------------------------------------------------------------------------


def rule_spans(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap, without those that are too short."""
    return [m.span() for m in compiled.finditer(text) if len(m[rule.group]) >= rule.least]


def _found(batch: pa.RecordBatch, rules: Sequence[Rule], compiled: list[re.Pattern], queries: list, grams: list[str]) -> Iterator[tuple[pa.RecordBatch, list[list]]]:
    """Per slice of the batch, each document's spans (start, rule number, end) in order."""
    for part in chunks(batch, "text", SEGMENT_BYTES):
        raw = as_bytes(part.column("text"))
        postings = segment_postings(raw, grams)
        everything = np.arange(len(raw))
        spans: list[list] = [[] for _ in raw]
        for number, rule in enumerate(rules):
            for at in answer(queries[number], postings, everything).tolist():
                text = raw[at].decode("utf-8")
                spans[at] += [(start, number, end) for start, end in rule_spans(rule, compiled[number], text)]
        yield part, [sorted(s) for s in spans]


def _prepared(rules: Sequence[Rule]) -> tuple[list[re.Pattern], list, list[str]]:
    queries = [trigram_query(r.pattern) for r in rules]
    return [r.compiled() for r in rules], queries, sorted(set().union(*[named(q) for q in queries]))


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, spans): one row per row of `docs` (doc_id, text); spans is an array of kind, start, end, by start."""
    rules = list(rules)
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = _prepared(rules)
        for batch in batches:
            for part, spans in _found(batch, rules, *prepared):
                rows = [[{"kind": rules[n].kind, "start": s, "end": e} for s, n, e in found] for found in spans]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    schema = f"doc_id {doc_id}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def span_text(spans: Sequence[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with each secret replaced by `mark` (overlapping spans by one); n_chars, if there, follows."""
    rules = list(rules)
    names = docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = _prepared(rules)
        for batch in batches:
            for part, spans in _found(batch, rules, *prepared):
                if not any(spans):
                    yield part
                    continue
                texts = part.column("text").to_pylist()
                for at, found in enumerate(spans):
                    if found:
                        texts[at] = without(texts[at], found, mark)
                columns = {n: part.column(n) for n in names} | {"text": pa.array(texts, part.schema.field("text").type)}
                if "n_chars" in columns:
                    counts = [None if t is None else len(t) for t in texts]
                    kept = part.column("n_chars").to_pylist()
                    counts = [c if s else k for c, k, s in zip(counts, kept, spans)]
                    columns["n_chars"] = pa.array(counts, part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return docs.mapInArrow(scan, docs.schema)


def without(text: str, found: Sequence[tuple[int, int, int]], mark: str) -> str:
    out, last = [], 0
    for start, _, end in found:
        if start >= last:
            out += [text[last:start], mark]
        last = max(last, end)
    return "".join([*out, text[last:]])
