"""Secret scans by a trigram index: Boolean trigram queries from the rules, postings, verified candidates."""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as regex_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, map_slices, pick, row_slices

#: Kind, pattern, group whose length counts, least length.  The first three are the base rules.
RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
]
BASE = ("assign", "access", "hex")

#: A query is True (any text), ("tri", t), ("and", [...]) or ("or", [...]).
_MOST = 128


def _all(parts):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _any(parts):
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def _query_of(strings: set[str]):
    """What a text holding one of ``strings`` must hold."""
    return _any([_all([("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)]) if strings else True


def _walk(nodes):
    """(all strings the nodes can match or None, their trigram query), in lower case.

    Strings of neighbours are joined while they are few; where they end, the
    trigrams of what was joined so far become part of the query.
    """
    exact, run, parts = {""}, {""}, []
    for kind, arg in nodes:
        here, query = None, True
        if kind is op.LITERAL:
            here = {chr(arg).lower()}
        elif kind is op.IN and len(arg) <= 16 and all(k is op.LITERAL for k, _ in arg):
            here = {chr(c).lower() for _, c in arg}
        elif kind is op.SUBPATTERN:
            here, query = _walk(arg[3])
        elif kind is op.BRANCH:
            found = [_walk(x) for x in arg[1]]
            here = set().union(*[e for e, _ in found]) if all(e is not None for e, _ in found) else None
            query = _any([q if e is None else _query_of(e) for e, q in found])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, body = arg
            inner, need = _walk(body)
            if (low, high) == (0, 1) and inner is not None:
                here = inner | {""}
            elif low == high == 1:
                here, query = inner, need
            elif low >= 1:
                query = need if inner is None else _query_of(inner)
        elif kind is op.AT:
            here = {""}
        if here is not None and len(run) * len(here) <= _MOST:
            run = {a + b for a in run for b in here}
            exact = {a + b for a in exact for b in here} if exact is not None and len(exact) * len(here) <= _MOST else None
        else:
            parts += [_query_of(run), query if here is None else _query_of(here)]
            exact, run = None, {""}
    return exact, _all([*parts, _query_of(run)])


def trigram_query(pattern: str):
    """The Boolean trigram query of a regular expression; True if it has no mandatory trigram.

    Queries are over lower-cased text, so they serve rules of either case.
    """
    return _walk(regex_parser.parse(pattern, re.ASCII))[1]


def trigrams_in(query) -> set[str]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams_in, query[1]))


def postings(texts: list[str], wanted: set[str]) -> dict[str, np.ndarray]:
    """Inverted index of a block of texts over the wanted trigrams: trigram → ascending text numbers."""
    low = [t.lower() for t in texts]
    return {g: np.fromiter((i for i, t in enumerate(low) if g in t), dtype=np.int64) for g in sorted(wanted)}


def candidates(query, index: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Text numbers that satisfy ``query``: postings intersected for ``and``, united for ``or``."""
    if query is True:
        return np.arange(n)
    if query[0] == "tri":
        return index[query[1]]
    found = [candidates(q, index, n) for q in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(found))
    out = found[0]
    for x in sorted(found[1:], key=len):
        out = np.intersect1d(out, x, assume_unique=True)
    return out


def scan_block(texts: list[str], rules, compiled, queries, wanted) -> list[list[tuple[int, int, int]]]:
    """For each text its matches (start, rule number, end), sorted; offsets are code points."""
    index, out = postings(texts, wanted), [[] for _ in texts]
    for k, (_, _, group, least) in enumerate(rules):
        for i in candidates(queries[k], index, len(texts)).tolist():
            out[i] += [(m.start(), k, m.end()) for m in compiled[k].finditer(texts[i]) if m.end(group) - m.start(group) >= least]
    for spans in out:
        spans.sort()
    return out


def _block_scanner(rules):
    queries = [trigram_query(p) for _, p, _, _ in rules]
    wanted = set().union(*map(trigrams_in, queries))
    compiled = [re.compile(p, re.ASCII) for _, p, _, _ in rules]
    return lambda texts: scan_block(texts, rules, compiled, queries, wanted)


def find_secrets(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> for every row, sorted by start, then by rule order.

    Matches are leftmost and non-overlapping per kind; those whose counted
    group is too short are dropped afterwards.  A null or empty text has no
    spans; repeated rows are scanned each; null ids stay null.  The index is
    built per block of rows where they are read: no shuffle, nothing collected,
    and a lost task rebuilds only its own blocks.
    """
    kinds = [r[0] for r in rules]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])
    state = {}

    def run(b: pa.RecordBatch) -> dict:
        scan = state.get("scan") or state.setdefault("scan", _block_scanner(rules))
        found = scan([t or "" for t in b.column(1).to_pylist()])
        return {"doc_id": b.column(0), "spans": [[{"kind": kinds[k], "start": s, "end": e} for s, k, e in x] for x in found]}

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return map_slices(rows, run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>", arrow)


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and all spans as ``kind:start:end`` joined by commas."""
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.array_join(F.transform(F.filter("spans", lambda x: x["kind"].isin(*BASE)), line), ",")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("spans", line), ",").alias("spans"))


def mask_secrets(docs: DataFrame, rules=RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` and ``n_chars`` counted anew; other rows are unchanged.

    Overlapping spans are masked as one.  All columns keep their place and type.
    """
    at, n_at = docs.columns.index("text"), docs.columns.index("n_chars")
    state = {}

    def clean(text: str, spans) -> str:
        out, end = [], 0
        for s, _, e in spans:
            if s >= end:
                out += [text[end:s], mask]
            end = max(end, e)
        return "".join([*out, text[end:]])

    def run(batches):
        scan = state.get("scan") or state.setdefault("scan", _block_scanner(rules))
        for b in row_slices(batches):
            texts, sizes = b.column(at).to_pylist(), b.column(n_at).to_pylist()
            for i, spans in enumerate(scan([t or "" for t in texts])):
                if spans:
                    texts[i] = clean(texts[i], spans)
                    sizes[i] = len(texts[i])
            columns = list(b.columns)
            columns[at], columns[n_at] = pa.array(texts, b.schema.field(at).type), pa.array(sizes, b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return map_rows(docs, run)
