"""Secrets in texts: fixed patterns, and windows of high Shannon entropy.

Base patterns find assignments, access keys and hexadecimal runs. The entropy scan takes runs of token characters that no
base span covers, or the parts of a run outside of base spans, and slides a window over them once for each character class. Entering and leaving characters change
the counts, and with them the sum of c log c, so each step costs the same. Windows of a class whose characters come
from the kinds the class asks for and whose entropy reaches the class's limit join to spans. Runs that an allow-list
pattern matches are let go: identifiers of fixed form, placeholders, and runs within a mail address, a host name or the
path behind a host. What stands between a scheme and the @ of an address is a user and a password, and is scanned.

Offsets are code points, end exclusive. Cases: null text counts as empty and has no spans; rows of equal ids are
scanned each by itself.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones only fail
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

# Window, the characters of a class, the kinds of character a window must hold, least entropy in bits.
CLASSES = {
    "hex": (20, frozenset("0123456789abcdefABCDEF"), ("digit", "letter"), 3.0),
    "base36": (20, frozenset("0123456789abcdefghijklmnopqrstuvwxyz"), ("digit", "lower"), 3.6),
    "base64": (20, frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), ("digit", "lower", "upper"), 3.8),
}
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),  # random identifiers
    re.compile(r"(?ai:.*(?:example|placeholder|changeme|dummy|xxxx).*)"),
    re.compile(r"[0-9/_=+-]+"),  # numbers, dates, rules
    re.compile(r"(?:[a-z]+[-_/])+[a-z]*[0-9]{0,4}"),  # words in a path or a name
)
# Addresses by their whole form. Host names without a scheme are in lower case, and their first label is scanned.
URL = re.compile(r"""://([^\s/?#@:]{0,512}:(?!\d{1,5}[/?#])[^\s@]{0,512}@|[^\s/?#@]{1,512}@)?([^\s/?#@"'<>]+(?:/[^\s?#"'<>]*)?)""")
MAIL = re.compile(r"(?<![A-Za-z0-9._%+=/-])[A-Za-z0-9._%+=/-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9_+=-])")
HOST = re.compile(r"(?<![A-Za-z0-9._@-])[a-z0-9-]{1,63}\.((?:[a-z0-9-]{1,63}\.)*[a-z]{2,6}(?![A-Za-z0-9_+=-])(?::\d{1,5})?(?:/[^\s?#\"'<>]*)?)")
_HEX_BYTES = bytes(1 if chr(c) in "0123456789abcdef" else 0 for c in range(256))
_RUN_BYTES = bytes(1 if chr(c).isascii() and (chr(c).isalnum() or chr(c) in "+/_=-") else 0 for c in range(256))
_HEX_RUN, _TOKEN_RUN = b"\x01" * 16, b"\x01" * 20
_NAMES = ("passw", "secret", "token", "key")


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end); a look for the least that a match needs saves most texts the patterns."""
    found, lower = [], raw.lower()
    if any(n.encode() in lower for n in _NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if _HEX_RUN in raw.translate(_HEX_BYTES):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _sort_of(c: str) -> str:
    return "digit" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "sign"


def entropy_windows(run: str, window: int, alphabet: frozenset, needs: tuple[str, ...], least: float) -> Iterator[tuple[int, int]]:
    """Merged places of windows within one class whose entropy reaches ``least``."""
    counts: Counter = Counter()
    kinds: Counter = Counter()
    total, held, span = 0.0, 0, None
    log_window = math.log2(window)

    def change(c: str, by: int) -> float:
        n = counts[c]
        counts[c] = n + by
        after = n + by
        return (after * math.log2(after) if after else 0.0) - (n * math.log2(n) if n else 0.0)

    for i, c in enumerate(run):
        if c not in alphabet:
            counts.clear()
            kinds.clear()
            total, held = 0.0, 0
            continue
        total += change(c, 1)
        kinds[_sort_of(c)] += 1
        held += 1
        if held > window:
            gone = run[i - window]
            total += change(gone, -1)
            kinds[_sort_of(gone)] -= 1
            held = window
        if held == window and log_window - total / window >= least and all(kinds["lower"] + kinds["upper"] if k == "letter" else kinds[k] for k in needs):
            if span and i - window + 1 <= span[1]:
                span = (span[0], i + 1)
            else:
                if span:
                    yield span
                span = (i - window + 1, i + 1)
    if span:
        yield span


def address_spans(text: str) -> list[tuple[int, int]]:
    """Hosts with their paths and mail addresses; never the user and password of an address."""
    found, users = [], []
    for m in URL.finditer(text):
        found += [(m.start(), m.start() + 3), m.span(2)]
        if m.group(1):
            users.append(m.span(1))
    if "@" in text:
        starts = [a for a, _ in users]
        for m in MAIL.finditer(text):
            at = bisect_right(starts, m.end() - 1) - 1
            if at < 0 or users[at][1] <= m.start():
                found.append(m.span())
    found += [m.span(1) for m in HOST.finditer(text)]
    open_ = _joined(users)
    return [part for a, b in found for part in _outside(a, b, open_)]


def _outside(start: int, end: int, closed: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of start..end that none of the sorted, disjoint spans covers."""
    for a, b in closed[max(0, bisect_right(closed, (start, start)) - 1) :]:
        if a >= end:
            break
        if b > start:
            if a > start:
                yield start, a
            start = b
    if start < end:
        yield start, end


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def entropy_spans(text: str, raw: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if _TOKEN_RUN not in raw.translate(_RUN_BYTES):
        return []
    found: list[tuple[int, int, int]] = []
    closed = None
    for m in RUN.finditer(text):
        run = m.group()
        if not any(c.isdigit() for c in run) or any(p.fullmatch(run) for p in ALLOW):
            continue
        if closed is None:
            closed = _joined([(a, b) for a, _, b in base] + address_spans(text))
        for a, b in _outside(m.start(), m.end(), closed):
            part = text[a:b]
            if b - a >= 20 and any(c.isdigit() for c in part) and not any(p.fullmatch(part) for p in ALLOW):
                found += _windows(part, a)
    return found


def _windows(run: str, start: int) -> list[tuple[int, int, int]]:
    places = _joined([p for rule in CLASSES.values() for p in entropy_windows(run, *rule)])
    return [(start + a, 3, start + b) for a, b in places]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _scan(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]
    types = [pa.int64()] * 5 + [pa.string()] * 2
    for batch in part:
        out = []
        for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = raw.decode()
            base = base_spans(text, raw)
            more = entropy_spans(text, raw, base)
            kinds = Counter(k for _, k, _ in base)
            out.append((doc, kinds[0], kinds[1], kinds[2], len(more), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + more)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 7, types, strict=True)], names=names)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans (kind:start:end, by start, then kind)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    return narrow.mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")
