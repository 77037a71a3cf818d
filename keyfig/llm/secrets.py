"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class.

Patterns (``BASE``) are found leftmost and without overlap per kind; matches under a kind's
minimum length are dropped after they have been found.  In addition every run of token
characters is a candidate: a window of ``WINDOW`` characters slides over it, counts change by one
character in and one out, and windows whose entropy reaches the threshold of the candidate's
character class become ``entropy`` spans (overlapping windows are one span).  Candidates that an
allow-list pattern matches whole are left out; pattern spans never are.

Spans are ``kind:start:end`` in code points, end exclusive.  Defined results: a null text is
empty and has no span; repeated rows have a row each; whole texts are scanned, however long.
"""

from __future__ import annotations

import re
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from keyfig.llm.common import annotate

#: kind: (pattern on the text with A-Z lower-cased, pattern sees lower case, group measured, least length)
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", True, 2, 12),
    "access": (r"AKIA[A-Z0-9]+", False, 0, 18),
    "hex": (r"[0-9a-f]{16,}", False, 0, 16),  # maximal runs, so the least length may stand in the pattern
}
KINDS = [*BASE, "entropy"]

WINDOW = 24
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{WINDOW},}}={{0,2}}")
#: Character class, its pattern, least entropy in bits of a window; digits alone are no secret.
CLASSES = [("digits", re.compile(r"[0-9]+"), None), ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0),
           ("letters", re.compile(r"[A-Za-z]+"), 4.2), ("alphanumeric", re.compile(r"[A-Za-z0-9]+"), 3.9),
           ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 4.0)]
#: Whole candidates that are no secrets: UUIDs, ruler lines, alphabets, documented sample keys.
ALLOW = [r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[-=_+/]+", r".*EXAMPLE.*",
         r"(?i:(0123456789)?abcdefghijklmnopqrstuvwxyz(0123456789)?)", r"0123456789abcdef(0123456789abcdef)*"]

RESULT = "struct<n_assign:long,n_access:long,n_hex:long,n_entropy:long,base:string,spans:string>"
ARROW = pa.struct([(f"n_{k}", pa.int64()) for k in KINDS] + [("base", pa.string()), ("spans", pa.string())])

_TERM = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def entropy_runs(text: str, least: float) -> list[tuple[int, int]]:
    """Ranges covered by windows of at least ``least`` bits; O(1) work per character."""
    counts: dict[str, int] = {}
    total, out, limit = 0.0, [], (log2(WINDOW) - least) * WINDOW + 1e-9
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if i >= WINDOW:
            gone = text[i - WINDOW]
            n = counts[gone]
            total += _TERM[n - 1] - _TERM[n]
            counts[gone] = n - 1
        if i >= WINDOW - 1 and total <= limit:
            start = i - WINDOW + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


class Scanner:
    def __init__(self, allow: list[str] = ALLOW):
        self.base = [(kind, re.compile(p, re.ASCII), lower, group, least) for kind, (p, lower, group, least) in BASE.items()]
        self.allow = re.compile("|".join(f"(?:{p})" for p in allow)) if allow else None

    def base_spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, place of the kind, end)"""
        lowered = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z alone
        return [(m.start(), k, m.end()) for k, (_, pattern, lower, group, least) in enumerate(self.base)
                for m in pattern.finditer(lowered if lower else text) if m.end(group) - m.start(group) >= least]

    def entropy_spans(self, text: str) -> list[tuple[int, int, int]]:
        out = []
        for m in CANDIDATE.finditer(text):
            found = m.group()
            least = next(least for _, pattern, least in CLASSES if pattern.fullmatch(found))
            if least is None or self.allow and self.allow.fullmatch(found):
                continue
            out += [(m.start() + a, len(BASE), m.start() + b) for a, b in entropy_runs(found, least)]
        return out

    def scan(self, column: pa.Array) -> pa.Array:
        rows = []
        for text in column.to_pylist():
            text = text or ""
            base = sorted(self.base_spans(text))
            spans = sorted(base + self.entropy_spans(text))
            row = {f"n_{kind}": sum(s[1] == k for s in spans) for k, kind in enumerate(KINDS)}
            join = lambda x: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in x)
            rows.append(row | {"base": join(base), "spans": join(spans)})
        return pa.array(rows, ARROW)


def find_secrets(docs: DataFrame, text: str = "text", allow: list[str] = ALLOW, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: counts per kind, pattern spans, all spans."""
    return annotate(docs, lambda: Scanner(allow).scan, RESULT, text, keep, "secrets")
