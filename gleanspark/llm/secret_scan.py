"""Secret scan: Aho-Corasick keywords, anchored patterns near their hits, then validation.

Base kinds: `assign`, `access`, `hex`. Kinds that carry proof in themselves: `github` and `npm`
tokens (a CRC-32 in base 62 closes them), `jwt` (a JSON header that names its algorithm) and `pem`
(a key block with its end). Spans are code points, end exclusive. Within a kind, matches are leftmost
and do not overlap; a match that is too short or fails validation is dropped but still uses up its text.

Edge cases: a null text counts as empty; repeated rows give repeated results; an empty table gives
an empty result; extra columns are ignored; spans that begin together come in the order of KINDS; texts are read whole, in linear time.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanspark.llm.arrowmap import ascii_lower, map_texts, slices

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_URLSAFE = re.compile(r"[A-Za-z0-9_-]+")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ ){0,3}PRIVATE KEY)-----")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Of any 24 hex digits in a row, four lie on multiples of this step.
_STEP, _MIN_HEX, _MIN_ACCESS, _MIN_ASSIGN = 6, 24, 20, 6
_SAMPLED = re.compile(r"[0-9a-f]{4,}")


def base62_crc(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, rest = divmod(n, 62)
        out = _DIGITS[rest] + out
    return out


def _closed_by_crc(match: re.Match) -> bool:
    return base62_crc(match[1]) == match[2]


def _automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for kind, terms in (
        ("assign", "password passwd secret token apikey api_key"),
        ("access", "akia"),
        ("github", "ghp_ gho_ ghu_ ghs_ ghr_"),
        ("npm", "npm_"),
        ("jwt", "eyj"),
        ("pem", "-----begin"),
    ):
        for term in terms.split():
            words.add_word(term, (kind, len(term)))
    words.make_automaton()
    return words


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Whole runs of 24 hex digits or more, found from every sixth character."""
    for found in _SAMPLED.finditer(text[::_STEP]):
        at, last = found.start() * _STEP, (found.end() - 1) * _STEP
        low = max(0, at - _STEP + 1)
        while at <= last:
            end, start = _HEX.match(text, at).end(), at
            while start > low and text[start - 1] in "0123456789abcdef":
                start -= 1
            if end - start >= _MIN_HEX:
                yield start, end
            low = end
            at = -(-end // _STEP) * _STEP


def _jwt(text: str, at: int) -> tuple[int, bool]:
    """(end of what was read, whether it is a token) for a header that starts here."""
    head = _URLSAFE.match(text, at)
    parts, end = [head[0]], head.end()
    while len(parts) < 3 and text[end : end + 1] == "." and (part := _URLSAFE.match(text, end + 1)):
        parts.append(part[0])
        end = part.end()
    if len(parts) < 3:
        return end, False
    try:
        header = json.loads(base64.urlsafe_b64decode(parts[0] + "=" * (-len(parts[0]) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return end, False
    return end, isinstance(header, dict) and isinstance(header.get("alg"), str)


class SecretScanner:
    def __init__(self):
        self.words = _automaton()

    def __call__(self, text: str) -> list[tuple[int, int, str]]:
        """All spans (start, end, kind), by start and then in the order of KINDS."""
        spans, free = [], dict.fromkeys(KINDS, 0)
        closes: dict[str, int] = {}
        low = ascii_lower(text)
        for end_at, (kind, size) in sorted(self.words.iter(low), key=lambda x: x[0] - x[1][1]):
            at = end_at - size + 1
            if at < free[kind]:
                continue
            if kind == "assign":
                if match := _ASSIGN.match(text, at):
                    free[kind] = match.end()
                    if len(match[2]) >= _MIN_ASSIGN:
                        spans.append((at, match.end(), kind))
            elif kind == "access":
                if match := _ACCESS.match(text, at):
                    free[kind] = match.end()
                    if match.end() - at >= _MIN_ACCESS:
                        spans.append((at, match.end(), kind))
            elif kind in ("github", "npm"):
                if (match := (_GITHUB if kind == "github" else _NPM).match(text, at)) and _closed_by_crc(match):
                    free[kind] = match.end()
                    spans.append((at, match.end(), kind))
            elif kind == "jwt":
                if text.startswith("eyJ", at):
                    free[kind], whole = _jwt(text, at)
                    if whole:
                        spans.append((at, free[kind], kind))
            elif match := _PEM.match(text, at):
                close = f"-----END {match[1]}-----"
                if closes.get(close, 0) >= 0 and (end := text.find(close, match.end())) >= 0:
                    free[kind] = end + len(close)
                    spans.append((at, free[kind], kind))
                else:
                    closes[close] = -1  # none follows, so none will for later starts
        spans += [(start, end, "hex") for start, end in _hex_runs(text)]
        return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, or union of touching ones, replaced by a mark."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind} removed]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: counts of base kinds, their digest, and all spans; map-only."""

    def start():
        scan = SecretScanner()

        def work(texts):
            found = [scan(t or "") for t in texts]
            base = [[s for s in spans if s[2] in BASE_KINDS] for spans in found]
            made = {f"n_{k}": pa.array([sum(s[2] == k for s in spans) for spans in base], pa.int64()) for k in BASE_KINDS}
            made["base_sha256"] = pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base], pa.string())
            return made | {"spans": pa.array(map(_joined, found), pa.string())}

        return work

    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(docs, [id_col], text_col, schema, start)


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, with secrets replaced in the text and the length column set anew where a text changed."""
    schema, names = docs.schema, docs.columns

    def run(batches):
        scan = SecretScanner()
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                made = [t if t is None else redact(t, scan(t)) for t in texts]
                columns = {n: part.column(n) for n in names} | {text_col: pa.array(made, part.schema.field(text_col).type)}
                if length_col in names:
                    sizes = [n if a == b or b is None else len(b) for a, b, n in zip(texts, made, part.column(length_col).to_pylist(), strict=True)]
                    columns[length_col] = pa.array(sizes, part.schema.field(length_col).type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(run, schema)
