"""Secret scans: keyword automaton, anchored patterns at its hits, checksums.

One Aho-Corasick pass over a lower-case copy of a text finds the keywords that a secret
starts with.  Only there is a pattern tried, anchored at the hit.  Token formats with an
embedded checksum or a checkable structure are reported only if that holds.

Copies of the text for searching keep one byte per code point (what is beyond Latin-1
becomes "?"), so places in them are code points of the text.  Long lower-case hexadecimal
runs have no keyword: for them the copy maps each hexadecimal digit to one letter, and the
keyword is 24 of that letter.

Kinds, in the order in which they are listed.  Base: assign, access, hex.  Added: github
and npm (last six characters are a base-62 CRC-32 of those before), jwt (header decodes
to JSON with "alg"), pem (a private key block whose body is base 64).
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, slices, strings

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: The keywords, in lower case, that a secret of a kind starts with.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "pem": ("-----begin",),
}
#: The pattern of each kind, to be matched at a hit.
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})"),
    "pem": re.compile(r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_HEX = bytes(104 if chr(c) in "0123456789abcdef" else 46 for c in range(256))
_RUN = b"h" * LEAST["hex"]
#: The run that the first part of a jwt is in: where a match fails, it fails all along it.
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]+")


def checksum62(body: str) -> str:
    """CRC-32 of an ASCII text as six base-62 digits."""
    value, out = zlib.crc32(body.encode("ascii")), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


def _holds(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= LEAST["assign"]
    if kind in LEAST:
        return len(m[0]) >= LEAST[kind]
    if kind in ("github", "npm"):
        return checksum62(m[1]) == m[2]
    try:
        if kind == "jwt":
            head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
            return isinstance(head, dict) and "alg" in head
        return len(base64.b64decode("".join(m[2].split()), validate=True)) >= 16
    except (ValueError, binascii.Error):
        return False


class Scanner:
    """All spans (kind, start, end) of a text."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for w in words:
                self.automaton.add_word(w, (kind, len(w)))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        if not text:
            return []
        raw = text.encode("latin-1", "replace")
        past = dict.fromkeys(KINDS, 0)
        spans: list[tuple[int, int, int]] = []

        def attempt(kind: str, start: int) -> None:
            if start < past[kind]:
                return
            if m := PATTERNS[kind].match(text, start):
                past[kind] = m.end()  # a match that fails its check still takes its place
                if _holds(kind, m):
                    spans.append((m.start(), KINDS.index(kind), m.end()))
            elif kind == "jwt" and (run := _JWT_RUN.match(text, start)):
                past[kind] = run.end()  # a start further on in the run has the same behind it

        for last, (kind, length) in self.automaton.iter(raw.translate(_LOWER).decode("latin-1")):
            attempt(kind, last + 1 - length)
        digits = raw.translate(_HEX)
        at = digits.find(_RUN)
        while at >= 0:
            attempt("hex", at)
            at = digits.find(_RUN, past["hex"])
        return [(KINDS[k], a, b) for a, k, b in sorted(spans)]


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and spans (array of kind, start, end; code points, end exclusive), one row per
    row of ``docs``.

    A null or empty text has an empty array; spans are in order of start and then, where
    two begin at one place, of kind; a null id stays null.  Every row is scanned by itself,
    so repeated rows give repeated results; an empty table gives none.  A text of any length
    is scanned whole: an attempt that fails is not made again inside the run that it failed
    on, so time is in proportion to the length.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("id", pa.int64()), ("spans", pa.list_(span))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner()
        for batch in slices(batches):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in strings(batch.column(1))]
            yield record_batch(schema, [batch.column(0), found])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text)), work, "id long, spans array<struct<kind:string,start:long,end:long>>")
