"""Secret scans: an Aho-Corasick keyword prefilter, anchored regular expressions near hits, then checksum validation.

Kinds found by form alone: ``assign`` (a credential word and its value), ``access`` (access key ids) and ``hex`` (long
lower-case hexadecimal runs). Kinds kept only if an embedded checksum or structure holds: ``forge`` (source-forge
tokens whose last six characters are the CRC-32 of the body in base 62), ``jwt`` (three base64url parts, the
first a JSON object with ``alg``, at the beginning of a run of their characters) and ``iban`` (account numbers of
their country's length, modulus 97). Time is linear in a text: no stretch of characters is read again for each keyword that lies in it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import slices

#: Patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "forge", "jwt", "iban")

FORGE = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})")
IBAN = re.compile(r"IBAN:?\x20?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
#: Lengths of account numbers by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28, EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22,
    GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, LY=25, MC=27, MD=24, ME=22,
    MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27, ST=25, SV=28, TL=23, TN=24, TR=26, UA=29,
    VA=22, VG=24, XK=20,
)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Keywords of the prefilter, all in lower case, with the kind that each can begin.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "forge", "gho_": "forge", "ghu_": "forge", "ghs_": "forge", "ghr_": "forge", "npm_": "forge",
    "eyj": "jwt", "iban": "iban",
}
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Maps characters to h (hexadecimal digit) or a blank, so that a run shows as a plain substring.
_HEXMAP = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_automaton = None


def automaton():
    global _automaton
    if _automaton is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            a.add_word(word, (len(word), kind))
        a.make_automaton()
        _automaton = a
    return _automaton


def _forge_ok(m: re.Match) -> bool:
    n, out = zlib.crc32(m[1].encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out == m[2]


def _jwt_ok(m: re.Match) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, RecursionError):  # not JSON, or nested deeper than a head ever is
        return False
    return isinstance(head, dict) and "alg" in head


def _iban_end(m: re.Match) -> int | None:
    """Where an account number ends: after its country's length, or, for other countries, after the longest valid stretch.

    What follows in the same characters, such as a word in capitals, isn't part of it; it has to end where no letter or digit follows.
    """
    text, ends = m.string, [i + 1 for i in range(m.start(1), m.end(1)) if m.string[i] != " "]
    n = IBAN_LENGTHS.get(m[1][:2])
    for end in ends[n - 1 : n] if n else reversed(ends[14:]):
        if not (end < len(text) and (text[end].isascii() and text[end].isalnum())):
            s = text[m.start(1) : end].replace(" ", "")
            if int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1:
                return end
    return None


def _if(good: Callable[[re.Match], bool]) -> Callable[[re.Match], int | None]:
    return lambda m: m.end() if good(m) else None


#: Kind: anchored pattern, where a match of it ends (None: it is none).
RULES = {
    "assign": (ASSIGN, _if(lambda m: len(m[2]) >= LEAST["assign"])), "access": (ACCESS, _if(lambda m: m.end() - m.start() >= LEAST["access"])),
    "forge": (FORGE, _if(_forge_ok)), "jwt": (JWT, _if(_jwt_ok)), "iban": (IBAN, _iban_end),
}


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    least = LEAST["hex"]
    # One byte a character: what isn't Latin-1 becomes "?", which is no digit, so offsets stay code points.
    mask = text.encode("latin-1", "replace").translate(_HEXMAP)
    need, at = b"h" * least, 0
    while (at := mask.find(need, at)) >= 0:
        end = mask.find(b" ", at + least)
        end = len(mask) if end < 0 else end
        yield at, end
        at = end


def scan(text: str) -> list[tuple[int, int, str]]:
    """All (start, end, kind) of a whole text, in code points, by start and then kind. Leftmost and non-overlapping within a kind."""
    lower = text.lower() if text.isascii() else text.translate(_LOWER)
    hits: dict[str, list[int]] = {}
    for end, (n, kind) in automaton().iter(lower):
        hits.setdefault(kind, []).append(end - n + 1)
    found = [(a, b, "hex") for a, b in _hex_runs(text)]
    for kind, starts in hits.items():
        pattern, ends = RULES[kind]
        free = 0
        for at in sorted(starts):
            if at >= free and (m := pattern.match(text, at)):
                if end := ends(m):
                    found.append((at, end, kind))
                    free = end
                elif kind in LEAST:  # a match that is dropped still covers its characters
                    free = m.end()
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` lists every finding as kind:start:end (code points, end exclusive) by start, then kind. No shuffle; texts
    of any length are scanned whole. Null text counts as empty (no findings, the hash of an empty list); a null id stays null;
    repeated rows are scanned each; an empty table gives none; other columns are ignored.
    """

    @F.arrow_udf("struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, spans: string>")
    def found(column: pa.Array) -> pa.Array:
        rows = []
        for part in slices(column):
            for text in part.to_pylist():
                spans = scan(text or "")
                base = [s for s in spans if s[2] in LEAST]
                count = [sum(s[2] == kind for s in base) for kind in LEAST]
                rows.append((*count, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        columns = list(zip(*rows)) or [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col(id_col), found(F.col(text_col)).alias("_found")).select(id_col, "_found.*")


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with each finding replaced by ``[kind]`` (overlapping findings by one mark, the first's); rows and columns stay.

    ``chars_col`` is recounted where ``docs`` has it. Null text stays null, a text without findings (empty ones too)
    stays as it is, repeated rows are treated each, an empty table gives none, and other columns stay, whatever their names.
    """

    @F.arrow_udf("string")
    def clean(column: pa.Array) -> pa.Array:
        out = []
        for part in slices(column):
            for text in part.to_pylist():
                out.append(None if text is None else _redacted(text))
        return pa.array(out, pa.string())

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    if chars_col and chars_col in docs.columns:
        out = out.withColumn(chars_col, F.char_length(text_col).cast(docs.schema[chars_col].dataType))
    return out.select(docs.columns)


def _redacted(text: str) -> str:
    parts, at = [], 0
    for a, b, kind in scan(text):
        if a >= at:
            parts += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]]) if parts else text
