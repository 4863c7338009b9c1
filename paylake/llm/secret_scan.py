"""Secret scan by assignment-aware lexing.

Source and configuration syntax is read as name-literal pairs: ``name = "x"``,
``"name": "x"``, ``cfg["name"] = x``, ``name: str = "x"``, ``name => x``,
``<name>x</name>``. A quoted literal may have a string prefix (``b"x"``, ``f'x'``,
``@"x"``) and be in triple quotes; those, backquoted and ``@`` literals may run
over lines. Constants are propagated (``a = "x"`` followed by
``password = a`` points back at the literal), and a literal is scored by how
sensitive its target name is and how much it looks like a credential. The
fixed patterns ``assign``, ``access`` and ``hex`` are always reported; the
lexer adds ``literal`` spans they do not cover.

Everything is per document: no shuffle, memory bounded by one Arrow batch.
NULL and empty texts have no findings; very long texts are scanned whole, in
time in proportion to their length; repeated rows are scanned each on their own; other columns of the input are passed through untouched.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import fresh, text_of

# Fixed patterns of the scan; a failing match is dropped after matching.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")
# Every ASSIGN match holds one of these in lower case.
ASSIGN_HINTS = ("passw", "secret", "token", "api")

# How sensitive a name is, by the words it is made of.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "credential": 0.9,
    "credentials": 0.9, "token": 0.9, "apikey": 1.0, "authorization": 0.8, "bearer": 0.8, "pass": 0.8,
    "auth": 0.6, "signature": 0.5, "private": 0.4, "access": 0.3, "api": 0.3, "encryption": 0.4,
    "signing": 0.4, "client": 0.1, "key": 0.4, "salt": 0.5, "pin": 0.4, "dsn": 0.6,
}
PLACEHOLDERS = {
    "changeme", "change_me", "example", "password", "passwd", "secret", "token", "none", "null", "nil", "true",
    "false", "undefined", "required", "optional", "string", "redacted", "hidden", "placeholder", "test",
}
SCORE_THRESHOLD = 1.2
MIN_LITERAL = 6

_NAME_CHARS = re.compile(r"[A-Za-z0-9_.\-]")
_TYPE_HINT = re.compile(r"\s*[A-Za-z_][\w.]*(?:\[[\w., ]*\])?\s*=(?![=>])", re.A)
_PREFIX = re.compile(r"""(?:[bfru]{1,2}|\$?@|@?\$)(?=["'])""", re.I | re.A)
_QUOTED = {q: re.compile(rf"{q}((?:[^{q}\\\n]|\\[\s\S])*+){q}") for q in "\"'"}
_QUOTED["`"] = re.compile(r"`((?:[^`\\]|\\[\s\S])*+)`")
_TRIPLE = {3 * q: re.compile(rf"{q}{{3}}((?:[^{q}\\]|\\[\s\S]|{q}(?!{q}{q}))*+){q}{{3}}") for q in "\"'"}
_VERBATIM = re.compile(r'"((?:[^"]|"")*+)"')  # no escapes but a doubled quote
_BLANKS = re.compile(r"(?:\\\n|\s)*+")
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]+""")
_IDENT = re.compile(r"[A-Za-z_][\w.]*", re.A)
_ELEMENT = re.compile(r"<([A-Za-z_][\w.\-]*)>([^<>\n]+)</\1>", re.A)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """Sum of the weights of the name's words (camelCase, snake_case, dotted), at most 1.5."""
    return min(1.5, sum(NAME_WEIGHTS.get(w.lower(), 0.0) for w in set(_WORDS.findall(name))))


def literal_score(value: str) -> float:
    """0 to 1 by length, entropy and character classes; below 0 for placeholders."""
    low = value.lower()
    if len(value) < MIN_LITERAL or low in PLACEHOLDERS or len(set(value)) < 3 or value[0] in "$<{%" \
            or low.startswith(("your", "my_", "xxx", "http://", "https://", "os.", "env.", "process.env")):
        return -1.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]"))
    return min(1.0, 0.08 * entropy + 0.15 * classes + min(n, 40) / 100)


def quoted(text: str, at: int) -> tuple[bool, tuple[int, int] | None]:
    """Whether a quoted literal, prefix included, opens at ``at``, and the span
    of what it holds: None when it is empty or not closed. White space at the
    ends of a literal of several lines is left out."""
    prefix = _PREFIX.match(text, at)
    if prefix:
        at = prefix.end()
    quote = text[at:at + 1]
    if quote not in _QUOTED:
        return False, None
    if prefix and "@" in prefix.group() and quote == '"' and text[at:at + 3] not in _TRIPLE:
        lit = _VERBATIM.match(text, at)
    else:
        triple = _TRIPLE.get(text[at:at + 3])
        lit = (triple and triple.match(text, at)) or _QUOTED[quote].match(text, at)
    if not lit:
        return True, None
    start, end = lit.span(1)
    if "\n" in lit[1]:
        start, end = _BLANKS.match(text, start, end).end(), start + len(lit[1].rstrip())
    return True, (start, end) if end > start else None


def pairs(text: str):
    """(name, literal start, literal end, identifier or None) of every
    assignment, by position. An identifier on the right is a reference."""
    found = []
    for m in re.finditer(r"=>|:=|[=:]", text):
        i, j = m.start(), m.end()
        if m.group() == "=" and (text[j:j + 1] == "=" or text[i - 1:i] in ("=", "!", "<", ">", ":")):
            continue
        k = i
        while k and text[k - 1] in " \t":
            k -= 1
        while k and text[k - 1] in "\"']":
            k -= 1
        end = k
        while k and _NAME_CHARS.match(text[k - 1]):
            k -= 1
        name = text[k:end].strip(".-")
        if not name or not (name[0].isalpha() or name[0] == "_"):
            continue
        if m.group() == ":" and (hint := _TYPE_HINT.match(text, j)):
            j = hint.end()
        while text[j:j + 1] in (" ", "\t"):
            j += 1
        opens, span = quoted(text, j)
        if opens:
            if span:
                found.append((name, *span, None))
        elif lit := _BARE.match(text, j):
            end = lit.end()
            if text[end:end + 1] in ("(", "["):
                continue
            while end > lit.start() and text[end - 1] in ".:":
                end -= 1
            value = text[lit.start():end]
            if value:
                found.append((name, lit.start(), end, value if _IDENT.fullmatch(value) else None))
    if "</" in text:
        found += [(m[1], m.start(2), m.end(2), None) for m in _ELEMENT.finditer(text)]
        found.sort(key=lambda x: x[1])
    return found


def literals(text: str) -> list[tuple[int, int, float]]:
    """Spans of literals whose target name and own shape score at least the threshold."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    out: dict[tuple[int, int], float] = {}
    known: dict[str, tuple[int, int]] = {}
    for name, start, end, ident in pairs(text):
        if ident is not None and ident in known:
            start, end = known[ident]
        known[name] = (start, end)
        weight = name_score(name)
        if weight > 0 and (shape := literal_score(text[start:end])) > 0 and weight + shape >= SCORE_THRESHOLD:
            out[start, end] = max(out.get((start, end), 0.0), round(weight + shape, 3))
    return [(s, e, x) for (s, e), x in out.items()]


def scan_text(text: str) -> list[tuple[int, str, int, float]]:
    """Findings as (start, kind, end, score), by start and then kind as listed."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), "assign", m.end(), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end(), 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), "hex", m.end(), 1.0) for m in HEX.finditer(text)]
    base = sorted((s, e) for s, _, e, _ in found)
    starts, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))

    def inside(s, e):  # of a base span: the farthest end among those that begin before
        at = bisect_right(starts, s)
        return at > 0 and e <= reach[at - 1]
    found += [(s, "literal", e, x) for s, e, x in literals(text) if not inside(s, e)]
    found.sort(key=lambda x: (x[0], KINDS.index(x[1]), x[2]))
    return found


FINDINGS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
_ITEM = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


@F.arrow_udf(FINDINGS)
def _scan(texts: pa.Array) -> pa.Array:
    rows = [[{"kind": k, "start": s, "end": e, "score": x} for s, k, e, x in scan_text(t or "")]
            for t in texts.to_pylist()]
    return pa.array(rows, type=pa.list_(_ITEM))


def scan_secrets(docs: DataFrame, text: str = "text", findings: str | None = None) -> DataFrame:
    """``docs`` with an array of findings (kind, start, end in code points, score) per row."""
    return docs.withColumn(findings or fresh(docs, "findings"), _scan(text_of(text)))


def op2_secret_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base counts, digest of the base spans, all spans."""
    found = scan_secrets(docs.select("doc_id", "text"), findings="findings")

    def spans(items):
        return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")

    def n(kind):
        return F.size(F.filter("findings", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("findings", lambda x: x.kind != "literal")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(spans(base), 256).alias("base_sha256"), spans(F.col("findings")).alias("spans"),
                        n("literal"))
