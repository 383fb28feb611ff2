"""Secrets in texts: fixed patterns, and literals that sensitive names are assigned to.

The patterns give spans of kind assign, access and hex. The lexer reads source and configuration
syntax (`name = "literal"`, `name: literal`, `"name": "literal"`, `NAME=$OTHER`, sums of parts,
typed declarations with the type after or before `:`, `name[] =`, `owner["name"] =`, `$name =`, `#define name`, triple-quoted and
backtick literals, literals in parentheses, `a, b = "x", "y"` by place, default arguments of a call, YAML blocks, anchors and tags, XML elements
and their `name`, `key` or `id` with a `value`) into pairs of a name and literals, follows names that stand for earlier literals (constants, of any of these forms), and
scores each literal by the most sensitive name it reaches and by its own look. Literals with a
score of `least` or more are spans of kind `literal`.

Spans are code points, the end exclusive. Null counts as empty; texts without spans have zero
counts. Repeated rows get equal results. Only doc_id and text are read. Patterns have no two
adjoining loops over the same characters, and the ends of elements are found by scans that don't go
over a character twice, so time is linear in a text's length; nothing is kept from one text to the next.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import pieces
from dockflow.llm.textbytes import text_of

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("passw", "secret", "token", "api")

QUOTED = r"""(?:[rRbBuUfFL@$]{1,2}(?=["'`]))?(?:\"""(?:[^\\]|\\.)*?\"""|\'\'\'(?:[^\\]|\\.)*?\'\'\'|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`)""".replace("(?:[^\\\\]|\\\\.)", "(?:[^\\\\]|\\\\[\\s\\S])")
PART = rf"""(?:{QUOTED}|[A-Za-z0-9+/_.@$\{{\}}~=-]+)"""
#: A type: names with arguments in brackets, alternatives, marks of arrays and pointers.
TYPE = r"""[*&?]*(?:\[\d*\])*[A-Za-z_][\w.]{0,63}(?:\[[^\]\n=]{0,64}\]+|<[^>\n=]{0,64}>+)*[?!*&]*(?:[ \t]*\|[ \t]*[A-Za-z_][\w.]{0,63}(?:\[[^\]\n=]{0,64}\]+)*)*"""
KNOWN_TYPE = r"""(?:\[\]byte|\[\]rune|\*?string|String|str|char|text|byte|bytes|varchar|NSString)\b"""
#: What follows the target's name: dimensions, a type, the operator.
ASSIGNED = rf"""(?:(?:\[[ \t]*\w{{0,32}}[ \t]*\]){{0,3}}[ \t]*(?::=|=>|=(?!=))|\??[ \t]*:[ \t]*{TYPE}[ \t]*=(?![=>])(?=[ \t]*["'`rRbBuUfFL@$])|[ \t]+{KNOWN_TYPE}[ \t]*=(?!=)|[ \t]*:(?![:=]))"""
SUBSCRIPT = r"""\[[ \t]*["']([A-Za-z_][A-Za-z0-9_.-]*)["'][ \t]*\][ \t]*(?::=|=(?!=))"""
#: Before a value: a YAML anchor or tag, parentheses.
OPENED = r"""[ \t]*(?:(?:&|!!?)[\w-]+[ \t]+){0,2}(?:\([ \t\n]*){0,4}"""
START = r"""(?<![\w.$-])["']?(?:\$(?:env:)?)?"""
PAIR = re.compile(rf"""(?:{START}([A-Za-z_][A-Za-z0-9_.-]*)["']?{ASSIGNED}|{SUBSCRIPT}){OPENED}({PART}(?:[ \t]*\+[ \t]*{PART})*)""", re.A)
DEFINE = re.compile(rf"""^[ \t]*\#[ \t]*define[ \t]+([A-Za-z_]\w*)[ \t]+\(?({PART})""", re.A | re.M)
#: Names and as many values, by place.
SEVERAL = re.compile(rf"""{START}([A-Za-z_][\w.]*(?:[ \t]*,[ \t]*\$?[A-Za-z_][\w.]*){{1,15}})[ \t]*=(?!=)[ \t]*[(\[]?[ \t]*({PART}(?:[ \t]*,[ \t]*{PART}){{1,15}})""", re.A)
#: Arguments of a call that are looked at.
ARGUMENTS = 8
#: `name: |` and the more indented lines after it.
BLOCK = re.compile(r"""^([ \t]*(?:-[ \t]+)?)["']?([A-Za-z_][A-Za-z0-9_.-]*)["']?[ \t]*:[ \t]*(?:(?:&|!!?)[\w-]+[ \t]+){0,2}[|>][-+0-9]{0,2}[ \t]*\n((?:[ \t]*\n)*)(\1[ \t]+[^\n]*(?:\n(?:\1[ \t]+[^\n]*|[ \t]*(?=\n)))*)""", re.A | re.M)
ELEMENT = re.compile(r"""<([A-Za-z_][\w.:-]*)((?:[ \t\n]+[A-Za-z_][\w.:-]*[ \t]*=[ \t]*(?:"[^"<]*"|'[^'<]*'))*)[ \t\n]*(/?)>""", re.A)
BLANKS = re.compile(r"[ \t\n]*")
CDATA, CDATA_END = "<![CDATA[", "]]>"
ATTRIBUTE = re.compile(r"""([A-Za-z_][\w.:-]*)[ \t]*=[ \t]*(?:"([^"<]*)"|'([^'<]*)')""", re.A)
ONE = re.compile(PART, re.A)
OPENING = re.compile(r"""([rRbBuUfFL@$]{0,2})(\"""|\'\'\'|["'`])(?=[\s\S]*\2$)""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+", re.A)
REFERENCE = re.compile(r"(?:\$\{?)?([A-Za-z_][A-Za-z0-9_.-]*)\}?", re.A)
#: How sensitive a part of a name is.
WEIGHTS = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "private": 0.5, "access": 0.4, "key": 0.5, "api": 0.3, "signing": 0.4, "encryption": 0.4, "bearer": 0.8}
#: Names that are about secrets without holding one.
HARMLESS = {"count", "counts", "length", "size", "limit", "max", "min", "type", "name", "expires", "expiry", "url", "path", "file", "id", "field", "label", "policy", "public"}
PLACEHOLDER = re.compile(r"(?i)x+|\*+|\.+|changeme|example|placeholder|none|null|true|false|todo|test|dummy|your[_-].*", re.A)


def sensitivity(name: str) -> float:
    parts = [x.lower() for x in NAME_PARTS.findall(name)]
    if parts and parts[-1] in HARMLESS:
        return 0.0
    return min(1.0, sum(WEIGHTS.get(x, 0.0) for x in parts))


def is_placeholder(literal: str) -> bool:
    line = literal.removesuffix("\n")
    if "\n" in line:
        return False
    return "${" in line or (line.startswith("<") and line.endswith(">")) or PLACEHOLDER.fullmatch(line) is not None


def look(literal: str) -> float:
    """0 for what can't be a secret, up to 1 for long and irregular literals."""
    if len(literal) < 6 or is_placeholder(literal):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(bool(re.search(k, literal)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.25 + entropy / 6 + 0.1 * (kinds - 1))


Span = tuple[int, int, str]


def literal_of(start: int, part: str) -> Span | None:
    """The literal in a quoted part."""
    if q := OPENING.match(part):
        wide = len(q[2])
        return start + q.end(), start + len(part) - wide, part[q.end() : -wide]
    return None


def arguments(text: str, at: int) -> list[Span]:
    """The literals among the arguments of a call whose bracket opens at `at`; of several, the first is
    what is asked for and the others are defaults."""
    own = []
    for _ in range(ARGUMENTS):
        at = BLANKS.match(text, at + 1).end()
        m = ONE.match(text, at)
        if m is None:
            break
        own.append(literal_of(at, m[0]))
        at = BLANKS.match(text, m.end()).end()
        if text[at : at + 1] != ",":
            break
    return [x for x in (own[1:] if len(own) > 1 else own) if x]


def assigned(text: str) -> list[tuple[int, str, list[Span], list[Span]]]:
    """(start, name, literals, words that may be names) of `name = value` in its forms."""
    out, taken = [], []

    def value(at: int, part: str) -> tuple[list[Span], list[Span]]:
        """The literal of a part or a call, or the bare word, which is a literal if it names nothing."""
        if found := literal_of(at, part):
            return [found], []
        end = at + len(part)
        if text[end : end + 1] == "(":
            return arguments(text, end), []
        return ([], [(at, end, part)]) if REFERENCE.fullmatch(part) else ([(at, end, part)], [])

    for m in SEVERAL.finditer(text) if "," in text else ():
        names, parts = re.split(r"[ \t]*,[ \t]*", m[1]), list(ONE.finditer(m[2]))
        if len(names) == len(parts):
            taken.append(m.span())
            out += [(m.start(), n.lstrip("$"), *value(m.start(2) + p.start(), p[0])) for n, p in zip(names, parts, strict=True)]
    ends = iter([*taken, (len(text) + 1, len(text) + 1)])
    low, high = next(ends)
    for m in PAIR.finditer(text):
        while m.start() >= high:
            low, high = next(ends)
        if m.start() < low:
            found = [value(m.start(3) + p.start(), p[0]) for p in ONE.finditer(m[3])]
            out.append((m.start(), m[1] or m[2], [x for own, _ in found for x in own], [x for _, to in found for x in to]))
    if "define" in text:
        out += [(m.start(), m[1], *value(m.start(2), m[2])) for m in DEFINE.finditer(text)]
    return out


def pairs(text: str) -> list[tuple[float, int, int, str]]:
    """(sensitivity, start, end, literal) of every assigned literal: of the most sensitive name that
    it reaches, directly or by constants. An assignment refers to the latest earlier one of a name,
    so one pass back over the assignments settles all of them."""
    literals: list[list[Span]] = []
    refers: list[list[int]] = []
    worth: list[float] = []
    latest: dict[str, int] = {}
    found = assigned(text) + blocks(text) + elements(text)
    for _, name, own, words in sorted(found, key=lambda x: x[0]):
        to = [(REFERENCE.fullmatch(x[2])[1], x) for x in words]
        refers.append([latest[n] for n, _ in to if n in latest])
        literals.append(own + [x for n, x in to if n not in latest])
        latest[name] = len(worth)
        worth.append(sensitivity(name))
    for i in range(len(worth) - 1, -1, -1):
        for to in refers[i]:
            worth[to] = max(worth[to], worth[i])
    return [(w, *x) for w, own in zip(worth, literals, strict=True) for x in own]


def stripped(text: str, start: int, end: int) -> Span:
    part = text[start:end]
    start += len(part) - len(part.lstrip())
    return start, start + len(part.strip()), part.strip()


def literal_or_name(found: Span) -> tuple[list[Span], list[Span]]:
    """A value that is nothing but `$NAME` or `${NAME}` may be a name."""
    return ([], [found]) if found[2].startswith("$") and REFERENCE.fullmatch(found[2]) else ([found], [])


def blocks(text: str) -> list[tuple[int, str, list[Span], list[Span]]]:
    """Block values of YAML, as `assigned`."""
    found = BLOCK.finditer(text) if "|" in text or ">" in text else ()
    return [(m.start(2), m[2], *literal_or_name(stripped(text, m.start(4), m.end(4)))) for m in found]


def elements(text: str) -> list[tuple[int, str, list[Span], list[Span]]]:
    """Texts of XML elements by the element's name or its `name`, `key` or `id`, and their `value`, as
    `assigned`. An element's text ends at the next `<`, a CDATA section at the next `]]>`; where the
    latter ends is kept, so no character is looked at for it twice."""
    out, at, closed = [], 0, -1
    while (m := ELEMENT.search(text, at)) if "<" in text else None:
        at = m.end()
        places = {a[1].lower(): (m.start(2) + a.start(a.lastindex), m.start(2) + a.end(a.lastindex)) for a in ATTRIBUTE.finditer(m[2])}
        names = [m[1].split(":")[-1], *(text[slice(*places[k])] for k in ("name", "key", "id") if k in places)]
        inner = []
        if not m[3]:
            first = BLANKS.match(text, at).end()
            if text.startswith(CDATA, first):
                begin = first + len(CDATA)
                if 0 <= closed < begin or closed == -1:
                    closed = text.find(CDATA_END, begin)
                    closed = len(text) if closed < 0 else closed
                after = BLANKS.match(text, closed + len(CDATA_END)).end() if closed < len(text) else closed
                if text.startswith(f"</{m[1]}", after):
                    inner, at = [(begin, closed)], after
            else:
                end = text.find("<", at)
                if end >= 0 and text.startswith(f"</{m[1]}", end) and text.find(">", at, end) < 0:
                    inner, at = [(at, end)], end
        found = [stripped(text, *x) for x in [*inner, *([places["value"]] if "value" in places else [])]]
        if found := [literal_or_name(x) for x in found if x[2]]:
            out.append((m.start(), max(names, key=sensitivity), [x for own, _ in found for x in own], [x for _, to in found for x in to]))
    return out


def spans(text: str, least: float = 0.6) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    found: set[tuple[int, int, int]] = set()
    low = text.lower()
    if any(h in low for h in HINTS):
        found |= {(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6}
    if "AKIA" in text:
        found |= {(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20}
    found |= {(m.start(), 2, m.end()) for m in HEX.finditer(text)}
    if "=" in text or ":" in text or "</" in text or "define" in text:
        found |= {(start, 3, end) for worth, start, end, literal in pairs(text) if worth and worth * look(literal) >= least}
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_literal of every row."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"]

    def read(batches):
        for batch in batches:
            for piece in pieces(batch):
                rows = []
                for doc_id, text in zip(text_of(piece, "doc_id").to_pylist(), text_of(piece).to_pylist(), strict=True):
                    found = spans(text or "", least)
                    n = Counter(k for k, _, _ in found)
                    base = joined([x for x in found if x[0] != "literal"])
                    rows.append((doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(base.encode()).hexdigest(), joined(found), n["literal"]))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_literal", pa.int64())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")
