"""Secret scans: base patterns, and assignment-aware lexing on top.

Source and configuration text is read as names, operators and literals: assignments, mappings, quotes over several
lines, indented blocks after ``name: |``, markup elements, and markup attributes of which one names (``key``, ``name``)
what another holds (``value``). Pairs of name and literal are scored by how sensitive the name is and by what the literal
looks like; a name that is assigned another name or a sum of literals takes over their constants, so a key that reaches a
sensitive name by way of a plain one is found where it stands. A name that is used before it is assigned takes its first
constant. Base spans are always kept; an added span (kind ``literal``) is left out where a base span already covers it.
The length of a literal, a name or a sum and the number of constants are not limited: patterns never go back over what
they took, and a sum is held as its parts with a count of its characters, not as text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, table, texts_of, workers_can_import

BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: How sensitive a name is, by the first part of it that matches.
SENSITIVE = (
    (re.compile(r"passw(?:or)?d|passphrase|pwd", re.I | re.A), 0.6),
    (re.compile(r"secret|private_?key|client_?secret", re.I | re.A), 0.6),
    (re.compile(r"api_?key|access_?key|auth_?key|encryption_?key|signing_?key", re.I | re.A), 0.6),
    (re.compile(r"token|bearer|credential", re.I | re.A), 0.5),
    (re.compile(r"(?:^|[_.-])(?:key|auth|salt|pin)$", re.I | re.A), 0.3),
)
NAME_HINTS = ("passw", "pwd", "passphrase", "secret", "key", "token", "bearer", "credential", "auth", "salt", "pin")
PLACEHOLDER = re.compile(r"^(?:change_?me|example|placeholder|your[_-]?\w+|x{4,}|\*{3,}|none|null|true|false|todo)$|^[$<{%]", re.I | re.A)
THRESHOLD = 0.7
LEAST = 6  # code points of a literal
HEAD = 64  # code points by which a placeholder is known
_TRIPLE = r'"""[^"\\]*+(?:(?:\\[\s\S]|"(?!""))[^"\\]*+)*+"""' + "|" + r"'''[^'\\]*+(?:(?:\\[\s\S]|'(?!''))[^'\\]*+)*+'''"
_STRING = rf"""{_TRIPLE}|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|`[^`\n]*+`"""
_BLOCK = r"[|>][+-]?+[\x20\t]*+\r?+(?:\n[\x20\t]++[^\n]*+)++"  # indented lines
LEX = re.compile(
    rf"""<(?P<tag>[A-Za-z_][\w.-]*+)>(?P<inner>[^<>]++)</(?P=tag)>|"""
    rf"""(?<![\w.-])(?P<q>["'`]?)(?P<name>[A-Za-z_][\w.-]*+)(?P=q)[\x20\t]*+(?P<op>:=|=>|:(?!:)|=(?!=))[\x20\t]*+"""
    rf"""(?:(?P<block>{_BLOCK})|(?P<value>(?:{_STRING}|[A-Za-z_][\w.-]*+(?![\w.+/=-])|[^\s"'`,;(){{}}\[\]<>]++)(?:[\x20\t]*+\+[\x20\t]*+(?:{_STRING}|[A-Za-z_][\w.-]*+))*+))""",
    re.A,
)
OPERAND = re.compile(rf"{_STRING}|[^\s+\"'`]+(?:\+(?=[^\s\"'`])[^\s+\"'`]+)*", re.A)
PLAIN_NAME = re.compile(r"[A-Za-z_][\w.-]*\Z", re.A)
NAMING, HOLDING = ("key", "name", "id", "property"), ("value", "content", "default")  # attributes of one element
PEM = re.compile(r"\s*-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY-----")

Span = tuple[int, int]


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost matches that do not overlap, per kind; those that fail their length are dropped, without a retry."""
    out: dict[str, list[Span]] = {k: [] for k in BASE}
    if ":" in text or "=" in text:
        low = text.lower()
        if any(h in low for h in ASSIGN_HINTS):
            out["assign"] = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out["access"] = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out["hex"] = [m.span() for m in HEX.finditer(text)]
    return out


def name_weight(name: str) -> float:
    return max((w for p, w in SENSITIVE if p.search(name)), default=0.0)


class Value:
    """What a name holds: the places of its literals, and what the characters of all of them are, counted."""

    __slots__ = ("parts", "head", "size", "_counts", "taken")

    def __init__(self, text: str, parts: list[Span | Value]) -> None:
        self.parts, self.taken, self._counts = parts, False, None
        self.head, self.size = "", 0
        for p in parts:
            head, size = (p.head, p.size) if isinstance(p, Value) else (text[p[0] : min(p[1], p[0] + HEAD)], p[1] - p[0])
            if len(self.head) == self.size:
                self.head = (self.head + head)[:HEAD]
            self.size += size
        if len(parts) > 1:  # a sum of sums may be far longer than the text
            self._counts = Counter()
            for p in parts:
                self._counts.update(p.counts(text) if isinstance(p, Value) else Counter(text[p[0] : p[1]]))

    def counts(self, text: str) -> Counter:
        if self._counts is None:
            self._counts = Counter(text[slice(*self.parts[0])])
        return self._counts

    def spans(self) -> list[Span]:
        """Those places that were not asked for before."""
        out, open_ = [], [self]
        while open_:
            v = open_.pop()
            if not v.taken:
                v.taken = True
                out += [p for p in v.parts if not isinstance(p, Value)]
                open_ += [p for p in v.parts if isinstance(p, Value)]
        return out


def entropy(counts: Counter, size: int) -> float:
    return -sum(c / size * math.log2(c / size) for c in counts.values()) if size else 0.0


def _placeholder(head: str, counts: Counter, size: int) -> bool:
    if not PLACEHOLDER.search(head):
        return False
    if size == len(head) or head[0] in "$<{%":
        return True
    same = {"x": counts["x"] + counts["X"], "*": counts["*"]}.get(head[0].lower())  # a long one is a run of these,
    other = lambda c: sum(n for x, n in c.items() if not re.match(r"\w", x, re.A))  # noqa: E731  or "your" and a word
    return same == size if same is not None else other(counts) == other(Counter(head))


def weight_of(head: str, counts: Counter, size: int) -> float:
    """0 to 0.4, and negative for what is no secret. Only a private key in its usual form may hold white space."""
    if PEM.match(head):
        return 0.4
    if size < LEAST or _placeholder(head, counts, size) or any(c.isspace() for c in counts):
        return -1.0
    kinds = sum(any(f(c) for c in counts) for f in (str.isdigit, str.isupper, str.islower)) + any(not c.isalnum() for c in counts)
    return min(0.4, 0.1 * (kinds - 1) + 0.1 * (entropy(counts, size) >= 3.0) + 0.1 * (size >= 16))


def literal_weight(value: str) -> float:
    return weight_of(value[:HEAD], Counter(value), len(value))


def lexed_spans(text: str) -> list[Span]:
    """Literals that reach a sensitive name and look like a secret: the places of their content."""
    if not (":" in text or "=" in text or "</" in text):
        return []
    low = text.lower()
    if not any(h in low for h in NAME_HINTS):
        return []
    constants: dict[str, Value] = {}
    first: dict[str, Value] = {}
    open_: list[tuple[str, list]] = []  # assignments with names that have no constant yet
    found: set[Span] = set()

    def assigned(name: str, parts: list[Span | Value]) -> None:
        value = parts[0] if len(parts) == 1 and isinstance(parts[0], Value) else Value(text, parts)
        constants[name] = value
        first.setdefault(name, value)
        if (weight := name_weight(name)) and weight + weight_of(value.head, value.counts(text), value.size) >= THRESHOLD:
            found.update(s for s in value.spans() if s[1] > s[0])

    attribute: tuple[str, Span, int] | None = None  # the attribute just before: its name, content and end
    for m in LEX.finditer(text):
        if m["tag"]:
            a, z = m.span("inner")
            assigned(m["tag"], [(a + len(m["inner"]) - len(m["inner"].lstrip()), z - len(m["inner"]) + len(m["inner"].rstrip()))])
            continue
        if m["block"]:
            a, z = m.span("block")
            a = text.index("\n", a, z) + 1
            assigned(m["name"], [(a + len(text[a:z]) - len(text[a:z].lstrip()), z)])
            continue
        parts: list = []
        opaque = False
        for part in OPERAND.finditer(text, *m.span("value")):
            at, got = part.start(), part[0]
            if got[0] in "\"'`" and len(got) > 1:
                quote = 3 if len(got) >= 6 and got[:3] in ('"""', "'''") else 1
                parts.append((at + quote, at + len(got) - quote))
            elif PLAIN_NAME.match(got):
                parts.append(constants.get(got, got))
            elif m["op"] in (":", "="):
                parts.append((at, at + len(got)))
            else:
                opaque = True
        name, before = m["name"], attribute
        literal = len(parts) == 1 and isinstance(parts[0], tuple)
        attribute = (name.lower(), parts[0], m.end()) if literal and m["op"] == "=" else None
        if attribute and before and not text[before[2] : m.start()].strip():
            pair = {before[0]: before[1], attribute[0]: attribute[1]}
            named, held = (next((pair[k] for k in kinds if k in pair), None) for kinds in (NAMING, HOLDING))
            if named and held:
                assigned(text[slice(*named)].strip(), [held])
        if not parts or opaque:
            constants.pop(name, None)
        elif any(isinstance(p, str) for p in parts):
            constants.pop(name, None)
            open_.append((name, parts))
        else:
            assigned(name, parts)
    _settle(open_, first, assigned)
    return sorted(found)


def _settle(open_: list[tuple[str, list]], first: dict[str, Value], assigned) -> None:
    """Assignments of names that got their constant only later, each as soon as all its names have one; circles stay open."""
    waiting: dict[str, list[int]] = {}
    missing = [{p for p in parts if isinstance(p, str)} for _, parts in open_]
    for i, names in enumerate(missing):
        for n in names:
            waiting.setdefault(n, []).append(i)
    ready = [n for n in waiting if n in first]
    while ready:
        n = ready.pop()
        for i in waiting.pop(n, ()):
            missing[i].discard(n)
            if not missing[i]:
                name, parts = open_[i]
                known = name in first
                assigned(name, [first[p] if isinstance(p, str) else p for p in parts])
                if not known and name in waiting:
                    ready.append(name)


def scan(text: str) -> tuple[dict[str, list[Span]], list[Span]]:
    base = base_spans(text)
    covered, more, at, upto = sorted(s for k in BASE for s in base[k]), [], 0, 0
    for s in lexed_spans(text):
        while at < len(covered) and covered[at][0] <= s[0]:
            upto = max(upto, covered[at][1])
            at += 1
        if s[1] > upto:
            more.append(s)
    return base, more


def _joined(spans: list[tuple[int, int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(spans))


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows: doc_id, n_assign, n_access, n_hex, base_spans, spans (kind:start:end by start, then kind as listed).

    A null or empty text has no spans; offsets are code points, ends exclusive. Repeated rows get equal results.
    Other columns are not looked at.
    """
    workers_can_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, 8 << 20):
            counts: list[list[int]] = [[], [], []]
            based, alls = [], []
            for t in texts_of(batch.column(1)):
                base, more = scan(t)
                rows = [(a, i, k, z) for i, k in enumerate(BASE) for a, z in base[k]]
                for c, k in zip(counts, BASE, strict=True):
                    c.append(len(base[k]))
                based.append(_joined(rows))
                alls.append(_joined(rows + [(a, len(BASE), "literal", z) for a, z in more]) if more else based[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(based, pa.string()), pa.array(alls, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")


def redact(text: str | None, mark: str = "<secret>") -> str | None:
    """The text with every found span replaced."""
    if text is None:
        return None
    base, more = scan(text)
    out, at = [], 0
    for a, z in sorted([s for k in BASE for s in base[k]] + more):
        if z <= at:
            continue
        out += [text[at:a] if a > at else "", mark if a >= at else ""]
        at = z
    return "".join(out) + text[at:]


def op6_secrets(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def brute(text: str | None) -> tuple[int, int, int, str]:
    """Counts and base_sha256 straight from the definitions; for tests."""
    t = text or ""
    rows = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    rows += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 16]
    rows += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return (*[sum(r[1] == i for r in rows) for i in range(3)], hashlib.sha256(_joined(rows).encode()).hexdigest())
