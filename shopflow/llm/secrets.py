"""Secret scans: fixed patterns plus an assignment-aware reading of names and literals.

The reader finds every assignment operator, takes the name before it and the literal after
it (``name = "x"``, ``"name": "x"``, ``NAME=x``, ``name := "x" + "y"``, strings of three
quotes and with prefixes, lines below a YAML ``name: |``) and the text of XML elements
(``<name>x</name>``), follows names that
were given a literal earlier in the text, and scores the literal by how sensitive the name
it ends up in sounds and by how random it looks. Spans are in code points, end exclusive.
"""

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.llm import arrow

# The base patterns and the kinds in their order.
KINDS = ["assign", "access", "hex", "lexed"]
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run is one match, so short runs need not be matched

# Parts of names that tell of a secret, and literals that stand for none.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.8, "credentials": 0.8, "bearer": 0.8,
    "auth": 0.6, "signature": 0.5,
}
SENSITIVE_BEFORE_KEY = {"api", "access", "private", "secret", "signing", "encryption", "master"}
PLACEHOLDERS = {
    "changeme", "example", "placeholder", "password", "secret", "token", "undefined",
    "required", "optional", "disabled", "enabled", "default", "redacted", "yourpassword",
}
THRESHOLD = 0.5
SHORTEST = 8
LONGEST_PLACEHOLDER = max(map(len, PLACEHOLDERS))

_OPERATOR = re.compile(r":=|=>|(?<![=!<>:+*/-])=(?!=)|(?<!:):(?![:/=])")
_NAME_BACK = re.compile(r"""[ \t]*["']?([A-Za-z0-9_.\-]*)""")  # of the reversed text
# A literal in quotes, with a prefix as in f"..", of three quotes, or bare (the last group).
_VALUE = re.compile(
    r"""[ \t]*(?:[A-Za-z]{0,2}(?:"(?!"")((?:[^"\\\n]|\\.)*)"|'(?!'')((?:[^'\\\n]|\\.)*)'"""
    r'|"{3}((?s:.*?))"{3}' r"|'{3}((?s:.*?))'{3})"
    r"""|([^\s"'`,;(){}\[\]<>#+]+))""")
# A YAML block: the rest of the line after "|" or ">", and the deeper lines below.
_BLOCK = re.compile(r"[ \t]*[|>][+-]?[0-9]?[ \t]*(?:#[^\n]*)?\n")
_ELEMENT = re.compile(r"<([A-Za-z_][A-Za-z0-9_.\-]*)(?:\s[^<>]*)?>([^<>]+)</\1\s*>")
_BARE = 5  # the group of _VALUE that needs no quotes
_PLUS = re.compile(r"[ \t]*\+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*\Z")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list:
    """(start, kind number, end) of the fixed patterns."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


class _Value:
    """A literal, or two values joined, of any length: what a score needs and where it came from.

    Joined values refer to their parts, so a constant that is doubled again and again stays
    small. ``blanks`` tells of white space (before, after, within) the stripped value, which
    has ``n`` characters, begins with ``head`` and holds ``counts``.
    """

    __slots__ = ("span", "parts", "blanks", "n", "head", "counts")

    def __init__(self, text: str, span: tuple = None):
        bare = text.strip()
        self.span, self.parts = span, ()
        self.blanks = (text[:1].isspace(), text[-1:].isspace(), bool(re.search(r"\s", bare)))
        self.n, self.head, self.counts = len(bare), bare[:LONGEST_PLACEHOLDER + 1], Counter(bare)

    @classmethod
    def joined(cls, a, b):
        both = cls.__new__(cls)
        both.span, both.parts = None, (a, b)
        before = a.blanks[0] or (not a.n and b.blanks[0])
        after = b.blanks[1] or (not b.n and a.blanks[1])
        between = bool(a.n and b.n) and (a.blanks[1] or b.blanks[0])
        both.blanks = (before, after, a.blanks[2] or b.blanks[2] or between)
        both.n = a.n + b.n
        both.head = (a.head + b.head)[:LONGEST_PLACEHOLDER + 1]
        both.counts = a.counts.copy()
        both.counts.update(b.counts)
        return both

    def spans(self, seen: set):
        """Yield (start, end) of the literals; values in ``seen`` were asked before."""
        open_values = [self]
        while open_values:
            value = open_values.pop()
            if id(value) not in seen:
                seen.add(id(value))
                open_values += value.parts
                if value.span:
                    yield value.span


def _name_before(text: str, low: int, high: int) -> str:
    """The name that ends at ``high`` but for a quote and blanks; '' without one."""
    low = max(low, text.rfind("\n", low, high) + 1)
    back = _NAME_BACK.match(text[low:high][::-1])
    return back[1][::-1].lstrip("0123456789.-")


def _block_value(text: str, key: int, low: int):
    """The lines from ``low`` on that are deeper than the line of the key; None without any."""
    line = text.rfind("\n", 0, key) + 1
    depth = len(text[line:key]) - len(text[line:key].lstrip(" \t-"))
    end = first = None
    while low < len(text):
        stop = text.find("\n", low)
        stop = len(text) if stop < 0 else stop
        bare = text[low:stop].strip()
        if bare:
            if stop - low - len(text[low:stop].lstrip(" \t")) <= depth:
                break
            if first is None:
                first = stop - len(text[low:stop].lstrip())
            end = low + len(text[low:stop].rstrip())
        low = stop + 1
    return _Value(text[first:end], (first, end)) if end is not None else None


def elements(text: str):
    """Yield (name, value) of XML elements that hold plain text only."""
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            yield m[1], _Value(m[2], m.span(2))


def assignments(text: str):
    """Yield (name, value) in text order, constants followed.

    A bare word that was assigned before stands for that literal; a name stands for the
    value it had last. ``a`` and ``obj.a`` are different names. Neither a name nor the
    literals of a value are limited in number or length.
    """
    known, tails, last = {}, {}, 0
    for op in _OPERATOR.finditer(text):
        name, last = _name_before(text, last, op.start()), op.end()
        if not name:
            continue
        if op[0] == ":" and (block := _BLOCK.match(text, op.end())):
            value = _block_value(text, op.start(), block.end())
            if value:
                known[name] = value
                yield name, value
            continue
        at, starts, values, fixed = op.end(), [], [], True
        while m := _VALUE.match(text, at):
            if at in tails:  # read before, by an operator within an earlier literal
                values.append(tails[at])
                starts.append(at)
                break
            group = m.lastindex
            starts.append(at)
            if group == _BARE and _NAME.match(m[_BARE]):
                fixed = False
            values.append(known[m[_BARE]] if group == _BARE and m[_BARE] in known
                          else _Value(m[group], (m.start(group), m.end(group))))
            at = m.end()
            plus = _PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if values:
            value = values[-1]
            for start, part in zip(starts[-2::-1], values[-2::-1]):
                if fixed:
                    tails[start] = value = _Value.joined(part, value)
                else:
                    value = _Value.joined(part, value)
            known[name] = value
            yield name, value


def sensitivity(name: str) -> float:
    """0 to 1, from the words of a name in snake, kebab, dotted or camel case."""
    parts = [w.lower() for w in _WORD.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in parts), default=0.0)
    for a, b in zip(parts, parts[1:]):
        if b in ("key", "keys") and a in SENSITIVE_BEFORE_KEY:
            best = 1.0
    return best


def randomness(value: _Value) -> float:
    """0 to 1: length, character classes and entropy of a literal; 0 for placeholders."""
    n, counts = value.n, value.counts
    if n < SHORTEST or value.blanks[2] or value.head.lower() in PLACEHOLDERS:
        return 0.0
    if value.head[0] in "$<{%" or len(counts) < 5:
        return 0.0
    letters = "".join(counts)
    classes = sum(bool(re.search(p, letters)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    return min(1.0, entropy / 3.5) * (0.4, 0.8, 1.0, 1.0)[classes - 1]


def lexed_spans(text: str, taken: list, threshold: float = THRESHOLD) -> list:
    """(start, kind number, end) of literals in sensitive names, but for those in ``taken``."""
    if ":" not in text and "=" not in text and "</" not in text:
        return []
    found, seen, kept = set(), set(), []
    for name, value in chain(assignments(text), elements(text)):
        sensitive = sensitivity(name)
        if sensitive and sensitive * randomness(value) >= threshold:
            kept.append(value)  # so that its id stays its own
            found.update(value.spans(seen))
    # What the base kinds cover, as parts that do not touch, in order.
    starts, ends = [], []
    for s, _, e in sorted(taken):
        if starts and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)

    def covered(s, e):
        k = bisect_left(ends, s + 1)  # the first part that ends behind s
        return k < len(starts) and starts[k] < e

    return [(s, 3, e) for s, e in found if e > s and not covered(s, e)]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """``id_col`` and ``spans``: array of (kind, start, end), ordered by start, then kind.

    One row per row of ``docs``, repeated rows and null ids included; a null or empty text
    has no spans; other columns are ignored. Whole texts are read.
    """
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = frame.schema["id"].dataType.simpleString()

    def spans_of(text):
        if not text:
            return []
        base = base_spans(text)
        found = sorted(base + lexed_spans(text, base, threshold))
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                spans = [spans_of(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(spans, _SPANS)], names=["id", "spans"])

    schema = f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return frame.mapInArrow(arrow.tidy(run), schema).withColumnRenamed("id", id_col)


def summary(docs: DataFrame) -> DataFrame:
    """Counts per base kind, digest of the base spans and all spans as text, per document."""
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "lexed")
    return scan(docs).select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
