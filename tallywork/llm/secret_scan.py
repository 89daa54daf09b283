"""Secret scans: patterns, and literals that source or configuration text assigns to sensitive names.

Assignments are lexed into name-literal pairs. A name that stands on the right side stands for what it was given
earlier in the same text (constants propagate), and each literal is scored by the most sensitive name it ends up
in. References point backwards only, so one walk over the assignments from the last to the first finds these names,
however often constants are joined.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


class Span(NamedTuple):
    """Code points [start, end); ``value`` is where the secret itself starts."""

    kind: str
    start: int
    end: int
    value: int


# The base kinds, in the order in which equal starts are listed, then the method's own.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones can be passed over
MIN_VALUE, MIN_ACCESS = 6, 20

# Parts of names that mark a target as sensitive, with their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "privatekey": 1.0, "accesskey": 1.0, "auth": 0.7, "bearer": 0.8,
    "signingkey": 1.0, "encryptionkey": 1.0, "connectionstring": 0.8, "pass": 0.7, "pin": 0.5, "key": 0.4,
}
HARMLESS = {"public", "length", "size", "count", "max", "min", "type", "name", "url", "path", "file", "id", "ttl"}
PHRASES = {"password", "passwd", "pwd", "passphrase"}  # targets whose literal may be several words
PLACEHOLDERS = {"true", "false", "null", "none", "nil", "undefined", "changeme", "example", "placeholder", "redacted"}
THRESHOLD = 0.5

_NAME_END = re.compile(r"""([A-Za-z_$][\w$.\-]*)["'\]]{0,2}[ \t]*\Z""")
# name: type = literal (the type may have parameters), and name type = literal after a word that declares
_TYPE = r"""[A-Za-z_$&*][\w$.&*?|\[\] ]*(?:<[^<>=\n]*>)?[\w$.&*?|\[\] ]*"""
_TYPED = re.compile(rf"""([A-Za-z_$][\w$]*)[?!]?[ \t]*:[ \t]*{_TYPE}\Z""")
_DECLARED = re.compile(r"""\b(?:var|const|let|val)[ \t]+([A-Za-z_$][\w$]*)[ \t]+[A-Za-z_$*][\w$.*\[\]]*[ \t]*\Z""")
_TERM = re.compile(
    r"""[ \t]*(?:(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*)(?P=quote)"""
    r"""|\$?\{?(?P<bare>[^\s"'`,;#(){}\[\]<>]+)\}?)"""
)
# a value on the line below its name, and nothing else on that line
_BELOW = re.compile(r"""[ \t]*(?:[|>][+-]?|\\)?[ \t]*\r?\n[ \t]+(?=(?:"[^"\n]*"|'[^'\n]*'|[^\s"'`:=,;#(){}\[\]<>]+)[ \t]*[,;]?[ \t]*(?:\r?\n|\Z))""")
_PLUS = re.compile(r"[ \t]*\+")
# a tag whose attributes are a name and its value, and an element with its text
_ATTRIBUTES = re.compile(
    r"""<[^<>]{0,200}?\b(?:key|name|id)[ \t]*=[ \t]*["']([^"'<>\n]{1,100})["'][^<>]{0,300}?\bvalue[ \t]*=[ \t]*(?:"([^"<>\n]*)"|'([^'<>\n]*)')"""
)
_ELEMENT = re.compile(r"""<([A-Za-z_][\w.\-]{0,80})(?:[ \t][^<>]{0,200})?>[ \t]*([^<>\s](?:[^<>\n]{0,400}[^<>\s])?)[ \t]*</\1>""")
_TYPE_END = re.compile(r"""(?:<[^<>=\n]*>|\[\])*[ \t]*=[ \t]*["'`]""")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_LOOK_BACK = 200


def name_weight(name: str) -> float:
    """How sensitive a target is, from the words in its name (camelCase, snake_case, dotted, dashed)."""
    words = [w.lower() for w in _WORD.findall(name)]
    if not words or words[-1] in HARMLESS or "public" in words:
        return 0.0
    pairs = [a + b for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words + pairs + ["".join(words)]), default=0.0)


def literal_weight(text: str, phrase: bool = False) -> float:
    """How much a literal looks like a secret: no placeholder, no prose, not too uniform.

    ``phrase`` says that a few words without the end of a sentence may be one, if there is a digit among them.
    """
    low = text.lower()
    if len(text) < MIN_VALUE or low in PLACEHOLDERS or len(set(low)) < 4:
        return 0.0
    if any(c.isspace() for c in text):
        fits = phrase and len(text.split()) <= 8 and any(c.isdigit() for c in text) and text.rstrip()[-1] not in ".!?:"
        return 0.7 if fits else 0.0
    bits = -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())
    mixed = any(c.isdigit() for c in text) or bits >= 3.5
    return min(1.0, bits / 3.0) if mixed else 0.4 * min(1.0, bits / 3.0)


class Assignment(NamedTuple):
    """A target with the literals given to it as spans, and the earlier assignments (numbers) whose values it takes."""

    name: str
    literals: list[tuple[int, int]]
    taken: list[int]


def flows(text: str) -> list[Assignment]:
    """All assignments of source or configuration text, in order."""
    out: list[Assignment] = []
    known: dict[str, int] = {}
    at = 0
    for mark in re.finditer(r":=|=>|[:=]", text):
        if mark.start() < at or text[mark.end() : mark.end() + 1] == "=":
            continue
        if mark.start() and text[mark.start() - 1] in "=!<>:":
            continue
        before = text[max(mark.start() - _LOOK_BACK, 0) : mark.start()].rpartition("\n")[2]
        name = _NAME_END.search(before)
        if mark[0] == "=":  # the declared name, not its type
            name = _TYPED.search(before) or _DECLARED.search(before) or name
        if not name:
            continue
        literals: list[tuple[int, int]] = []
        taken: dict[int, None] = {}
        end = mark.end()
        below = _BELOW.match(text, end)
        if below:
            end = below.end()
        while term := _TERM.match(text, end):
            if term["quote"]:
                if term.start("text") < term.end("text"):
                    literals.append(term.span("text"))
            elif term["bare"] in known:
                taken[known[term["bare"]]] = None
            elif name := name if not term["bare"].startswith("//") else None:
                literals.append(term.span("bare"))
            end = term.end()
            plus = _PLUS.match(text, end)
            if not plus or not term["quote"] and term["bare"] not in known:
                break
            end = plus.end()
        if name and (literals or taken):
            known[name[1]] = len(out)
            out.append(Assignment(name[1], literals, list(taken)))
            if text[mark.end() : end].lstrip()[:1] in ("'", '"', "`"):
                at = end
    if "</" in text or "/>" in text:
        for found in _ATTRIBUTES.finditer(text):
            out.append(Assignment(found[1], [found.span(2 if found[2] is not None else 3)], []))
        out += [Assignment(found[1], [found.span(2)], []) for found in _ELEMENT.finditer(text)]
    return out


def assignments(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """(target name, distinct literals as spans) in order, constants replaced by what they were given."""
    nodes = flows(text)
    for i, node in enumerate(nodes):
        parts, seen, todo = dict.fromkeys(node.literals), {i}, list(node.taken)
        while todo:
            j = todo.pop()
            if j not in seen:
                seen.add(j)
                parts.update(dict.fromkeys(nodes[j].literals))
                todo += nodes[j].taken
        yield node.name, list(parts)


def _is_phrase(name: str) -> bool:
    return any(w.lower() in PHRASES for w in _WORD.findall(name))


def literal_scores(text: str) -> dict[tuple[int, int], float]:
    """Score of each literal: its own weight times that of the most sensitive name that it reaches."""
    nodes = flows(text)
    weight = [name_weight(n.name) for n in nodes]
    phrase = [w > 0 and _is_phrase(n.name) for n, w in zip(nodes, weight)]
    scores: dict[tuple[int, int], float] = {}
    for i in reversed(range(len(nodes))):  # whatever takes a value comes after it
        for j in nodes[i].taken:
            weight[j], phrase[j] = max(weight[j], weight[i]), phrase[j] or phrase[i]
        if weight[i] > 0:
            for part in nodes[i].literals:
                score = weight[i] * literal_weight(text[slice(*part)], phrase[i])
                scores[part] = max(scores.get(part, 0.0), score)
    return scores


def scan(text: str | None) -> list[Span]:
    """All spans of a text, by start and then kind. NULL and empty texts have none."""
    if not text:
        return []
    found = []
    low = text.lower() if ":" in text or "=" in text or "</" in text else ""
    if any(w in low for w in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_VALUE:
                found.append(Span("assign", m.start(), m.end(), m.start(2)))
    if "AKIA" in text:
        found += [Span("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [Span("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    if low:
        found += [Span("literal", a, b, a) for (a, b), score in literal_scores(text).items() if score >= THRESHOLD]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str | None, mask: str = "[REDACTED]") -> str | None:
    """The text with every secret value replaced; overlapping spans are merged."""
    # letters before = and a quote are the type of a declaration, whose literal has a span of its own
    spans = sorted(
        (s.value, s.end) for s in scan(text)
        if not (s.kind == "assign" and ":" in text[s.start : s.value] and text[s.value : s.end].isalpha() and _TYPE_END.match(text, s.end))
    )
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][1])
        out += [text[at:start], mask]
        at, i = end, i + 1
    return text if not spans else "".join(out) + text[at:]


def spans_of(text: Column) -> Column:
    """array<struct<kind, start, end, value>> of a text column; empty for NULL."""

    @F.pandas_udf('array<struct<kind:string,start:bigint,`end`:bigint,value:bigint>>')
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([[s._asdict() for s in scan(t)] for t in batch], dtype=object)

    return run(text)


def redacted(text: Column) -> Column:
    """The text with secrets masked; NULL stays NULL."""

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(redact, na_action="ignore")

    return run(text)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans per input row; rows are independent and texts are scanned whole."""

    def told(spans: list[Span]) -> str:
        return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)

    @F.pandas_udf(
        "n_assign bigint, n_access bigint, n_hex bigint, n_literal bigint, base_sha256 string, spans string"
    )
    def run(batch: pd.Series) -> pd.DataFrame:
        rows = []
        for text in batch:
            spans = scan(text)
            many = Counter(s.kind for s in spans)
            base = told([s for s in spans if s.kind in KINDS[:3]])
            rows.append((*(many[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), told(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"])

    made = docs.select(F.col(f"`{id_col}`"), run(F.col(f"`{text_col}`")).alias("__made"))
    return made.select(f"`{id_col}`", "__made.*")


def mask_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The table with secrets masked in its text and the character count brought up to date."""
    made = docs.withColumn(text_col, redacted(F.col(f"`{text_col}`")))
    if chars_col and chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        made = made.withColumn(chars_col, F.char_length(F.col(f"`{text_col}`")).cast(kind))
    return made.select(*(F.col(f"`{c}`") for c in docs.columns))
