"""Secrets in texts: fixed patterns, and literals assigned to sensitive names.

Base kinds are found by pattern, leftmost and non-overlapping per kind: `assign` (a password-like word,
`:` or `=`, a value of 6 characters or more), `access` (AKIA keys of 20 or more) and `hex` (24 or more
lower-case hexadecimal digits). A match that is too short is dropped with what it covered.

The lexer adds the kind `literal`. At each assignment operator (=, :, :=, =>) it reads the name before
it, plain, quoted or with a type between, and the value after it: quoted literals, also triple-quoted ones, names,
and chains of these joined by +, after which the line may end, or standing side by side, within parentheses or
after a backslash also over lines; the last of the quoted arguments of a call, its default; the lines of a block
that YAML puts below its name; or what ends the line without quotes. Elements of XML and options of a command
line (`--name value`) have names and values, too. Names stand for what was last assigned to them before, or else
for their last value, so a literal counts for each name it reaches through
constants. The literals of a value count each and, all of them, as what they are joined to, for which an
unquoted value within another one does not count. A literal is reported when the sensitivity of the
name's words, plural ones less, times the plausibility of the literal reaches `threshold`, unless a base span or
another literal covers it. Spaces make a literal less plausible, but not a quoted one of a name that is a secret for
certain. Masking takes a quoted literal in which an assigned base value begins to its end.

Texts of any length are read whole. Each literal is looked at once, for the most sensitive name that it reaches, and
joined literals by counts of their characters, so the time grows with a text's length, whatever stands in it.

Offsets are code points, ends exclusive. Nulls count as empty texts, which have no spans. Every row
gives one row, repeated ones too; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleward.llm.batches import map_rows, texts

KINDS = ["assign", "access", "hex", "literal"]
MASK = "[SECRET]"

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
# Runs are matched whole, so a least length in the pattern drops the same matches as one afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

OPERATOR = re.compile(r":=|=>|=(?!=)|:(?!:)")
# For the text backwards, from the operator on.
NAME_BEFORE = re.compile(
    r"[ \t]*+(?:[\w.\[\]|]*[A-Za-z_][ \t]*+:[ \t]*+)?([\"'`]?)([\w$.-]*[A-Za-z_$])\1", re.ASCII
)
STRING = (
    r"[rbfu]{0,2}(?:\"\"\"((?:[^\"\\]|\\.|\"(?!\"\"))+)\"\"\"|'''((?:[^'\\]|\\.|'(?!''))+)'''"
    r"|\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)"
)
TERM = re.compile(rf"[ \t]*(?:\+\s*|\\\n\s*)?(?:{STRING}|([A-Za-z_$][\w$.]*+)(?![\w(\[]))", re.ASCII)
NAME_GROUP = 6
OPENING, WITHIN = re.compile(r"[ \t]*\((?=\s*[rbfu]{0,2}[\"'])"), re.compile(rf"\s*(?:\+\s*)?{STRING}", re.ASCII)
CALL, ARGUMENT = re.compile(r"[ \t]*[A-Za-z_$][\w$.]*\(", re.ASCII), re.compile(rf"\s*{STRING}\s*([,)])", re.ASCII)
BLOCK = re.compile(r"[ \t]*[|>][+-]?[ \t]*\n((?:[ \t]+\S[^\n]*(?:\n|\Z))+)")
LINE = re.compile(r"[ \t]*(\S(?:[^\n]*\S)?)[ \t\r]*(?:\n|\Z)")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)(?:\s[^<>]*)?>([^<>\n]+)</\1\s*>", re.ASCII)
OPTION = re.compile(r"(?<![\w-])--([A-Za-z][\w-]*)[ \t]+(?:\"([^\"\\\n]*)\"|'([^'\\\n]*)'|([^\s\"'`=-][^\s\"'`]*))", re.ASCII)
BLANKS = re.compile(r"[ \t]*")
# Values without quotes that end their line, as configuration files have.
BARE, LINE_END = re.compile(r"[^\s\"'`,;(){}\[\]<>]+"), re.compile(r"[ \t]+[#;]|[;,]?[ \t]*$", re.MULTILINE)
QUOTED = re.compile(r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`")
NAME = re.compile(r"[A-Za-z_$][\w$.]*", re.ASCII)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "pass": 0.7, "secret": 1.0,
    "token": 0.8, "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "auth": 0.6, "bearer": 0.8,
    "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.5, "signing": 0.5, "encryption": 0.5,
    "client": 0.1, "dsn": 0.6, "pin": 0.5, "salt": 0.5,
}
# Words of names that hold something about a secret, not the secret.
HARMLESS = {
    "length", "len", "count", "size", "min", "max", "url", "uri", "path", "file", "name", "type",
    "field", "label", "policy", "hint", "prompt", "placeholder", "example", "expiry", "expires",
    "header", "format", "regex", "pattern", "error", "message",
}
PLACEHOLDER = re.compile(r"(?i)change_?me|your[_ -]|example|placeholder|dummy|redacted|\{\{|%\(")
PLACEHOLDER_WHOLE = re.compile(r"(?i)\$.*|<.*>|none|null|true|false|undefined")
PLURAL, CLOSE = 0.8, 1e-9


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    secret_start: int
    secret_end: int


class Literal(NamedTuple):
    start: int
    end: int
    quoted: bool
    nested: bool = False  # an unquoted value within another one


def base_spans(text: str) -> list[Span]:
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            found.append(Span("assign", *m.span(), *m.span(2)))
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [Span(kind, *m.span(), *m.span()) for m in pattern.finditer(text)]
    return found


def word_score(word: str) -> float:
    if word in SENSITIVE:
        return SENSITIVE[word]
    return PLURAL * SENSITIVE.get(word.removesuffix("s"), 0.0)


def name_score(name: str) -> float:
    """How sensitive a name is by its words, from 0 to 1."""
    words = [w.lower() for w in WORDS.findall(name)]
    if HARMLESS.intersection(words):
        return 0.0
    return min(1.0, sum(map(word_score, set(words))))


class Facts(NamedTuple):
    """What tells how plausible a text is as a secret, of one literal or of several joined ones."""

    counts: dict[str, int]
    size: int
    kinds: int  # bits: lower case, upper case, digits, other signs, spaces, line ends
    known: bool  # a placeholder somewhere
    head: str
    tail: str
    parts: int
    quoted: bool


LOWER, UPPER, DIGIT, SIGN, SPACE, BREAK = (1 << i for i in range(6))
# No placeholder is longer; signs beyond ASCII are counted together, in so many classes.
WINDOW, CLASSES = 16, 64


@lru_cache(maxsize=1 << 16)
def kind_of(c: str) -> int:
    if c == "\n":
        return BREAK
    if c == " ":
        return SPACE
    kinds = LOWER * c.islower() | UPPER * c.isupper() | DIGIT * c.isdigit()
    return kinds | SIGN * (not c.isalnum() and not c.isspace())


def facts(text: str, quoted: bool) -> Facts:
    counts, kinds = Counter(text), 0
    for c in counts:
        kinds |= kind_of(c)
    return Facts(counts, len(text), kinds, bool(PLACEHOLDER.search(text)), text[:WINDOW], text[-WINDOW:], 1, quoted)


def joined_facts(parts: list[Facts]) -> Facts:
    if len(parts) == 1:
        return parts[0]
    counts: dict[str, int] = {}
    size, kinds, known, head, tail, n, quoted = 0, 0, False, "", "", 0, True
    for part in parts:
        for c, k in part.counts.items():
            c = c if c < "\x80" else chr(128 + ord(c) % CLASSES)
            counts[c] = counts.get(c, 0) + k
        known = known or part.known or bool(PLACEHOLDER.search(tail + part.head))
        head = head if size >= WINDOW else (head + part.head)[:WINDOW]
        tail = part.tail if part.size >= WINDOW else (tail + part.tail)[-WINDOW:]
        size, kinds, n, quoted = size + part.size, kinds | part.kinds, n + part.parts, quoted and part.quoted
    if size > 1 << 64:  # a value joined to itself over and over; its shares stay
        counts = {c: max(1, k >> 32) for c, k in counts.items()}
        size = sum(counts.values())
    return Facts(counts, size, kinds, known, head, tail, n, quoted)


def plausible(size: int, entropy: float, kinds: int, phrase: bool) -> float:
    """By length, character kinds and entropy, from 0 to 1; spaces are well in a phrase."""
    if size < 6 or kinds & BREAK or entropy <= 1.5:
        return 0.0
    score = min(1.0, 0.25 + 0.15 * (kinds & (LOWER | UPPER | DIGIT | SIGN)).bit_count() + 0.1 * min(entropy, 4.0))
    return score * (0.5 if kinds & SPACE and not phrase else 1.0)


def literal_score(text: str, phrase: bool = False) -> float:
    """How plausible a literal is as a secret."""
    return facts_score(facts(text, True), phrase)


def facts_score(known: Facts, phrase: bool) -> float:
    if known.known or (known.size <= WINDOW and PLACEHOLDER_WHOLE.fullmatch(known.head)):
        return 0.0
    if known.head[:1] == "$" or (known.head[:1] == "<" and known.tail[-1:] == ">"):
        return 0.0
    entropy = -sum(n / known.size * math.log2(n / known.size) for n in known.counts.values()) if known.size else 0.0
    return plausible(known.size, entropy, known.kinds, phrase)


def suffix_scores(text: str, start: int, end: int, wanted: set[int]) -> dict[int, float]:
    """The scores of the unquoted values that begin at wanted places and end where the text does, in one pass from there."""
    counts: dict[str, int] = {}
    sums, kinds, scores, at = 0.0, 0, {}, end
    found = [m.start() for m in PLACEHOLDER.finditer(text, start, end)]
    last = found[-1] if found else -1
    while at > start:
        at -= 1
        c = text[at]
        n = counts[c] = counts.get(c, 0) + 1
        sums += n * math.log2(n) - ((n - 1) * math.log2(n - 1) if n > 1 else 0.0)
        kinds |= kind_of(c)
        if at in wanted:
            size = end - at
            whole = size <= WINDOW and PLACEHOLDER_WHOLE.fullmatch(text[at:end])
            scores[at] = 0.0 if at <= last or whole or c == "$" else plausible(size, math.log2(size) - sums / size, kinds, False)
    return scores


class Values:
    """What the names of a text stand for: per assignment a list of literals, names and such lists."""

    def __init__(self, text: str):
        self.text = text
        self.values: dict[str, list] = {}
        self.targets: list[tuple[float, list]] = []
        self.runs: tuple[list[int], list[int]] | None = None
        self.closed: dict[int, bool] = {}
        self.bare: dict[int, list[int]] = {}  # per end of a run, where unquoted values begin
        self.read()

    def read(self) -> None:
        text, backwards, below = self.text, "", 0
        found = [(m.start(), m) for m in OPERATOR.finditer(text)]
        for pattern, marker in ((ELEMENT, "</"), (OPTION, "--")):
            if marker in text:
                found += [(m.start(), m) for m in pattern.finditer(text)]
        for _, m in sorted(found, key=itemgetter(0)):
            if m.re is not OPERATOR:
                self.assign(m[1], [Literal(*m.span(m.lastindex), m.re is ELEMENT or m.lastindex < 4)])
                continue
            backwards = backwards or text[::-1]
            if not (name := NAME_BEFORE.match(backwards, len(text) - m.start())):
                continue
            if m.end() >= below and (block := BLOCK.match(text, m.end())):
                below = block.end()
                terms = [Literal(*line.span(1), False) for line in LINE.finditer(text, *block.span(1))]
            else:
                terms = self.value_after(m.end())
            if terms:
                self.assign(name[2][::-1], terms)

    def assign(self, name: str, terms: list) -> None:
        # A name stands for what was last assigned to it before this place.
        value = [self.values.get(t, t) if isinstance(t, str) else t for t in terms]
        self.values[name] = value
        if score := name_score(name):
            self.targets.append((score, value))

    def value_after(self, at: int) -> list[Literal | str]:
        """Literals and names of the value that begins at a place."""
        text, terms, begin = self.text, [], at
        if opening := OPENING.match(text, at):
            at = opening.end()
            while m := WITHIN.match(text, at):
                terms.append(Literal(*m.span(m.lastindex), True))
                at = m.end()
            return terms
        while m := TERM.match(text, at):
            at = m.end()
            terms.append(m[NAME_GROUP] if m.lastindex == NAME_GROUP else Literal(*m.span(m.lastindex), True))
        if not terms and (call := CALL.match(text, begin)):
            return self.default_of_call(call.end())
        if all(isinstance(t, str) for t in terms) and (literal := self.unquoted(BLANKS.match(text, begin).end())):
            terms.append(literal)
        return terms

    def default_of_call(self, at: int) -> list[Literal]:
        arguments = []
        while m := ARGUMENT.match(self.text, at):
            string = next(i for i in range(1, NAME_GROUP) if m[i] is not None)
            arguments.append(Literal(*m.span(string), True))
            at = m.end()
            if m[m.lastindex] == ")":
                return arguments[-1:] if len(arguments) > 1 else []
        return []

    def unquoted(self, at: int) -> Literal | None:
        """The value without quotes from a place to the end of its line, unless it is a plain name."""
        text = self.text
        if self.runs is None:
            runs = [m.span() for m in BARE.finditer(text)]
            self.runs = [a for a, _ in runs], [b for _, b in runs]
        i = bisect_right(self.runs[0], at) - 1
        if i < 0 or self.runs[1][i] <= at:
            return None
        end = self.runs[1][i]
        if end not in self.closed:
            self.closed[end] = bool(LINE_END.match(text, end))
        name = NAME.match(text, at)
        if not self.closed[end] or (name and name.end() == end and not any(map(str.isdigit, name[0]))):
            return None
        begun = self.bare.setdefault(end, [])
        begun.append(at)
        return Literal(at, end, False, nested=len(begun) > 1)

    def below(self, value: list) -> Iterator[list]:
        """The lists that a list leads to."""
        for term in value:
            term = self.values.get(term) if isinstance(term, str) else term
            if isinstance(term, list):
                yield term

    def reached(self, value: list, seen: set[int]) -> Iterator[Literal]:
        """Literals that a list leads to, but for those through lists seen before."""
        waiting = [value]
        while waiting:
            value = waiting.pop()
            if id(value) not in seen:
                seen.add(id(value))
                yield from (t for t in value if isinstance(t, Literal))
                waiting.extend(self.below(value))

    def counts(self, literal: Literal) -> bool:
        """Whether a literal is part of what it is joined to: unquoted ones may be names of values."""
        return literal.quoted or not (literal.nested or self.text[literal.start : literal.end] in self.values)

    def wholes(self) -> dict[int, Facts]:
        """Per list that a target leads to, what its literals are joined to; lists that lead to each other share it."""
        out: dict[int, Facts] = {}
        number: dict[int, int] = {}
        low: dict[int, int] = {}
        path: list[list] = []
        on_path: set[int] = set()
        for _, target in self.targets:
            work = [] if id(target) in number else [(target, self.below(target))]
            if work:
                number[id(target)] = low[id(target)] = len(number)
                path.append(target)
                on_path.add(id(target))
            while work:
                value, following = work[-1]
                for child in following:
                    if id(child) not in number:
                        number[id(child)] = low[id(child)] = len(number)
                        path.append(child)
                        on_path.add(id(child))
                        work.append((child, self.below(child)))
                        break
                    if id(child) in on_path:
                        low[id(value)] = min(low[id(value)], number[id(child)])
                else:
                    work.pop()
                    if work:
                        parent = id(work[-1][0])
                        low[parent] = min(low[parent], low[id(value)])
                    if low[id(value)] == number[id(value)]:
                        ring = []
                        while not ring or ring[-1] is not value:
                            ring.append(path.pop())
                            on_path.discard(id(ring[-1]))
                        whole = self.joined(ring[::-1], out)
                        out.update((id(v), whole) for v in ring)
        return out

    def joined(self, ring: list[list], known: dict[int, Facts]) -> Facts:
        inside, parts = {id(v) for v in ring}, []
        for value in ring:
            for term in value:
                if isinstance(term, Literal):
                    if self.counts(term):
                        parts.append(facts(self.text[term.start : term.end], term.quoted))
                    continue
                term = self.values.get(term) if isinstance(term, str) else term
                if term is not None and id(term) not in inside:
                    parts.append(known[id(term)])
        return joined_facts([p for p in parts if p.parts])

    def secrets(self, threshold: float) -> set[Literal]:
        """Literals that reach a sensitive name, each by itself or as part of what it is joined to."""
        least, found, seen = threshold - CLOSE, set(), set()
        single: dict[int, list[tuple[Literal, float]]] = {}
        for score, value in sorted(self.targets, key=lambda t: -t[0]):
            for literal in self.reached(value, seen):
                if not literal.quoted and len(self.bare.get(literal.end, ())) > 1:
                    single.setdefault(literal.end, []).append((literal, score))
                    continue
                phrase = literal.quoted and score == 1.0
                if score * literal_score(self.text[literal.start : literal.end], phrase) >= least:
                    found.add(literal)
        for end, literals in single.items():
            wanted = {literal.start for literal, _ in literals}
            scores = suffix_scores(self.text, min(wanted), end, wanted)
            found.update(literal for literal, score in literals if score * scores[literal.start] >= least)
        wholes, seen = self.wholes(), set()
        for score, value in self.targets:
            whole = wholes[id(value)]
            if whole.parts > 1 and score * facts_score(whole, score == 1.0 and whole.quoted) >= least:
                found.update(x for x in self.reached(value, seen) if x.end > x.start and self.counts(x))
        return found


def find_spans(text: str, threshold: float = 0.5) -> list[Span]:
    """All spans by start, then kind as in KINDS."""
    if not text:
        return []
    spans = base_spans(text)
    literals = sorted(Values(text).secrets(threshold), key=lambda x: (x.start, -x.end))
    # What covers a literal begins no later and ends no earlier.
    covers = sorted((s.start, s.end) for s in spans)
    i, reach = 0, -1
    for literal in literals:
        while i < len(covers) and covers[i][0] <= literal.start:
            reach = max(reach, covers[i][1])
            i += 1
        if literal.end > reach:
            spans.append(Span("literal", literal.start, literal.end, literal.start, literal.end))
            reach = literal.end
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def mask(text: str) -> str:
    """The text with each secret, not the name before it, replaced."""
    out, at, secrets = [], 0, []
    for kind, _, _, start, end in find_spans(text):
        if kind == "assign" and (quoted := QUOTED.match(text, start - 1)):
            end = max(end, quoted.end() - 1)
        secrets.append((start, end))
    for start, end in sorted(secrets):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], MASK]
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end, secret_start, secret_end>> for each row."""

    def run(rows):
        for doc_id, text in rows:
            yield doc_id, [s._asdict() for s in find_spans(text, threshold)]

    schema = (
        "doc_id long, spans array<struct<kind: string, start: int, end: int, "
        "secret_start: int, secret_end: int>>"
    )
    return map_rows(texts(docs), run, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with secrets masked and n_chars, where present, counted anew; nulls stay null."""

    @F.pandas_udf("string")
    def masked(text: pd.Series) -> pd.Series:
        return text.map(mask, na_action="ignore")

    out = docs.withColumn("text", masked("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def joined(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def spans_digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "literal")
    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
