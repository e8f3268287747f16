"""Secret scans through a trigram index: Boolean queries first, regular expressions second.

From each rule's expression a Boolean query of byte trigrams is derived, an OR of ANDs that
every match must satisfy.  Texts are indexed in segments: the lower-cased texts of a batch,
SEGMENT bytes at most (one longer text is a segment of its own), as posting lists from each
trigram that a rule names to the texts that hold it.  A rule's posting lists are intersected
and united, and only the texts left over are matched.  A rule without mandatory trigrams is
matched against every text.  A segment lives within its task: documents are scanned once and
nothing is shuffled.

Rules beyond the base ones add spans; they never take any away.  All rules are matched one by
one, each leftmost and without overlaps among its own matches; those whose group is shorter
than the rule's least length are dropped after matching.

Defined cases: a null text counts as empty; a text without secrets has counts of 0, no spans,
and the digest of the empty text.  Every row of the table gives one row, repeated rows and
rows without id as well.  Equal starts are ordered by the rules' order.  Offsets count code
points.  Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, query, read, utf8

SEGMENT = 4 << 20  # bytes of text indexed together
CLASS_MOST = 8  # characters of a class that are told apart
TAILS_MOST = 64  # texts that a run of literals may stand for
PARTS_MOST = 128  # ANDs of a query
OUTSIDE = 0xFF  # a byte that is in no UTF-8 text


# ---------------------------------------------------------------- queries

# A query is a set of sets of trigrams: one of the sets must be there as a whole.
Grams = frozenset[int]
Query = frozenset[Grams]
ALWAYS: Query = frozenset([frozenset()])


def gram(three: bytes) -> int:
    return int.from_bytes(three, "big")


def either(a: Query, b: Query) -> Query:
    """a OR b, without the sets that a smaller one makes needless."""
    whole = a | b
    return frozenset(s for s in whole if not any(t < s for t in whole))


def both(a: Query, b: Query) -> Query:
    """a AND b; where that has too many parts, the one of the two that says more."""
    if len(a) * len(b) > PARTS_MOST:
        return min(a, b, key=lambda q: (q == ALWAYS, len(q)))
    return either(frozenset(x | y for x, y in product(a, b)), frozenset())


def of_texts(texts: Iterable[bytes]) -> Query:
    """What holds where one of the texts is."""
    found = frozenset()
    for text in texts:
        found = either(found, frozenset([frozenset(gram(text[i : i + 3]) for i in range(len(text) - 2))]))
    return found


class _Walk:
    """Walks an expression from left to right.  ``tails`` are the texts that what came last
    may be, all there is as long as the walk is ``whole``; they become part of the query where
    something unknown follows."""

    def __init__(self, flags: int):
        self.flags = flags
        self.any_case = bool(flags & re.IGNORECASE)
        # Without re.ASCII, letters may match others outside ASCII in any case.
        self.wide_case = self.any_case and not flags & re.ASCII
        self.query, self.tails, self.whole = ALWAYS, {b""}, True

    def cut(self) -> None:
        self.query = both(self.query, of_texts(self.tails))
        self.tails, self.whole = {b""}, False

    def put(self, texts: set[bytes] | None) -> None:
        """One of the texts follows, or, for None, something unknown."""
        if texts is None or len(texts) * len(self.tails) > TAILS_MOST:
            self.cut()
        if texts is not None:
            self.tails = {a + b for a, b in product(self.tails, texts)}

    def literal(self, code: int) -> set[bytes] | None:
        char = chr(code)
        if self.any_case and (code > 127 or (self.wide_case and char.isalpha())):
            return None
        return {char.encode().lower()}

    def members(self, items) -> set[bytes] | None:
        codes: set[int] = set()
        for kind, value in items:
            if kind is op.LITERAL:
                codes.add(value)
            elif kind is op.RANGE and value[1] - value[0] < 2 * CLASS_MOST:
                codes.update(range(value[0], value[1] + 1))
            else:
                return None
        texts: set[bytes] = set()
        for code in codes:
            one = self.literal(code)
            if one is None:
                return None
            texts |= one
        return texts if len(texts) <= CLASS_MOST else None

    def go(self, items) -> _Walk:
        for kind, value in items:
            if kind is op.LITERAL:
                self.put(self.literal(value))
            elif kind is op.IN:
                self.put(self.members(value))
            elif kind is op.SUBPATTERN and not (value[1] or value[2]):  # no flags of its own
                self.one_of([value[3]])
            elif kind is op.BRANCH:
                self.one_of(value[1])
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                self.repeated(*value)
            elif kind is not op.AT:
                self.put(None)
        return self

    def one_of(self, choices) -> None:
        walks = [_Walk(self.flags).go(items) for items in choices]
        texts = set().union(*(walk.tails for walk in walks))
        if all(walk.whole for walk in walks) and len(texts) <= TAILS_MOST:
            self.put(texts)
            return
        self.cut()
        found: Query = frozenset()
        for walk in walks:
            walk.cut()
            found = either(found, walk.query)
        self.query = both(self.query, found)

    def repeated(self, least: int, most: int, items) -> None:
        once = _Walk(self.flags).go(items)
        if (least, most) == (0, 1) and once.whole and len(once.tails) < TAILS_MOST:
            self.put(once.tails | {b""})
            return
        for _ in range(min(least, 3)):
            self.one_of([items])
        if least != most or least > 3:
            self.cut()


def trigram_query(pattern: str, flags: int = 0) -> Query:
    """Trigrams of the lower-cased bytes that every text with a match of ``pattern`` has."""
    parsed = parser.parse(pattern, flags)
    walk = _Walk(parsed.state.flags).go(parsed)
    walk.cut()
    return walk.query


# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, self.flags)

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern, self.flags)

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for match in self.regex.finditer(text):
            start, end = match.span(self.group)
            if end - start >= self.least:
                yield match.span()


BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=12, flags=re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # Whole runs of 16 and more: the same as all runs without the shorter ones.
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED = (
    Rule("private", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)


# ---------------------------------------------------------------- segments


class Segment:
    """Posting lists of some texts for some trigrams."""

    def __init__(self, texts: Sequence[bytes], grams: np.ndarray):
        """``grams`` are sorted."""
        self.size = len(texts)
        apart = bytes([OUTSIDE])
        data = np.frombuffer(apart.join(texts).lower(), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        starts = np.cumsum(lengths + 1) - lengths - 1
        self.lists: dict[int, np.ndarray] = {}
        if len(data) < 3 or not len(grams):
            return
        # Places where the first two bytes fit come first: the table of them stays in the cache.
        pairs = np.zeros(1 << 16, dtype=bool)
        pairs[grams >> 8] = True
        places = np.flatnonzero(pairs[(data[:-2].astype(np.uint16) << 8) | data[1:-1]])
        codes = (data[places].astype(np.int64) << 16) | (data[places + 1].astype(np.int64) << 8) | data[places + 2]
        which = np.searchsorted(grams, codes)
        hit = grams[np.minimum(which, len(grams) - 1)] == codes
        rows = np.searchsorted(starts, places[hit], side="right") - 1
        postings = np.unique(which[hit] * self.size + rows)
        for number, part in zip(*self._parts(postings)):
            self.lists[int(grams[number])] = part

    def _parts(self, postings: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        numbers, rows = postings // self.size, postings % self.size
        found, firsts = np.unique(numbers, return_index=True)
        return found.tolist(), np.split(rows, firsts[1:]) if len(found) else []

    def candidates(self, wanted: Query) -> np.ndarray:
        """Rows that satisfy a query, in order."""
        none = np.empty(0, dtype=np.int64)
        found = none
        for grams in wanted:
            if not grams:
                return np.arange(self.size)
            lists = sorted((self.lists.get(g, none) for g in grams), key=len)
            rows = lists[0]
            for other in lists[1:]:
                if not len(rows):
                    break
                rows = np.intersect1d(rows, other, assume_unique=True)
            found = np.union1d(found, rows)
        return found


def segments(texts: list[bytes], size: int = SEGMENT) -> Iterator[list[bytes]]:
    """Runs of texts of ``size`` bytes at most, but for longer texts, which stand alone."""
    held, total = [], 0
    for text in texts:
        if held and total + len(text) > size:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield held


def scan(texts: Sequence[bytes], rules: Sequence[Rule]) -> list[list[tuple[int, int, int]]]:
    """Per text (start, number of the rule, end) of the spans of all rules, in that order."""
    grams = np.array(sorted({g for rule in rules for s in rule.query for g in s}), dtype=np.int64)
    index = Segment(texts, grams)
    wanted: dict[int, list[int]] = {}
    for number, rule in enumerate(rules):
        for row in index.candidates(rule.query).tolist():
            wanted.setdefault(row, []).append(number)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for row, numbers in wanted.items():
        text = texts[row].decode()
        found[row] = sorted((start, n, end) for n in numbers for start, end in rules[n].spans(text))
    return found


def listed(spans: Iterable[tuple[int, int, int]], rules: Sequence[Rule]) -> str:
    return ",".join(f"{rules[n].kind}:{start}:{end}" for start, n, end in spans)


def secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + ADDED) -> DataFrame:
    """doc_id, rule, start, end and match of every span in ``docs``."""

    def run(ids, texts):
        bodies, at = list(utf8(texts)), 0
        ids = ids.to_pylist()
        for part in segments(bodies):
            rows = [
                (ids[at + i], rules[n].kind, start, end, part[i].decode()[start:end])
                for i, spans in enumerate(scan(part, rules)) for start, n, end in spans
            ]
            at += len(part)
            if rows:
                yield [list(column) for column in zip(*rows)]

    return map_columns(
        docs, run, "doc_id long, rule string, start long, end long, match string",
        F.col("doc_id").cast("long"), F.col("text"),
    )


def span_digests(docs: DataFrame, base: Sequence[Rule] = BASE, added: Sequence[Rule] = ADDED) -> DataFrame:
    """One row per row of ``docs``: doc_id, how many spans each base rule has (n_<kind>), a
    digest of the base spans, and all spans."""
    rules = (*base, *added)

    def run(ids, texts):
        bodies, at = list(utf8(texts)), 0
        for part in segments(bodies):
            found = scan(part, rules)
            kept = [[s for s in spans if s[1] < len(base)] for spans in found]
            yield [
                ids.slice(at, len(part)),
                *([sum(s[1] == n for s in spans) for spans in kept] for n in range(len(base))),
                [hashlib.sha256(listed(spans, rules).encode()).hexdigest() for spans in kept],
                [listed(spans, rules) for spans in found],
            ]
            at += len(part)

    counts = "".join(f"n_{rule.kind} long, " for rule in base)
    return map_columns(
        docs, run, f"doc_id long, {counts}base_sha256 string, spans string", F.col("doc_id").cast("long"), F.col("text")
    )


# ---------------------------------------------------------------- query

# The rules as SQL has them: without flags, so letters of any case are written out.
SQL_RULES = [
    (
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("private", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 0),
    ("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
]
# Places are what lies between matches, and the matches, added up.
_FOUND = " UNION ALL ".join(
    f"""
    SELECT doc, {n} AS rule, '{kind}' AS kind, unnest(starts) AS start, unnest(matches) AS match, unnest(groups) AS grouped
    FROM (
        SELECT doc, matches, groups, list_transform(matches, lambda m, i:
                   list_sum(list_transform(gaps[1:i], lambda g: length(g)))
                   + coalesce(list_sum(list_transform(matches[1:i - 1], lambda g: length(g))), 0)) AS starts
        FROM (SELECT doc, regexp_extract_all(body, '{pattern}', 0) AS matches,
                     regexp_extract_all(body, '{pattern}', {group}) AS groups,
                     regexp_split_to_array(body, '{pattern}') AS gaps
              FROM texts)
    ) WHERE len(matches) > 0"""
    for n, (kind, pattern, group, _) in enumerate(SQL_RULES)
)
_LEAST = " ".join(f"WHEN {n} THEN {least}" for n, (_, _, _, least) in enumerate(SQL_RULES))


@query(
    "op11_secret_scan",
    f"""
    WITH texts AS (
        SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS body FROM documents
    ), found AS ({_FOUND}
    ), spans AS (
        SELECT doc, rule, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(match) AS BIGINT) AS span
        FROM found WHERE length(grouped) >= CASE rule {_LEAST} END
    ), listed AS (
        SELECT doc, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access,
               count(*) FILTER (WHERE rule = 2) AS n_hex,
               string_agg(span, ',' ORDER BY start, rule) FILTER (WHERE rule < 3) AS base,
               string_agg(span, ',' ORDER BY start, rule) AS spans
        FROM spans GROUP BY doc
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN listed USING (doc)
    """,
)
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(read(spark, sf_dir, "documents"))
