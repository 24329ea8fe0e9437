"""Secret scans with one combined deterministic automaton.

All rules are compiled into one minimal byte automaton (subset construction, Moore's minimisation) whose transition
array reads every byte of a text once, whatever the number of rules, and reports where matches first end. There the rule's
reversed automaton walks back to the leftmost start and its own automaton walks on to the longest end; so a rule's
matches are leftmost and do not overlap. Work beyond the one pass is done at matches only.

A rule is a head and a tail; matches whose tail or whole is too short are dropped after they have been taken (they
hide no later start, as in a search with the plain pattern).

Defined results: a null text counts as empty; a text without secrets has empty lists, and its digest is that of the
empty string. Null ids and repeated rows give a row each. An empty table gives an empty table. Extra columns are not
read by :func:`scan` and are carried unchanged by :func:`redact`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.automaton import backwards, combine_first_ends, compile_tree, parse


@dataclass(frozen=True)
class Rule:
    """``head`` then ``tail``; least lengths in bytes of the tail and of the whole."""

    kind: str
    head: str
    tail: str
    tail_least: int = 1
    whole_least: int = 1
    any_case: bool = False


# The base kinds, in their order. In hex, runs below 24 are never wanted and a run is a match's whole
# extent, so counting to 24 in the pattern gives the same matches.
BASE_RULES = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]+",
         tail_least=6, any_case=True),
    Rule("access", "AKIA", "[A-Z0-9]+", whole_least=20),
    Rule("hex", "", "[0-9a-f]{24,}"),
)
# Further kinds that this scan adds: well-known public token formats.
MORE_RULES = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]+", tail_least=36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]+", tail_least=10),
    Rule("google", "AIza", "[A-Za-z0-9_-]+", tail_least=35),
    Rule("stripe", "[rs]k_(live|test)_", "[A-Za-z0-9]+", tail_least=16),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.", "[A-Za-z0-9_-]+", tail_least=8),
    Rule("pem", "-----BEGIN ", "([A-Z]+ )*PRIVATE KEY-----"),
)
MARK = "[SECRET]"


class Scanner:
    """The compiled rules; ``spans`` finds them all in a text."""

    def __init__(self, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> None:
        self.rules = rules
        heads = [parse(r.head, r.any_case) for r in rules]
        whole = [("cat", [head, parse(r.tail, r.any_case)]) for head, r in zip(heads, rules, strict=True)]
        own = [compile_tree(x) for x in whole]
        all_rules = combine_first_ends(own)
        self.step, self.ends = all_rules.step.tolist(), all_rules.rules.tolist()
        self.start, self.accepting = all_rules.start, all_rules.accepting
        self.own = [self._lists(x) for x in own]
        self.back = [self._lists(compile_tree(backwards(x))) for x in whole]
        self.heads = [self._lists(compile_tree(x)) for x in heads]

    @staticmethod
    def _lists(automaton) -> tuple[list[int], list[int], int]:
        return automaton.step.tolist(), automaton.rules.tolist(), automaton.start

    def _longest(self, automaton, data: bytes) -> int:
        """Length of the longest match at the first byte of ``data`` (-1: none); ``data`` may be any byte iterable."""
        step, ends, state = automaton
        best = 0 if ends[state >> 8] else -1
        for n, b in enumerate(data, 1):
            state = step[state | b]
            if not state:
                break
            if ends[state >> 8]:
                best = n
        return best

    def _resolve(self, rule: int, data: bytes, done: int, end: int) -> tuple[int, int] | None:
        """The match whose first end is ``end`` and that starts at ``done`` or later, as (start, longest end)."""
        back = self._longest(self.back[rule], (data[k] for k in range(end - 1, done - 1, -1)))
        if back < 0:
            return None
        start = end - back
        return start, start + self._longest(self.own[rule], memoryview(data)[start:])

    def _kept(self, rule: int, data: bytes, start: int, end: int) -> bool:
        r = self.rules[rule]
        if end - start < r.whole_least:
            return False
        head = self._longest(self.heads[rule], memoryview(data)[start:end]) if r.tail_least > 1 else 0
        return end - start - head >= r.tail_least

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, by start, then rule."""
        step, state, accepting, found = self.step, self.start, self.accepting, []
        done = [0] * len(self.rules)
        for end, b in enumerate(data, 1):
            state = step[state | b]
            if state >= accepting:
                for rule in range(len(done)):
                    if self.ends[state >> 8] >> rule & 1 and end > done[rule] and (
                            match := self._resolve(rule, data, done[rule], end)):
                        done[rule] = match[1]
                        if self._kept(rule, data, *match):
                            found.append((*match, rule))
        return sorted(found, key=lambda x: (x[0], x[2]))

    def named_spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then rule."""
        data = text.encode()
        found = self.spans(data)
        if not found or len(data) == len(text):
            return [(self.rules[r].kind, s, e) for s, e, r in found]
        return [(self.rules[r].kind, n := len(data[:s].decode()), n + len(data[s:e].decode())) for s, e, r in found]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """A row a document: doc_id, secrets (array of kind, start, end; code points, end exclusive)."""
    scanner = Scanner(rules)
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in scanner.named_spans(x.as_py())]
                    for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, spans)], ["doc_id", "secrets"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, secrets array<struct<kind:string,start:bigint,end:bigint>>")


def digest(found: DataFrame, base_kinds: tuple[str, ...] = tuple(r.kind for r in BASE_RULES)) -> DataFrame:
    """Counts and digests of :func:`scan`'s rows."""
    text = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    secrets = F.col("secrets")
    count = lambda kind: F.size(F.filter(secrets, lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(secrets, lambda x: x["kind"].isin(*base_kinds))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in base_kinds),
                        F.sha2(text(base), 256).alias("base_sha256"), text(secrets).alias("spans"))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = MARK) -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
           mark: str = MARK) -> DataFrame:
    """``docs`` with every secret replaced in the text; a null text stays null, all other columns as they are."""
    scanner, at = Scanner(rules), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for x in batch.column(at):
                text = x.as_py()
                texts.append(redacted(text, scanner.named_spans(text), mark) if text else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def scan_sql(rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
             base_kinds: tuple[str, ...] = tuple(r.kind for r in BASE_RULES)) -> str:
    """DuckDB SQL for :func:`digest` of :func:`scan` over ``documents``."""
    def pattern(r: Rule) -> str:
        both = f"{r.head}\n{r.tail}".replace("(", "(?:")
        if r.any_case:
            head, tail = both.split("\n")
            letters, inside = [], False
            for c in head:
                inside = (inside or c == "[") and c != "]"
                letters.append(f"[{c.upper()}{c}]" if c.isalpha() and not inside and c != "x" else c)
            both = "".join(letters) + "\n" + tail
        return "({})({})".format(*both.split("\n")).replace("'", "''")

    kinds = [(r, f"'{pattern(r)}'") for r in rules]
    takes = ", ".join(f"regexp_extract_all(t, {p}) AS m{k}, string_split_regex(t, {p}) AS p{k}"
                      for k, (_, p) in enumerate(kinds))
    spans = ", ".join(
        f"[{{'s': list_sum([length(x) for x in p{k}[1:i]]) + coalesce(list_sum([length(x) for x in m{k}[1:i - 1]]), 0),"
        f" 'r': {k}, 'n': length(m{k}[i])}} for i in range(1, len(m{k}) + 1)"
        f" if length(regexp_extract(m{k}[i], {p}, 2)) >= {r.tail_least} and length(m{k}[i]) >= {r.whole_least}] AS l{k}"
        for k, (r, p) in enumerate(kinds))
    names = "[" + ", ".join(f"'{r.kind}'" for r in rules) + "]"
    text = lambda cond: (f"array_to_string([{names}[x.r + 1] || ':' || x.s::BIGINT || ':' || (x.s + x.n)::BIGINT "  # noqa: E731
                         f"for x in spans if {cond}], ',')")
    base = [k for k, r in enumerate(rules) if r.kind in base_kinds]
    every = "l0" if len(rules) == 1 else "list_concat(" * (len(rules) - 1) + "l0" + "".join(
        f", l{k})" for k in range(1, len(rules)))
    return f"""
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
found AS (SELECT doc_id, {takes} FROM texts),
placed AS (SELECT doc_id, {spans} FROM found),
joined AS (SELECT *, list_sort({every}) AS spans FROM placed)
SELECT doc_id, {", ".join(f"len(l{k})::BIGINT AS n_{rules[k].kind}" for k in base)},
       sha256({text(f"x.r IN ({', '.join(map(str, base))})")}) AS base_sha256, {text("true")} AS spans
FROM joined"""
