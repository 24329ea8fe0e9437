import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import secret_scan
from ledgerlake.llm.automaton import backwards, combine_first_ends, compile_tree, parse
from tests.llm.cases import hard_docs, hard_rows, no_docs

PARTS = ["password", "passwd", "Secret", "TOKEN", "api_key", "apikey", "api", " ", "  ", ":", "=", '"', "'", "abcdef",
         "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é", "ñ日", ".", "pass", "\n", "deadbeefdeadbeef", "A1", "ghp_",
         "xoxb-", "sk_live_", "eyJ", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "AIza"]


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.Scanner()


def brute(text):
    """The rules by the re module."""
    out = []
    for k, r in enumerate(secret_scan.BASE_RULES + secret_scan.MORE_RULES):
        head = f"(?i:{r.head})" if r.any_case else r.head
        for m in re.finditer(f"(?P<head>{head})(?P<tail>{r.tail})", text, re.A):
            if len(m["tail"]) >= r.tail_least and len(m[0]) >= r.whole_least:
                out.append((m.start(), k, m.end(), r.kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


@settings(max_examples=1500, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=14))
def test_spans_match_the_re_module(scanner, parts):
    text = "".join(parts)
    assert scanner.named_spans(text) == brute(text)


def test_the_plain_pattern_hides_what_it_takes(scanner):
    assert scanner.named_spans("token:token:abcdefgh") == []  # the first, too short match takes the second's head
    assert scanner.named_spans("token=token:abcdefgh") == []
    assert scanner.named_spans("x token==abcdef") == [("assign", 2, 15)]


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=12))
def test_automata_match_the_re_module(text):
    for pattern in ("a(b|aa)*", "(ab?){2,3}", "a+b{2,}|ba", "[^a]a{0,2}"):
        step, rules, state = compile_tree(parse(pattern)), None, None
        state, rules = step.start, step.rules
        for b in text.encode():
            state = step.step[state | b]
        assert bool(rules[state >> 8]) == bool(re.fullmatch(pattern, text))
        back, state = compile_tree(backwards(parse(pattern))), None
        state = back.start
        for b in text[::-1].encode():
            state = back.step[state | b]
        assert bool(back.rules[state >> 8]) == bool(re.fullmatch(pattern, text))


def test_minimal_and_first_ends():
    assert len(compile_tree(parse("(a|b)*abb")).rules) == 5  # four states and the dead one
    both = combine_first_ends([compile_tree(parse("ab+")), compile_tree(parse("b"))])
    state, ends = both.start, []
    for b in b"xabb":
        state = both.step[state | b]
        ends.append(int(both.rules[state >> 8]))
    assert ends == [0, 0, 3, 2]


def test_rows_and_digests(spark):
    found = {(r["doc_id"], r["spans"]): r for r in secret_scan.digest(secret_scan.scan(hard_docs(spark))).collect()}
    for r in hard_rows():
        got = found[r[0], secret_scan.joined(brute(r[1] or ""))]
        assert got["n_assign"] == sum(k == "assign" for k, _, _ in brute(r[1] or ""))
    assert secret_scan.scan(no_docs(spark)).collect() == []


def test_redaction_keeps_rows_and_columns(spark, scanner):
    docs = hard_docs(spark)
    out = secret_scan.redact(docs)
    assert out.schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[15] == "[SECRET] and 日本 [SECRET]" and texts[1] is None and texts[2] == ""
    assert not any(brute(t or "") for t in texts.values())
    assert secret_scan.redacted("abcdefgh", [("a", 1, 4), ("b", 2, 5), ("c", 6, 7)], "#") == "a#f#h"
    assert secret_scan.redact(no_docs(spark)).collect() == []
