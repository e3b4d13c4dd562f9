"""Secret scans."""

import hashlib
import re

import pytest
from llm_rows import docs

from shopflow.llm import secrets

KEY = "A1b2C3d4E5f6G7h8"


def found(text):
    base = secrets.base_spans(text)
    return sorted((secrets.KINDS[k], text[s:e]) for s, k, e in base + secrets.lexed_spans(text, base))


@pytest.mark.parametrize("text, want", [
    (f"Password: {KEY}", [("assign", f"Password: {KEY}")]),
    (f'"api_key" : "{KEY}"', [("assign", f'api_key" : "{KEY}')]),
    ("token = short", []),
    ("token: secret: abcdefghijklmnop", []),  # the first match takes the second name
    ("ſecret=abcdefghijklmnop", []),  # letters of ASCII only
    ("AKIAABCDEFGHIJKLMN", [("access", "AKIAABCDEFGHIJKLMN")]),
    ("AKIAABCDEFGHIJKLM", []),
    ("xx0123456789abcdef0yy", [("hex", "0123456789abcdef0")]),
    ("0123456789abcde", []),
    (f'DB_PWD="{KEY}"', [("lexed", KEY)]),
    (f"k = '{KEY}'\nprivateKey = k", [("lexed", KEY)]),
    (f"k = '{KEY}'\nk = 'plain words'\nprivateKey = k", []),
    ('signing-key: "A1b2C3d4" + "E5f6G7h8"', [("lexed", "A1b2C3d4"), ("lexed", "E5f6G7h8")]),
    ("authToken = changeme", []),
    (f"color = {KEY}", []),
    ("if (pwd == other) x", []),
    ("see http://example.org/password", []),
    ("auth: the author said", []),
    ("", []),
])
def test_texts(text, want):
    assert found(text) == want


ODD = "é!Qx%7&"  # with signs that no base kind takes


@pytest.mark.parametrize("text, want", [
    (f"spring.security.oauth2.client.registration.internal-sso.client-secret.of.{'x' * 80}: '{ODD}9z'", [("lexed", ODD + "9z")]),
    (f"db_password{' ' * 60}= '{ODD}9z'", [("lexed", ODD + "9z")]),
    (f"'db_pwd'{chr(9) * 500}: '{ODD}9z'", [("lexed", ODD + "9z")]),
    (f"db_pwd\n{' ' * 80}= '{ODD}9z'", []),
    ("db_pwd = " + " + ".join(f"'{ODD}{i}'" for i in range(300)), sorted(("lexed", f"{ODD}{i}") for i in range(300))),
    (f"k = '{ODD}9z'\n" + "k = k + k\n" * 500 + "db_pwd = k", [("lexed", ODD + "9z")]),
    ("k = 'é'\n" + "".join(f"k = k + '{ODD}{i}'\n" for i in range(3000)) + "db_pwd = k",
     sorted([("lexed", "é")] + [("lexed", f"{ODD}{i}") for i in range(3000)])),
    ("db_pwd = 'change' + 'me'", []),
    (f"db_pwd = '{ODD}9z ' + 'word'", []),
    (f"db_pwd = ' ' + '{ODD}9z' + ' '", [("lexed", " "), ("lexed", " "), ("lexed", ODD + "9z")]),
])
def test_names_and_values_without_limits(text, want):
    assert found(text) == want


@pytest.mark.parametrize("text, want", [
    (f'db_pwd = """{ODD}9z"""', [ODD + "9z"]),
    (f"db_pwd = u'''\n{ODD}9z\n'''", [f"\n{ODD}9z\n"]),
    (f"db_pwd = f'{ODD}9z' + rb\"{ODD}8y\"", [ODD + "8y", ODD + "9z"]),
    (f"auth:\n  db_pwd: |\n    {ODD}9z\n  other: |-\n    {ODD}7x\n", [ODD + "9z"]),
    (f"- db_pwd: >-  # note\n\n    {ODD}9z  \n- other: {ODD}7x", [ODD + "9z"]),
    (f"db_pwd: |\n{ODD}9z", []),  # not deeper than its name
    (f"<config><db-password>{ODD}9z</db-password><colour>{ODD}7x</colour></config>", [ODD + "9z"]),
    (f"<pwd kind='a'> {ODD}9z </pwd >", [f" {ODD}9z "]),
    (f"<pwd>{ODD}9z</other>", []),
    ('db_pwd = ""', []),
    ('db_pwd = """open', []),
])
def test_literals_of_other_forms(text, want):
    assert sorted(x for k, x in found(text) if k == "lexed") == want


def test_many_literals_and_base_spans_take_linear_time():
    import time

    def seconds(n):
        text = "\n".join(f"password = {KEY}{i}\ndb_pwd = '{ODD}{i}'" for i in range(n))
        began = time.process_time()
        base = secrets.base_spans(text)
        assert len(secrets.lexed_spans(text, base)) == n == len(base)
        return time.process_time() - began

    assert seconds(16_000) < 12 * seconds(4_000) + 0.5


def test_spans_within_base_spans_are_left_out():
    text = "x" * 100
    for taken in ([(5, 0, 9), (7, 1, 20), (40, 2, 50)], []):
        kept = {(s, e) for s in range(0, 60) for e in range(s + 1, 60)
                if not any(s < b and a < e for a, _, b in taken)}
        assert kept == {(s, e) for s in range(0, 60) for e in range(s + 1, 60) if free(taken, s, e)}
    assert text


def free(taken, s, e):
    """Whether ``lexed_spans`` keeps a literal at that place."""
    class Held:
        def spans(self, seen):
            yield s, e

    original = secrets.assignments, secrets.randomness
    secrets.assignments, secrets.randomness = (lambda text: [("password", Held())]), (lambda value: 1.0)
    try:
        return bool(secrets.lexed_spans("=", taken))
    finally:
        secrets.assignments, secrets.randomness = original


def test_a_long_chain_of_operators_is_read_once():
    text = "db_pwd=" + "+".join(f"x=é!{i}" for i in range(20_000))
    assert len(found(text)) == 20_000


def brute(text):
    """The base spans read off the contract, pattern by pattern."""
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 18), (2, r"[0-9a-f]+", 16)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out)


def test_rows_of_every_kind(spark):
    long = "words and words " * 40_000 + f"secret={KEY} é AKIA{'Z' * 20}"
    rows = [(1, f"é password={KEY}{KEY}"), (2, None), (3, ""), (1, f"é password={KEY}{KEY}"), (None, "x"),
            (4, long), (5, "token=" + "0a" * 20), (6, f"DB_PWD='{KEY}' AKIA{'Q' * 16}")]
    got = {r.doc_id: r for r in secrets.summary(docs(spark, rows)).collect()}
    for doc_id, text in rows:
        base = brute(text or "")
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        r = got[doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and "lexed" not in s] == (joined.split(",") if joined else [])
    assert got[6].n_lexed == 1 and got[5].n_hex == 1 and got[5].n_assign == 1
    assert secrets.summary(docs(spark, rows)).count() == len(rows)
    assert secrets.summary(docs(spark, [])).count() == 0
