import random
import re

from plantloom.llm.secret_scan import ASSIGN, KINDS, checksum, find_secrets, secret_spans
from tests.llm.cases import awkward

PLAIN = {"assign": (ASSIGN, lambda m: len(m[2]) >= 6),
         "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)}


def plain(text):
    found = [(k, m.start(), m.end()) for k, (p, ok) in PLAIN.items()
             for m in p.finditer(text) if ok(m)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def test_base_spans_by_definition():
    rng = random.Random(5)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "AKIA", " ", "  ", "=", ":", '"',
            "'", "0123456789abcdef", "dead", "beef" * 6, "ABCDEFGHIJKLMNOP", "x", "İ", "K", "é", "\n", "="]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        got = find_secrets(text)
        assert [s for s in got if s[0] in PLAIN] == plain(text), text


def test_checksums_decide():
    body = "abcDEF0123456789abcDEF01234567"
    good = f"ghp_{body}{checksum(body)}"
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    assert ("github", 3, 43) in find_secrets(f"é, {good}.")
    assert not any(k == "github" for k, _, _ in find_secrets(bad))
    assert any(k == "npm" for k, _, _ in find_secrets(f"npm_{body}{checksum(body)}"))
    assert find_secrets(None) == find_secrets("") == []


def test_long_texts_take_linear_time():
    assert find_secrets("token " * 100_000) == []
    assert len(find_secrets("f" * 500_000)) == 1
    assert find_secrets("token" + " " * 500_000) == []


def test_awkward_rows(spark):
    got = awkward(spark).select("doc_id", secret_spans(spark)("text").alias("s")).collect()
    assert len(got) == 12 and all(r.s == [] for r in got)
