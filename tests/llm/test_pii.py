import math
import random
import re

from plantloom.llm import pii
from tests.llm.cases import awkward, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: [int(c) for c in m[0] if c.isdigit()]

    def luhn(d):
        return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0

    checks = [("email", EMAIL, lambda m: True),
              ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
              ("card", CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
              ("phone", PHONE, lambda m: 8 <= len(digits(m)) <= 15)]
    return [(k, *m.span()) for k, p, ok in checks for m in p.finditer(text) if ok(m)]


def test_base_spans_by_definition():
    rng = random.Random(7)
    bits = ["a.b", "x@", "@", "mail.com", "-", ".", "..", "1", "255.", "12.34.56.78", "999", "4111 1111 1111 1111",
            "4539578763621486", "+1", " (555) ", "123-4567", "+", " ", "é", "\n", "0" * 5]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii.find_entities(text) == plain(text), text
    assert pii.find_entities("1" * 200_000 + "." + "a" * 200_000 + "@") == []


def test_disclosing_terms(spark):
    rng = random.Random(1)
    common = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(common) for _ in range(30)) for _ in range(200)]
    for i in range(6):  # one mail, always beside the same rare word
        texts.append(f"{rng.choice(common)} Zorblax. mail joe@x.org {rng.choice(common)} {i}")
    docs = documents(spark, *texts)
    found = {r.row.doc_id: r for r in pii.find_personal(docs).collect()}
    total = len(texts)
    hit = [r for r in found.values() if r.terms]
    assert sorted(r.row.doc_id for r in hit) == list(range(200, 206))
    for r in hit:
        said = {r.row.text[t.start:t.end].lower(): t.disclosure for t in r.terms}
        assert {"zorblax", "mail"} <= said.keys() and not said.keys() & set(common)
        # joint, entity and term counts are all six
        chance = (6 + 0.5 * 6 / total) / 6.5
        assert math.isclose(said["zorblax"], 1 + math.log(chance) / math.log(total / 6))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "joe@x.org" not in clean[200] and "[EMAIL]" in clean[200] and "Zorblax" not in clean[200]
    assert all(clean[i] == texts[i] for i in range(200))


def test_rare_entities_disclose(spark):
    rng = random.Random(2)
    common = [f"w{i}" for i in range(30)]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = [prose(30) for _ in range(300)]
    texts += [f"{prose(8)} Quendal ann@x.org {prose(8)}"]  # a mail that occurs once
    texts += [f"{prose(8)} Brimwick bob@x.org {prose(8)}" for _ in range(2)]  # and one that occurs twice
    copy = f"{prose(8)} shared cat@x.org {prose(8)}"
    texts += [f"{prose(8)} shared {i}" for i in range(20)] + [copy] * 40
    rows = pii.find_personal(documents(spark, *texts)).collect()
    for r in rows:
        said = {r.row.text[t.start:t.end] for t in r.terms}
        assert said == {w for w in ("Quendal", "Brimwick") if w in r.row.text}
    clean = {r.text for r in pii.sanitise(documents(spark, *texts)).collect()}
    # one sighting generalises, two remove
    assert sum("[NAME] [EMAIL]" in t for t in clean) == 1 and not any("Brimwick" in t for t in clean)
    # copies are one document: 21 texts hold "shared", one of them the mail
    assert sum(r.row.text == copy for r in rows) == 40


def test_terms_anywhere_in_the_document(spark):
    rng = random.Random(3)
    common = [f"w{i}" for i in range(30)]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = [prose(30) for _ in range(300)]
    texts += [f"Quendal {prose(40)} ann@x.org {prose(40)} (quendal) {prose(9)} Quendal," for _ in range(4)]
    docs = documents(spark, *texts)
    for r in pii.find_personal(docs).collect():
        said = [(r.row.text[t.start:t.end], round(t.disclosure, 9)) for t in r.terms]
        most = round(1 + math.log((4 + 2 / 304) / 4.5) / math.log(304 / 4), 9)
        assert said == ([(w, most) for w in ("Quendal", "quendal", "Quendal")] if r.row.doc_id >= 300 else [])
    assert not any("quendal" in r.text.lower() for r in pii.sanitise(docs).collect())


def test_terms_by_definition(spark):
    """All pairs of whole texts, with no limit on how common a term may be."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rng = random.Random(4)
    mails = [f"m{i}@x.org" for i in range(12)]
    more = [(-i, " ".join(rng.choice(mails) if rng.random() < 0.1 else f"rare{rng.randint(0, 60)}"
                          for _ in range(rng.randint(1, 25)))) for i in range(1, 60)]
    docs = docs.union(spark.createDataFrame(more + more[:9], docs.schema))
    texts = {r.text for r in docs.collect()}
    entities, terms, n_pair, n_entity, n_term = {}, {}, {}, {}, {}
    for t in texts:
        base = pii.find_entities(t)
        entities[t] = {f"{k}:{t[a:b].lower()}" for k, a, b in base}
        terms[t] = pii.find_terms(t, base) if base else []
        for e in entities[t]:
            n_entity[e] = n_entity.get(e, 0) + 1
            for x in {x for x, _, _ in terms[t]}:
                n_pair[e, x] = n_pair.get((e, x), 0) + 1
        for x in {pii.term_of(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")}:
            n_term[x] = n_term.get(x, 0) + 1

    def scores(e, x):
        share = n_entity[e] / len(texts)
        chance = (n_pair[e, x] + 0.5 * share) / (n_term[x] + 0.5)
        return math.log(chance / share) / math.log(1 / share), chance

    marked = 0
    for r in pii.find_personal(docs).collect():
        t, want = r.row.text, []
        for x, start, end in terms[t]:
            most, chance = max(scores(e, x) for e in entities[t])
            if most >= 0.9:
                want.append((start, end, round(most, 9), round(chance, 9)))
        assert [(s.start, s.end, round(s.disclosure, 9), round(s.chance, 9)) for s in r.terms] == want
        marked += len(want)
    assert marked > 0


def test_crowded_documents(spark):
    """Two near copies of 2,000 mails and 12,000 rare words: pairs of classes, not 48 million pairs."""
    rng = random.Random(9)
    body = [f"u{i}@x.org" for i in range(2000)] + [f"term{i}" for i in range(12_000)]
    rng.shuffle(body)
    texts = [" ".join(body), " ".join(body + ["once"])] + [f"plain text {i}" for i in range(300)]
    found = {r.row.doc_id: r for r in pii.find_personal(documents(spark, *texts)).collect()}
    assert len(found[0].base) == 2000 and len(found[0].terms) == 12_000 and len(found[1].terms) == 12_001
    # "once" does not tell the two documents' mails as well as terms in both do
    assert {round(t.chance, 2) for t in found[1].terms} == {0.67, 0.8} and not found[2].terms


def test_filter_grows_with_the_terms():
    assert [pii.bloom_log2(n) for n in (0, 1, 1 << 16, (1 << 16) + 1, 1 << 24, 1 << 40)] == [20, 20, 20, 21, 28, 28]


def test_distinct_words():
    text = "a b\tb\n\nc\x0bd\x0ce\r f\x1cg\xa0h\u2028i  "
    assert pii.distinct_words(text) == set(pii.WORD.findall(text)) and pii.distinct_words("") == set()


def test_sanitised_marks():
    text = "call Bob on 42 now +1 555 123 4567"
    base = [{"kind": "phone", "start": 19, "end": 34}]
    terms = [{"start": 5, "end": 8, "chance": 0.5}, {"start": 12, "end": 14, "chance": 2 / 3},
             {"start": 15, "end": 18, "chance": 0.8}]
    assert pii.sanitised(text, base, terms) == "call [NAME] on [NUMBER]  [PHONE]"
    assert pii.sanitised(None, [], []) is None


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = pii.find_personal(docs).collect()
    assert len(found) == 12 and all(r.base == [] and r.terms == [] for r in found)
    assert pii.sanitise(docs).columns == docs.columns
    assert sorted(map(repr, pii.sanitise(docs).collect())) == sorted(map(repr, docs.collect()))
    assert pii.find_personal(documents(spark)).count() == 0
    # the same entity everywhere has nothing to protect
    assert not any(r.terms for r in pii.find_personal(documents(spark, *["it a@b.c x"] * 5)).collect())
