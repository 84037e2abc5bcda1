import random
import re

import duckdb

from plantloom.llm import quality_rules as qr
from plantloom.session import materialize
from tests.llm.cases import awkward, documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    found = WORD.findall(text)
    windows = {}
    for i in range(len(found) - 4):
        windows.setdefault(tuple(found[i:i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(docs):
    got = qr.ledger(docs).select("row.text", *MEASURES, "failed").collect()
    for r in got:
        assert tuple(r[m] for m in MEASURES) == plain(r.text), r.text
        n, _, _, _, repeat = plain(r.text)
        assert bool(r.failed & 3) == (n < 10 or 100 * repeat > 20 * n)
    return got


def test_measures_by_definition(spark):
    rng = random.Random(6)
    texts = [words(rng, rng.randint(0, 60), ("a", "b")) for _ in range(60)]
    texts += [words(rng, 80, tuple(f"w{i}" for i in range(40))) for _ in range(20)]
    texts += ["a\nb\na\n \n\n a\n", "x # * $\n\r\x0b|<>", " a", "\n", "w " * 9, "w " * 10]
    check(documents(spark, *texts))


def test_awkward_rows(spark):
    assert len(check(awkward(spark))) == 12
    assert qr.ledger(documents(spark)).count() == 0


def test_ablation_counts_what_a_rule_alone_fails(spark):
    good = " ".join(f"word{i}" for i in range(30))
    docs = documents(spark, good, "few", "# " * 6, good.upper(), f"{good} # # # # # # # # # #", None)
    rows = qr.ledger(docs).collect()
    names = list(qr._rules())
    got = {r.rule: (r.n_failed, r.n_only) for r in qr.ablation(qr.ledger(docs), "2026-01").collect()}
    mask = qr.mask("2026-01")
    for rule in qr.POLICIES["2026-01"]:
        bit = 1 << names.index(rule)
        assert got[rule] == (sum(bool(r.failed & bit) for r in rows),
                             sum(r.failed & mask == bit for r in rows))
    kept = qr.ledger(docs).filter(qr.passes("2026-01")).select("row.text").collect()
    assert [r.text for r in kept] == [good]


def test_policies_and_ablation_of_a_whole_table(spark):
    """Bitwise aggregation over every ledger row against sums over the SQL's own rows."""
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    con.execute(f"CREATE TABLE plain AS {qr.OP8_SQL}")
    rows = materialize(qr.ledger(spark.read.parquet(f"{sf}/documents.parquet")))
    names = list(qr._rules())
    for policy, rules in qr.POLICIES.items():
        got = {r.rule: (r.n_failed, r.n_only) for r in qr.ablation(rows, policy).collect()}
        want = {}
        for rule in rules:
            bit = 1 << names.index(rule)
            want[rule] = con.execute(
                f"SELECT count(*) FILTER (failed_rules & {bit} <> 0), "
                f"count(*) FILTER (failed_rules & {qr.mask(policy)} = {bit}) FROM plain").fetchone()
        assert got == want
        kept = con.execute(f"SELECT count(*) FROM plain WHERE kept_{policy.replace('-', '_')}").fetchone()[0]
        assert rows.filter(qr.passes(policy)).count() == kept
    # what the current policy would keep without a rule is what hangs on it alone
    only = dict(con.execute("SELECT only_rule, count(*) FROM plain WHERE only_rule IS NOT NULL GROUP BY 1").fetchall())
    assert only == {r.rule: r.n_only for r in qr.ablation(rows).collect() if r.n_only} and only


def test_no_python_and_no_shuffle_in_the_plan(spark):
    plan = qr.ledger(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "BatchEval" not in plan and "Exchange" not in plan
