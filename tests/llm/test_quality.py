import re

from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from fogline.llm import quality
from tests.llm.conftest import odd_rows

TEXT = st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "é日", "#", "$x", " ", "\n", "\t", "\x0b", "  ", "\u00a0"]), max_size=40).map("".join))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    marked = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


@given(st.lists(TEXT, max_size=8))
@settings(max_examples=200, deadline=None)
def test_measurements_equal_brute_force(listed):
    got = quality._measure(pa.array(listed, pa.string()), [t or "" for t in listed])
    assert list(zip(*(got[m].tolist() for m in quality.MEASURES))) == [brute(t) for t in listed]


def test_odd_rows_policies_and_ablations(spark, odd, empty):
    ledger = quality.rule_ledger(odd).cache()
    rows = ledger.collect()
    got = sorted(((r["doc_id"], *(r[m] for m in quality.MEASURES)) for r in rows), key=str)
    # The one very long text is too long for the brute force here.
    assert [r for r in got if r[0] != 20] == sorted(((d, *brute(t)) for d, t, *_ in odd_rows() if d != 20), key=str)
    assert next(r for r in got if r[0] == 20)[1:] == (60_000, sum(4 + len(str(i % 5000)) for i in range(60_000)), 0, 0, 60_000)
    for policy in (quality.BASE, quality.POLICY_1, quality.POLICY_2):
        failed = [r["failed"] for r in rows]
        for a in quality.ablations(ledger, policy).collect():
            bit = next(1 << r.bit for r in quality.RULES if r.name == a["rule"])
            assert a["n_docs"] == len(rows) and a["n_failed"] == sum(f & policy.mask != 0 for f in failed)
            assert a["n_failed_without"] == sum(f & policy.mask & ~bit != 0 for f in failed)
            assert a["n_failed_alone"] == sum(f & bit != 0 for f in failed)
    assert quality.rule_ledger(empty).count() == 0 and quality.ablations(quality.rule_ledger(empty), quality.BASE).count() == 0


def test_bits_are_distinct_and_policies_name_known_rules():
    assert len({r.bit for r in quality.RULES}) == len(quality.RULES)
    assert quality.BASE.mask == 0b11 and quality.POLICY_2.mask > quality.POLICY_1.mask


def test_each_rejection_by_one_rule_names_it(odd, empty):
    ledger = quality.rule_ledger(odd).cache()
    policy = quality.POLICY_2
    bits = {1 << r.bit: r.name for r in quality.RULES}
    report = {a["rule"]: a["n_failed"] - a["n_failed_without"] for a in quality.ablations(ledger, policy).collect()}
    rows = quality.with_ablations(ledger, policy).collect()
    assert len(rows) == len(odd_rows()) and any(r["only_rule"] for r in rows)
    for r in rows:
        name = bits.get(r["failed"] & policy.mask)
        assert (r["only_rule"], r["freed_without"]) == ((name, report[name]) if name else (None, None))
    assert quality.with_ablations(quality.rule_ledger(empty), policy).count() == 0
