import hashlib
import re

import pytest

from starmill.llm import decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = []
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        wins += [(None if i is None else str(i), w[k : k + n]) for k in range(len(w) - n + 1) if n]
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, x in wins:
            for k in range(len(w) - len(x) + 1):
                if w[k : k + len(x)] == x:
                    hit.update(range(k, k + len(x)))
                    found.add(item)
        names = sorted(found - {None})
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(corpus):
    t = {i: x for i, x in corpus}
    return [
        (1, " ".join(t[0].split(" ")[2:20])), (10, t[31]), (2, "changed"), (3, "X" * 900), (4, ""), (5, None), (6, "two WORDS!"),
        (None, " ".join(t[1].split(" ")[:12])), (7, t[31]), (2, "one"), (8, t[2] + " no such word"),
    ]


@pytest.fixture
def table(spark):
    return lambda items: spark.createDataFrame(items, "item_id long, text string").repartition(2)


@pytest.mark.parametrize("block", [200_000, 40])
def test_against_brute_force(frame, corpus, items, table, block):
    out = decontamination.contamination_digests(frame(corpus), table(items), block_windows=block)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(corpus, items)


def test_odd_rows(frame, odd_corpus, items, table):
    out = decontamination.contamination_digests(frame(odd_corpus), table(items))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(odd_corpus, items)


def test_empty_tables(frame, corpus, items, table):
    assert decontamination.contamination_digests(frame([]), table(items)).count() == 0
    out = decontamination.contamination_digests(frame(corpus), table([]))
    assert not out.filter("contaminated").count() and out.count() == len(corpus)


def test_clean_rows_stay_as_they_are(frame, corpus, items, table):
    docs = frame(corpus)
    out = decontamination.drop_contaminated(docs, table(items))
    assert out.columns == docs.columns
    clean = {r[0] for r in brute(corpus, items) if not r[-1]}
    assert {r.doc_id for r in out.collect()} == clean
    assert {(r.doc_id, r.text) for r in out.collect()} == {(i, t) for i, t in corpus if i in clean}


def test_windows_with_a_common_shingle(frame, table):
    """All windows hold the same three words; the rest tells them apart."""
    items = [(k, f"a b c w{k} x{k} y{k} z{k} u{k} v{k} t{k}") for k in range(50)]
    docs = [(k, f"start a b c w{k} x{k} y{k} z{k} u{k} v{k} t{k if k % 2 else 99} end") for k in range(50)]
    out = decontamination.contamination_digests(frame(docs), table(items))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(docs, items)
