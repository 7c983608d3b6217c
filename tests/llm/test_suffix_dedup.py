import hashlib
from collections import Counter

import numpy as np

from starmill.llm import suffix_dedup


def brute(pairs):
    texts = [(i, (t or "").encode()) for i, t in pairs]
    seen = Counter(b[k : k + 200] for _, b in texts for k in range(len(b) - 199))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_brute_force(frame, corpus):
    assert got(suffix_dedup.suffix_digests(frame(corpus))) == brute(corpus)


def test_repeated_and_null_ids(frame, odd_corpus):
    assert got(suffix_dedup.suffix_digests(frame(odd_corpus))) == brute(odd_corpus)


def test_empty_table(frame):
    assert suffix_dedup.suffix_digests(frame([])).count() == 0
    assert got(suffix_dedup.suffix_digests(frame([(1, None), (2, "")]))) == brute([(1, None), (2, "")])


def test_edges_of_a_shared_passage(frame):
    """Every length around the limit, at every place, in different surroundings."""
    import random

    r = random.Random(3)
    letters = lambda n: "".join(r.choices("abcdefgh ", k=n))
    passage = letters(260)
    pairs = [(k, letters(r.randint(0, 300)) + passage[k % 30 : 195 + k] + letters(r.randint(0, 300))) for k in range(60)]
    assert got(suffix_dedup.suffix_digests(frame(pairs))) == brute(pairs)


def test_copies_that_end_their_texts(frame):
    """Passages at the very begin and end of texts, with ids and offsets in arithmetic rows."""
    import random

    r = random.Random(9)
    passage = "".join(r.choices("abcdefgh ", k=400))
    pairs = [(19 * k, "x" * (21 * (k % 7)) + passage[k % 40 :]) for k in range(120)]
    pairs += [(5000 + 21 * k, passage[: 400 - 19 * (k % 5)] + "".join(r.choices("pq", k=k % 9))) for k in range(120)]
    assert got(suffix_dedup.suffix_digests(frame(pairs))) == brute(pairs)


def test_long_text_of_one_letter(frame):
    pairs = [(1, "a" * 700_000), (2, "b" * 199), (3, "b" * 200), (4, "b" * 201)]
    rows = {r.doc_id: r for r in suffix_dedup.suffix_digests(frame(pairs)).collect()}
    assert (rows[1].n_removed, rows[1].n_spans) == (700_000, 1)
    assert [rows[k].n_removed for k in (2, 3, 4)] == [0, 200, 201]


def test_cover_depends_on_the_string_alone():
    """Equal strings are stood for by the same place within them, across blocks too."""
    r = np.random.default_rng(1)
    shared = r.integers(97, 101, 900_000).astype(np.uint8)
    for front in (0, 7, 300_001):
        raw = np.concatenate([r.integers(97, 101, front).astype(np.uint8), shared])
        found = suffix_dedup.cover(raw, np.array([0, len(raw)]))
        inside = {
            (a - front, lo - front, hi - front)
            for a, lo, hi in zip(found["at"].tolist(), found["low"].tolist(), found["high"].tolist()) if lo >= front + 1000
        }
        places = {}
        for a, lo, hi in inside:
            places.update({p: a for p in range(lo, hi + 1)})
        if front == 0:
            want = {p: a for p, a in places.items()}
        else:
            assert all(want[p] == a for p, a in places.items() if p in want)
