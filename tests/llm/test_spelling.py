import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starmill.llm import spelling


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(pairs, every=97):
    n = Counter()
    for i, t in pairs:
        for run in map(lower, re.findall("[A-Za-zÀ-ÿ]+", t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def got(docs, **options):
    rows = spelling.spelling_groups(docs, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r) for r in rows.collect())


@pytest.fixture(scope="module")
def texts():
    """Words with misspellings of misspellings, ties, short words and letters of every range."""
    r = random.Random(3)
    base = ["".join(r.choices("abcdeéÿ×", k=r.randint(4, 9))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * r.randint(1, 40)
        for _ in range(6):
            k = r.randrange(len(w))
            v = r.choice([w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "z" + w[k + 1 :], w[:k] + w[k:][::-1]])
            words += [v] * r.randint(1, 12)
    words += ["chain"] * 64 + ["chaine"] * 32 + ["chainee"] * 16 + ["chaineee"] * 8 + ["chaineeee"] * 4
    r.shuffle(words)
    pairs = [(k, " ".join(words[k : k + 50])) for k in range(0, len(words), 50)]
    return pairs + [(9001, ""), (9002, None), (9003, "日本語 Word Ωmega naïve-été ſhort ÷×÷×÷"), (9004, "ÀÉÎÕÜ àéîõü " * 9)]


def test_against_brute_force(frame, corpus, texts):
    pairs = corpus + texts
    assert got(frame(pairs)) == brute(pairs)
    assert got(frame(pairs), every=3) == brute(pairs, 3)


def test_nulls_repeats_and_long_texts(frame, odd_corpus):
    pairs = odd_corpus + [(None, "wordy words wordy"), (None, "wordy words words"), (70, ("longish words " * 90000) + "x" * 2_000_000)]
    assert got(frame(pairs)) == brute(pairs)


def test_empty_tables(frame):
    assert got(frame([])) == [] and got(frame([(1, None), (2, "a b c")])) == []


def test_blocks_cut_into_tiles_give_the_same_pairs(spark):
    r = random.Random(5)
    words = sorted({"".join(r.choices("abc", k=r.randint(5, 7))) for _ in range(500)})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    want = sorted((v, w) for v in words for w in words if one_edit(v, w))
    for tile in (7, 100, 2048):
        assert sorted((x.word, x.near) for x in spelling.near_words(df, tile=tile).collect()) == want


def test_very_long_words_and_large_counts(spark):
    words = ["x" * 30000, "x" * 30001, "x" * 15000 + "y" + "x" * 14999, "y" + "x" * 29999, "ab" * 10000]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    want = sorted((a, b) for a in range(5) for b in range(5) if one_edit(words[a], words[b]))
    assert sorted((words.index(x.word), words.index(x.near)) for x in spelling.near_words(df).collect()) == want


def test_distance_of_one_edit_is_at_most_two():
    counts = np.eye(4, dtype=np.float32)[[0, 1, 0]] + 1
    i, j = spelling._products(counts, np.arange(3), np.arange(3))
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(3) for b in range(3)}
