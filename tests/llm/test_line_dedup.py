import hashlib

from starmill.llm import line_dedup


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(pairs):
    """Rows in id order, nulls last; equal ids are documents of their own."""
    docs = sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0))
    first, holders = {}, {}
    for k, (_, t) in enumerate(docs):
        for line in (t or "").split("\n"):
            key = lower(line.strip(" \t\n\x0b\x0c\r"))
            first.setdefault(key, k)
            holders.setdefault(key, set()).add(k)
    out = []
    for k, (i, t) in enumerate(docs):
        lines = (t or "").split("\n")
        keys = [lower(x.strip(" \t\n\x0b\x0c\r")) for x in lines]
        kept = [x for x, y in zip(lines, keys) if not (len(y) >= 10 and first[y] < k)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=repr)


def test_against_brute_force(frame, corpus):
    assert got(line_dedup.line_digests(frame(corpus))) == sorted(brute(corpus), key=repr)


def test_line_numbers_beyond_a_byte_of_the_map(frame):
    pairs = [(1, "\n".join(f"line number {k}" for k in range(20))), (2, "\n".join(f"LINE number {k} " for k in range(5, 40)))]
    assert got(line_dedup.line_digests(frame(pairs))) == sorted(brute(pairs), key=repr)


def test_repeated_and_null_ids(frame, odd_corpus):
    """Which of two rows with one id comes first is open, so only counts are compared."""
    counts = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines) for r in line_dedup.line_digests(frame(odd_corpus)).collect())
    assert counts == sorted((i is None, i or 0, n) for i, n, _, _ in brute(odd_corpus))
    total = sum(r.n_dropped for r in line_dedup.line_digests(frame(odd_corpus)).collect())
    assert total == sum(n for _, _, n, _ in brute(odd_corpus))


def test_empty_table(frame):
    assert line_dedup.line_digests(frame([])).count() == 0


def test_rewritten_rows_keep_columns(frame, corpus):
    docs = frame(corpus)
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(corpus)
    texts = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in out.collect()}
    assert texts == {i: h for i, _, _, h in brute(corpus)}


def test_one_line_in_every_document(frame):
    pairs = [(k, "the very same line\nown line of number %d" % k) for k in range(300)]
    assert got(line_dedup.line_digests(frame(pairs))) == sorted(brute(pairs), key=repr)
