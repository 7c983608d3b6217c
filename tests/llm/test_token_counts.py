from collections import Counter

from starmill.llm import token_counts as tc


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def test_batches_are_applied_once(spark, frame):
    store = tc.Rollup(spark, tc.new_folder(spark))
    assert totals(store) == {}
    docs = frame([(0, "a b c"), (1, "d e"), (3, None), (6, "f")])
    assert store.commit("load", tc.signed(docs, 1, ["words-1"]))
    want = {("src0", "en", "words-1"): (3, 4), ("src1", "en", "words-1"): (1, 2)}
    assert totals(store) == want
    assert not store.commit("load", tc.signed(docs, 1, ["words-1"]))
    assert totals(store) == want
    again = tc.Rollup(spark, store.folder)  # another session over the same folder
    assert not again.commit("load", tc.signed(docs, 1, ["words-1"])) and totals(again) == want


def test_deletes_and_revisions_add_up(spark, frame):
    store = tc.Rollup(spark, tc.new_folder(spark))
    docs = frame([(0, "a b c"), (3, "d e"), (1, "x-y z")])
    store.commit("1", tc.signed(docs, 1, ["words-1", "words-2"]))
    store.commit("2", tc.revised(docs.filter("doc_id = 0").selectExpr("*", "'a' AS shorter"), "text", "shorter", ["words-1"]))
    store.commit("3", tc.signed(docs.filter("doc_id = 1"), -1, ["words-1", "words-2"]))
    assert totals(store) == {("src0", "en", "words-1"): (2, 3), ("src0", "en", "words-2"): (2, 5)}


def test_files_without_a_manifest_row_do_not_count(spark, frame):
    store = tc.Rollup(spark, tc.new_folder(spark))
    tc.signed(frame([(0, "a")]), 1, ["words-1"]).write.parquet(f"{store.folder}/delta-lost")
    assert totals(store) == {}


def test_compaction_keeps_totals_and_names(spark, frame):
    store = tc.Rollup(spark, tc.new_folder(spark))
    batches = [tc.signed(frame([(k, "a b c")]), 1, ["words-1"]) for k in range(4)]
    for k in range(3):
        store.commit(str(k), batches[k])
    before = totals(store)
    assert store.compact() and totals(store) == before and not store.compact()
    assert len(store._live()) == 1
    assert not store.commit("1", batches[1]) and totals(store) == before
    assert store.commit("3", batches[3]) and len(store._live()) == 2
    after = totals(store)
    assert after["src0", "en", "words-1"] == (2, 6)
    assert store.compact() and totals(store) == after and len(store._live()) == 1


def test_last_lines_are_counted_apart(frame):
    pairs = [(1, "a b\nc-d e"), (2, "a\n"), (3, "x y"), (4, None), (5, "\n\nq")]
    rows = {(r.source, r.tokenizer, r.n, r.n_last) for r in tc.counted(frame(pairs), ["words-1", "words-2"]).collect()}
    assert rows == {
        ("src1", "words-1", 4, 2), ("src1", "words-2", 5, 3), ("src2", "words-1", 1, 0), ("src2", "words-2", 1, 0),
        ("src0", "words-1", 2, 0), ("src0", "words-2", 2, 0), ("src1", "words-1", 0, 0), ("src1", "words-2", 0, 0),
        ("src2", "words-1", 1, 1), ("src2", "words-2", 1, 1),
    }


def test_whole_documents(frame, odd_corpus):
    """Every row counts with its whole text: last lines, copies, repeated and null ids."""
    import re

    want = Counter()
    for i, t in odd_corpus:
        want[f"src{(i or 0) % 3}", "docs"] += 1
        want[f"src{(i or 0) % 3}", "tokens"] += len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    got = Counter()
    for r in tc.corpus_totals(frame(odd_corpus)).filter("tokenizer = 'words-1'").collect():
        got[r.source, "docs"], got[r.source, "tokens"] = r.n_docs, r.n_tokens
    assert got == want
    assert tc.corpus_totals(frame([])).count() == 0


def test_source_of_copies_only_stays(frame):
    out = tc.corpus_totals(frame([(0, "a\nb c"), (1, "a\nb c"), (4, "a\nb c")])).filter("tokenizer = 'words-1'")
    assert {r.source: (r.n_docs, r.n_tokens) for r in out.collect()} == {"src0": (1, 3), "src1": (2, 6)}
