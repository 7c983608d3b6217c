import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from starmill.llm import token_files
from starmill.llm.queries import WORD_MODEL

ODD = [
    "Plain words, plain words; it's WE'LL don't", "tab\tnew\nline\x0bvt\x0cff\r\nend", " lead and trail  ", "", None, " nbsp em",
    "a\x00b \x1c\x1d\x85 next", "é ́x 가 ﬁ", "<|endoftext|> x<|startoftext|>y <|endof text|>", "ΑΣ Σ İ ẞ", "日本語 テキスト 漢字",
    "Arí, É. ÑandÚ! ÿ? ×, ÷. a×, ß; ẞ; Ǳ, ĳ. ﬀ,", "É́, E\u0301, é\u0323.", "A-b, c_d 'tis \"quoted\" (x) J\u030C \u212b \u1f71", "12345 6.7e8", "😀👍🏽 ok", "z" * 30000, "word " * 4000, "'s 's't ''re", " \t ",
]


def brute(pairs):
    """The library on whole texts, in order of the ids."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for i, t in sorted(pairs, key=lambda p: p[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(df, tmp_path, **layout):
    path = f"file://{tmp_path}/out"
    token_files.write_tokens(df, WORD_MODEL, path, layout=token_files.Layout(**layout))
    return path


def got(spark, path):
    return sorted(tuple(r) for r in token_files.token_checks(spark, path).collect())


@pytest.mark.parametrize("ids", ["dictionary", "delta"])
def test_against_the_library_on_whole_texts(spark, frame, corpus, tmp_path, ids):
    pairs = corpus + [(1000 + k, t) for k, t in enumerate(ODD)]
    assert got(spark, written(frame(pairs), tmp_path, ids=ids)) == brute(pairs)


def test_repeated_and_null_ids_are_rows_of_their_own(spark, frame, odd_corpus, tmp_path):
    path = written(frame(odd_corpus), tmp_path)
    rows = token_files.token_checks(spark, path).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == sorted([i for i, _ in odd_corpus if i is not None]) + [None] * 3
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    alone = {(i, n, c) for i, _, n, c in brute([(i, t) for i, t in odd_corpus if i is not None])}
    assert alone == {(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows if r.doc_id is not None}


def test_empty_table(spark, frame, tmp_path):
    path = written(frame([]), tmp_path)
    assert got(spark, path) == [] and token_files.read_token_range(spark, path, 0, 5).count() == 0


def test_one_id_in_a_third_of_the_rows_is_split(spark, frame, tmp_path):
    pairs = [(5 if k % 3 else k, f"text number {k % 7}") for k in range(900)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        path = written(frame(pairs), tmp_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(f"{path}/tokens").filter("doc_id = 5").select("part").distinct().count()
    assert parts > 2 and spark.read.parquet(f"{path}/tokens").count() == 900


@pytest.mark.parametrize("kind,encoding", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_layout(spark, frame, tmp_path, kind, encoding):
    r = np.random.default_rng(1)
    pairs = [(k, " ".join(map(str, r.integers(0, 10**6, 150)))) for k in range(3000)]
    path = written(frame(pairs).coalesce(1), tmp_path, ids=kind, row_group=128 << 10, page=16 << 10, page_rows=64)
    files = glob.glob(path.removeprefix("file://") + "/tokens/*.parquet")
    metas = [pq.ParquetFile(f).metadata for f in files]
    assert sum(m.num_row_groups for m in metas) > len(files)  # controlled row groups
    columns = {m.row_group(0).column(c).path_in_schema: m.row_group(0).column(c) for m in metas for c in range(m.num_columns)}
    assert encoding in columns["ids.list.element"].encodings
    for name in ("doc_id", "place", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in columns[name].encodings and not columns[name].has_dictionary_page
    assert all(c.has_offset_index and c.has_column_index for n, c in columns.items() if n == "doc_id")


def test_selective_reads(spark, frame, corpus, tmp_path):
    path = written(frame(corpus), tmp_path)
    whole = [i for r in token_files.read_tokens(spark, path).orderBy("start").collect() for i in r.ids]
    for a, b in [(0, 1), (0, len(whole)), (17, 400), (len(whole) - 5, len(whole) + 9), (300, 300), (len(whole) + 1, len(whole) + 2)]:
        rows = token_files.read_token_range(spark, path, a, b).orderBy("start").collect()
        assert [i for r in rows for i in r.ids] == whole[a:b]
    only = token_files.read_tokens(spark, path, ["doc_id", "start"])
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0] and only.count() == len(corpus)
    one = token_files.read_tokens(spark, path).filter("doc_id = 7")
    assert "EqualTo(doc_id,7)" in one._jdf.queryExecution().executedPlan().toString()
