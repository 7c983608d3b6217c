import corpus_pipeline
import pytest
import sentencepiece
from pyspark.sql import functions as F

from starmill.llm import toxicity
from starmill.llm.queries import PIECE_MODEL

from . import test_decontamination as contaminated
from . import test_jaccard_join as near
from . import test_line_dedup as repeated

TOXIC = "vile rotten filth you vile rotten filth and worse filth"


@pytest.fixture(scope="module")
def folder(spark, frame, corpus, tmp_path_factory):
    pairs = corpus + [(500 + k, f"{TOXIC} {k} " * 5) for k in range(30)]
    path, text = str(tmp_path_factory.mktemp("pipeline")), dict(corpus)
    frame(pairs).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i >= 500)) for i, _ in pairs]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, " ".join(text[0].split(" ")[2:20])), (2, "one"), (3, text[31])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, pairs, items


def without_repeats(pairs):
    """Texts without the lines that a document with a smaller id holds."""
    seen, out = {}, []
    for i, t in sorted(pairs):
        kept = []
        for line in (t or "").split("\n"):
            key = repeated.lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) < 10 or seen.setdefault(key, i) == i:
                kept.append(line)
        out.append((i, "\n".join(kept)))
    return out


def test_each_stage_against_brute_force(spark, folder, monkeypatch):
    path, pairs, items = folder
    written, real = {}, corpus_pipeline.stage

    def recorded(df, name):
        written[name] = real(df, name)
        return written[name]

    monkeypatch.setattr(corpus_pipeline, "stage", recorded)
    last = corpus_pipeline.run(spark, path)
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    whole = {r.doc_id: r.asDict() for r in docs.collect()}

    mild = {r.doc_id for r in toxicity.toxicity_scores(docs, labels).filter(F.col("score") < 0.7).collect()}
    want = {"toxicity": [(i, t) for i, t in pairs if i in mild]}
    want["line_dedup"] = without_repeats(want["toxicity"])
    lead = {i: c for i, _, c in near.brute(want["line_dedup"])}
    want["jaccard_join"] = [(i, t) for i, t in want["line_dedup"] if lead[i] == i]
    hit = {r[0] for r in contaminated.brute(want["jaccard_join"], items) if r[-1]}
    want["decontamination"] = [(i, t) for i, t in want["jaccard_join"] if i not in hit]
    sizes = [len(pairs), *map(len, want.values())]
    assert sizes[0] > sizes[1] and sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0  # each stage has work to do
    assert want["toxicity"] != want["line_dedup"]

    assert list(written) == list(want) == [name for name, _ in corpus_pipeline.STAGES[:-1]]
    for name, rows in want.items():
        assert written[name].columns == docs.columns
        got = sorted((r.asDict() for r in written[name].collect()), key=lambda r: r["doc_id"])
        blank = lambda r: r | {"text": r["text"] or ""}
        assert list(map(blank, got)) == [blank(whole[i] | {"text": t}) for i, t in sorted(rows)], name

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL.removeprefix("file://"))
    assert last.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    ids = {i: lib.encode(t) for i, t in want["decontamination"]}
    assert sorted(tuple(r) for r in last.collect()) == sorted((i, len(x), x, True) for i, x in ids.items())
