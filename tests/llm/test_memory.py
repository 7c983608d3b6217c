"""What Python workers hold, while a task runs and after it."""

import platform
import tracemalloc
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from starmill.llm import jaccard_join, line_dedup, rows, sentencepiece_codec, toxicity


def peak(run, batch) -> int:
    """Most bytes that numpy and Python hold at a time while the batch goes through."""
    list(run(iter([batch])))
    tracemalloc.start()
    for _ in run(iter([batch])):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


@pytest.fixture(scope="module")
def batch():
    rng = np.random.default_rng(5)
    lines = [" ".join(f"word{x}" for x in rng.integers(0, 1 << 20, 8)) for _ in range(60_000)]
    body = ["\n".join(lines[k : k + 30]).encode() for k in range(0, len(lines), 30)]
    ids = np.arange(len(body))
    return pa.RecordBatch.from_pydict({"rid": ids, "body": pa.array(body, pa.binary()), "label": (ids % 2).astype(np.int32)})


def test_a_batch_takes_few_times_its_text(batch):
    text = sum(len(b) for b in batch.column("body").to_pylist())
    assert peak(jaccard_join._fingerprints, batch) < 2.8 * text
    assert peak(line_dedup._occurrences(10), batch) < 1.75 * text
    assert peak(toxicity._counts(12), batch) < 2 * text


def test_tokens_that_a_batch_holds_often():
    texts = [b"a b c d e f", b"a b c d e", b"x a b c d e", b"a b c d e g", b"b c d e f", b"", None]
    for n in (1, 3, 7):
        part = pa.RecordBatch.from_pydict({"rid": np.arange(n), "body": pa.array(texts[:n], pa.binary())})
        held = [r for out in jaccard_join._fingerprints([part]) for r in out.to_pylist() if r["token"] is not None]
        assert [r["count"] for r in held] == ([4] if n == 7 else [])


def test_a_worker_gives_back_what_a_task_held():
    status = Path("/proc/self/statm")
    if platform.libc_ver()[0] != "glibc" or not status.exists():
        pytest.skip("needs glibc")

    def resident() -> float:
        return int(status.read_text().split()[1]) * 4096 / 1e6

    kept = []

    def run(_):
        many = [np.ones(8_000) for _ in range(3_000)]  # 192 MB, each too small for a mapping of its own
        kept.append(many[-1])  # the end of the heap stays in use
        yield resident()

    before = resident()
    (during,) = rows.released(run)(iter([]))
    assert during > before + 150
    assert resident() < before + 60


def test_a_worker_keeps_what_it_built_only_for_the_same_step():
    made = []

    def run(_):
        yield rows.per_worker("tables", b"1", lambda: made.append(1) or len(made))

    other = rows.released(lambda _: iter(()))
    assert [*rows.released(run, "tables")(None), *rows.released(run, "tables")(None)] == [1, 1]
    list(other(None))
    assert list(rows.released(run, "tables")(None)) == [2]


def test_pieces_are_built_once_for_all_tasks(monkeypatch):
    built = []

    class Counted(sentencepiece_codec.Codec):
        def __init__(self, model):
            built.append(model)

        def encode_arrays(self, texts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), np.ones(len(texts), bool)

    monkeypatch.setattr(sentencepiece_codec, "Codec", Counted)
    one = pa.RecordBatch.from_pydict({"rid": [1], "doc_id": [1], "body": pa.array([b""], pa.binary())})
    run = rows.released(sentencepiece_codec._encoded(SimpleNamespace(value=b"model")), "pieces")
    assert list(run([one])) and list(run([one])) and built == [b"model"]
    list(rows.released(lambda _: iter(()))(None))  # another step: the worker holds no pieces meanwhile
    assert list(run([one])) and len(built) == 2
