"""SentencePiece models on the tokenizers library, for batches in many threads."""

from __future__ import annotations

import hashlib
import os
import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.rows import identified, per_worker, pieces, released, table

SPACE = "▁"
#: Fixed values of the model format: piece types, and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Spec:
    """What a model file says, read without the library that wrote it."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def _fields(data: bytes):
    """Number, wire type and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def parse(model: bytes) -> Spec:
    """Pieces, trainer settings and normaliser of a serialised model."""
    spec = Spec()
    for number, value in _fields(model):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            spec.pieces.append((piece, score, kind))
        elif number == 2:
            own = dict(_fields(value))
            spec.model_type = own.get(3, UNIGRAM)
            spec.byte_fallback = bool(own.get(35, 0))
            spec.unk_id = own.get(40, 0)
        elif number == 3:
            own = dict(_fields(value))
            spec.charsmap = own.get(2, b"")
            spec.add_dummy_prefix = bool(own.get(3, 1))
            spec.remove_extra_whitespaces = bool(own.get(4, 1))
            spec.escape_whitespaces = bool(own.get(5, 1))
    return spec


def _merges(spec: Spec) -> list[tuple[str, str]]:
    """Pairs whose join is a piece, best piece first: the order in which the model joins symbols."""
    score = {p: s for p, s, kind in spec.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    place = {p: k for k, (p, _, _) in enumerate(spec.pieces)}
    found = []
    for piece, own in score.items():
        pairs = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in score and piece[k:] in score]
        found += [(-own, place[a], place[b], a, b) for a, b in pairs]
    return [(a, b) for *_, a, b in sorted(found)]


def build(spec: Spec):
    """A ``tokenizers.Tokenizer`` with the normaliser, marker, scores and byte fallback of the model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if spec.model_type == BPE:
        vocab = {p: k for k, (p, _, _) in enumerate(spec.pieces)}
        unk = spec.pieces[spec.unk_id][0]
        model = models.BPE(vocab, _merges(spec), unk_token=unk, fuse_unk=True, byte_fallback=spec.byte_fallback)
    elif spec.model_type == UNIGRAM:
        # Control pieces are never text: under a name with a blank, which the marker replaces, none matches.
        names = [p if kind in (NORMAL, USER_DEFINED, BYTE) else f"{p} {k}" for k, (p, _, kind) in enumerate(spec.pieces)]
        model = models.Unigram([(n, s) for n, (_, s, _) in zip(names, spec.pieces)], spec.unk_id, spec.byte_fallback)
    else:
        raise ValueError(f"model type {spec.model_type} is neither unigram nor BPE")
    tokenizer = Tokenizer(model)
    steps = []
    if spec.charsmap:
        steps.append(normalizers.Precompiled(spec.charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", SPACE))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in spec.pieces):
        # No piece runs on over a marker, so words can be encoded apart (and remembered).
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    back = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if spec.add_dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


#: Distinct words that a worker remembers; beyond that it starts afresh.
REMEMBERED = 1 << 18
#: Words that one thread encodes at a time, and threads of a worker unless RAYON_NUM_THREADS says otherwise.
CHUNK, THREADS = 2048, 2


class Codec:
    """Encoder and decoder of one model, built once per Python worker."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.spec = parse(model)
        self.tokenizer = build(self.spec)
        self.normalizer = self.tokenizer.normalizer
        # Where no piece runs on over a marker, words are encoded apart, each distinct one once.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in self.spec.pieces)
        if self.by_word:
            self.words = Tokenizer(self.tokenizer.model)  # one model in memory, without normaliser and split
        self.split = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.length = np.array([len(self._piece_bytes(*p)) for p in self.spec.pieces], np.int64)
        self._forget()

    def _piece_bytes(self, piece: str, _score: float, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind in (UNKNOWN, CONTROL) else piece.replace(SPACE, " ").encode()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @classmethod
    def of(cls, model: bytes) -> "Codec":
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        return per_worker("pieces", hashlib.sha256(model).digest(), lambda: cls(model))

    def normalize(self, text: str) -> str:
        spec = self.spec
        if spec.charsmap or spec.remove_extra_whitespaces:
            return self.normalizer.normalize_str(text)
        text = " " + text if spec.add_dummy_prefix else text
        return text.replace(" ", SPACE) if spec.escape_whitespaces else text

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many at a time and in many threads."""
        if len(self.known) + len(words) > REMEMBERED:
            self._forget()
        chunks = [words[k : k + CHUNK] for k in range(0, len(words), CHUNK)]
        found = self.words.encode_batch_fast(chunks, is_pretokenized=True, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, np.int32) for e in found])
        # The pieces of a word spell it, so their lengths show where it ends.
        ends = np.cumsum([len(w.replace(SPACE, " ").encode()) for w in words])
        reach = np.cumsum(self.length[flat])
        if (self.length[flat] == 0).any() or reach[-1] != ends[-1]:  # an unknown symbol spells nothing
            apart = [e.ids for e in self.words.encode_batch([[w] for w in words], is_pretokenized=True, add_special_tokens=False)]
            flat, upto = np.concatenate([np.array(x, np.int32) for x in apart]), np.cumsum([len(x) for x in apart])
        else:
            upto = np.searchsorted(reach, ends) + 1
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + upto])

    def encode_arrays(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after another, the offsets of each text, and whether each decodes to itself.

        An empty text has no ids; control pieces written in a text are ordinary text.
        """
        if not self.by_word:
            ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            ids = [x if t else [] for x, t in zip(ids, texts)]
            exact = np.array([a == b for a, b in zip(texts, self.decode(ids))], bool)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            return np.concatenate([np.zeros(0, np.int32), *[np.array(x, np.int32) for x in ids]]), ends, exact
        normal = [self.normalize(t) if t else "" for t in texts]
        split = [self.split.findall(t) for t in normal]
        coded = pa.array([w for x in split for w in x], pa.string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new if len(self.known) + len(new) <= REMEMBERED else words)
        place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        place = place[coded.indices.to_numpy()]
        size = self.ends[place + 1] - self.ends[place]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.ends[place] - ends[:-1], size)]
        of_text = ends[np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)]
        flat, cuts = ids.tolist(), of_text.tolist()
        back = self.decode([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])])
        return ids, of_text, np.array([a == b for a, b in zip(texts, back)], bool)

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, ends, _ = self.encode_arrays(texts)
        return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, read by Spark, so it may lie in any store."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def _texts(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") if b else "" for b in column.to_pylist()]


def _encoded(shared):
    def run(batches):
        codec = Codec.of(shared.value)
        for batch in batches:
            for part in pieces(batch, 1 << 19):
                texts = _texts(part.column("body"))
                ids, ends, exact = codec.encode_arrays(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield table(rid=part.column("rid"), doc_id=part.column("doc_id"), ids=lists, round_trip=exact)

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``rid``, ``doc_id``, ``ids`` and ``round_trip`` (the decoded ids are the text again).

    ``docs`` comes from ``rows.identified``; ``model`` is the path of a model file. Null and
    empty texts have no ids and decode to the empty text. A model that folds characters or
    blanks (or has no byte fallback) cannot give every text back; ``round_trip`` says where.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes(docs.sparkSession, model))
    schema = f"rid long, doc_id {kind}, ids array<int>, round_trip boolean"
    return docs.select("rid", "doc_id", "body").mapInArrow(released(_encoded(shared), "pieces"), schema)


def _decoded(shared, ids_col: str):
    def run(batches):
        codec = Codec.of(shared.value)
        for batch in batches:
            ids = [[int(i) for i in x or []] for x in batch.column(ids_col).to_pylist()]
            yield table(row=batch.column("row"), decoded=pa.array(codec.decode(ids), pa.string()))

    return run


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of its ids (null ids: the empty text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model_bytes(encoded.sparkSession, model))
    wide = encoded.select(F.struct("*").alias("row"), F.col(f"`{ids_col}`").alias("ids"))
    row = wide.schema["row"].dataType.simpleString()
    done = wide.mapInArrow(released(_decoded(shared, "ids"), "pieces"), f"row {row}, decoded string")
    return done.select("row.*", F.col("decoded").alias(out_col))


def token_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_hash`` (64-bit hash of the ids) and ``round_trip`` of every document."""
    coded = encode(identified(docs, id_col, text_col), model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "round_trip"
    )
