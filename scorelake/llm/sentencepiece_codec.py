"""SentencePiece encoding and decoding by a batched Viterbi pass.

A text splits at the places that no piece spans (before a run of the word mark), so words are
encoded on their own and each distinct word once per task. Words of equal length advance
together: at every end position all lengths are tried at once for all words, the substring's
hash is looked up among the sorted hashes of the pieces, and the best score gives the back
pointer.

For a unigram model the score of a path is the sum of its pieces' scores, and the maximum is
the segmentation. For a BPE model a path counts only if every two neighbouring pieces are
what merging gives for the two alone; there is exactly one such path, the result of the
merges, so the same pass finds it with the neighbour check as a mask. Pairs are checked once
and remembered. Characters outside the vocabulary become byte pieces (or the unknown piece).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_proto

from scorelake.llm.common import fresh_name, release, text_batches

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_BASE = np.uint64(0x9E3779B97F4A7C15)
_REMEMBERED_BYTES = 32 << 20  # of words and their ids, per Python worker
_WORD_COST = 160  # bytes of memory that a remembered word takes beside its characters and ids
_AT_ONCE = 2_000_000
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = ",.;:!?\"')]}"
_FILTER_BITS = 22
_PAIRS = (1 << 20) - 3
_NEVER = -np.inf


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        proto = model_proto.ModelProto()
        proto.ParseFromString(model)
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        self.bpe = proto.trainer_spec.model_type == model_proto.TrainerSpec.BPE
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.types = np.array([p.type for p in proto.pieces])
        self.unknown = int(np.flatnonzero(self.types == UNKNOWN)[0])
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        fixed = {CONTROL: b"", UNKNOWN: " \u2047 ".encode()}
        shown = [byte_of.get(i, fixed.get(p.type, p.piece.replace(MARK, " ").encode())) for i, p in enumerate(proto.pieces)]
        self.out_length = np.array([len(x) for x in shown], dtype=np.int64)
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out_bytes = np.frombuffer(b"".join(shown), np.uint8)
        usable = [(p.piece, i, p.score) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER)]
        if any(MARK in x.lstrip(MARK) for x, *_ in usable):
            raise ValueError("a piece spans two words")
        self.score_of = {x: s for x, _, s in usable}
        self.id_of = {x: i for x, i, _ in usable}
        self.longest = max((len(x) for x, *_ in usable), default=1)
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(x) for x, *_ in usable if len(x) == 1]] = True
        # line ends part words too where no piece holds one, and so do marks after a letter
        inner = MARK if any("\n" in x for x, *_ in usable) else f"{MARK}\n"
        joined = {b for x, *_ in usable for a, b in zip(x, x[1:]) if b in _MARKS and re.match(f"[{_LETTER}]", a)}
        marks = "".join(re.escape(m) for m in _MARKS if m not in joined)
        letters = f"{MARK}*[{_LETTER}]+(?=[{marks}])|" if marks else ""
        self.word = re.compile(f"{letters}{MARK}*[^{inner}]+|{MARK}+|\n")
        hashes = np.array([self._hash(x) for x, *_ in usable], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.piece = hashes[order], np.array([i for _, i, _ in usable], dtype=np.int64)[order]
        self.scores = np.array([s for *_, s in usable])[order]
        if len(np.unique(self.hashes)) != len(self.hashes):
            raise ValueError("two pieces share a hash")
        self.codes = [np.frombuffer(self.pieces[i].encode("utf-32-le"), np.uint32) for i in self.piece]
        if self.bpe:  # a piece that merging never builds cannot be on the path
            built = np.array([self._merge(self.pieces[i]) == [self.pieces[i]] for i in self.piece])
            self.hashes, self.piece, self.scores = self.hashes[built], self.piece[built], self.scores[built]
            self.codes = [c for c, b in zip(self.codes, built, strict=True) if b]
        self.widest = max(map(len, self.codes), default=1)
        self.lengths = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)  # most substrings are no piece: a bitmap spares them the search
        self.maybe[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True
        self.table = np.zeros((len(self.codes), self.widest), np.uint32)
        for row, code in zip(self.table, self.codes, strict=True):
            row[: len(code)] = code
        self.pair_key, self.pair_fits = np.full(_PAIRS, -1, np.int64), np.zeros(_PAIRS, bool)
        self.words: dict[str, bytes] = {}
        self.spent = 0

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for c in piece:
            value = (value * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def _merge(self, text: str) -> list[str]:
        """The merges of a short string, one best pair at a time."""
        parts = list(text)
        while len(parts) > 1:
            best, at = _NEVER, -1
            for i in range(len(parts) - 1):
                score = self.score_of.get(parts[i] + parts[i + 1], _NEVER)
                if score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of neighbouring pieces as it is; answers stay in a direct-mapped table."""
        key = left * len(self.pieces) + right
        slot = (key * 0x9E3779B1) % len(self.pair_key)
        new = np.flatnonzero(self.pair_key[slot] != key)
        fits = self.pair_fits[slot]
        if len(new):
            distinct, back = np.unique(key[new], return_inverse=True)
            texts = [(self.pieces[k // len(self.pieces)], self.pieces[k % len(self.pieces)]) for k in distinct.tolist()]
            answers = np.array([self._merge(a + b) == [a, b] for a, b in texts])
            fits[new] = answers[back]
            self.pair_key[slot[new]], self.pair_fits[slot[new]] = key[new], fits[new]
        return fits

    def _segment(self, words: list[str]) -> list[list[int]]:
        """Piece ids of words of one length, all advancing together."""
        count, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(count, length)
        best = np.full((count, length + 1), _NEVER)
        best[:, 0] = 0.0
        ends_in = np.full((count, length + 1), -1, np.int64)  # the piece that ends here; -2: a character outside the vocabulary
        width_at = np.zeros((count, length + 1), np.int64)
        rolling = np.zeros((count, 0), np.uint64)  # hashes of the substrings that end at the position before, shortest last
        for end in range(1, length + 1):
            letter = codes[:, end - 1].astype(np.uint64)[:, None] + np.uint64(1)
            rolling = np.concatenate([rolling * _BASE + letter, letter], axis=1)[:, -self.widest :]
            spans = rolling.shape[1]
            row, column = np.nonzero(self.maybe[rolling >> np.uint64(64 - _FILTER_BITS)] & np.isfinite(best[:, end - spans : end]))
            probe = rolling[row, column]
            found = np.minimum(np.searchsorted(self.hashes, probe), len(self.hashes) - 1)
            met = self.hashes[found] == probe
            row, found = row[met], found[met]
            start, width = end - spans + column[met], spans - column[met]
            if len(row):
                window = start[:, None] + np.arange(self.widest)[None, :]
                same = (codes[row[:, None], np.minimum(window, length - 1)] == self.table[found]) | (np.arange(self.widest) >= width[:, None])
                sure = same.all(axis=1) & (self.lengths[found] == width)  # not the hash alone
                row, start, found, width = row[sure], start[sure], found[sure], width[sure]
            piece = self.piece[found]
            before = ends_in[row, start]
            value = best[row, start] + self.scores[found]
            if self.bpe and len(row):
                inner = (start > 0) & (before >= 0)
                fits = np.ones(len(row), bool)
                fits[inner] = self._fit(before[inner], piece[inner])
                row, start, piece, width, value = row[fits], start[fits], piece[fits], width[fits], value[fits]
            order = np.lexsort((width, value, row))  # per word the best last; of equal scores the longest piece
            last = order[np.flatnonzero(np.concatenate([row[order][1:] != row[order][:-1], [True]]))] if len(order) else order
            best[row[last], end], ends_in[row[last], end], width_at[row[last], end] = value[last], piece[last], width[last]
            strange = ~self.single[codes[:, end - 1]]
            alone = strange & ~np.isfinite(best[:, end])
            best[alone, end], ends_in[alone, end], width_at[alone, end] = best[alone, end - 1], -2, 1
        rows, at = np.arange(count), np.full(count, length)
        steps = []  # last pieces first, for all words together
        while len(rows):
            steps.append((rows, ends_in[rows, at], at))
            at = at - width_at[rows, at]
            rows, at = rows[at > 0], at[at > 0]
        result: list[list[int]] = [[] for _ in words]
        for rows, ids, ends in reversed(steps):
            for i, piece, end in zip(rows.tolist(), ids.tolist(), ends.tolist(), strict=True):
                result[i] += self._strange(words[i][end - 1]) if piece == -2 else (piece,)
        return result

    def _strange(self, letter: str) -> list[int]:
        if len(self.bytes) == 256:
            return [self.bytes[b] for b in letter.encode("utf-8", "replace")]
        return [self.unknown]

    def split(self, text: str) -> list[str]:
        """Words that no piece reaches across; joined they are the marked text."""
        if not text:
            return []
        marked = ((" " if self.prefix else "") + text).replace(" ", MARK)
        return self.word.findall(marked)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of every text, none for null and empty ones; the new words of some ``_AT_ONCE`` characters advance together."""
        for some in _runs(texts):
            split = [self.split(t or "") for t in some]
            new: dict[int, set[str]] = {}
            for w in {w for words in split for w in words if w not in self.words}:
                new.setdefault(len(w), set()).add(w)
            for same in new.values():
                self._learn(sorted(same))
            for words in split:
                yield np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32)
            self._forget(new)

    def _learn(self, same: list[str]) -> None:
        for cut in range(0, len(same), 8192):
            some = same[cut : cut + 8192]
            for word, ids in zip(some, self._segment(some), strict=True):
                self.words[word] = np.array(ids, dtype=np.int32).tobytes()

    def _forget(self, new: dict[int, set[str]]) -> None:
        """Keep words learnt in a run, short ones first, as far as the memory for them goes; drop the others."""
        for length in sorted(new):
            for word in new[length]:
                cost = _WORD_COST + length + len(self.words[word])
                if self.spent + cost <= _REMEMBERED_BYTES:
                    self.spent += cost
                else:
                    del self.words[word]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; byte pieces join to characters, control pieces vanish."""
        length = self.out_length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.out_start[ids] - (ends - length), length)
        text = self.out_bytes[at].tobytes().decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _runs(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts of about ``_AT_ONCE`` characters together, at least one."""
    run: list[str | None] = []
    size = 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= _AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


_CODECS: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec per Python worker and model."""
    if model not in _CODECS:
        _CODECS[model] = Codec(model)
    return _CODECS[model]


def encode_documents(docs: DataFrame, model: bytes, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns, ids (the pieces of the whole text), and decoded (the text of those ids).

    Null and empty texts have no ids and decode to the empty text. Decoding gives the text
    back but for characters UTF-8 cannot hold and for the word mark itself, which reads as a
    space. Repeated rows are encoded alike; an empty table gives no rows.
    """
    none = [F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")]
    schema = docs.select(*keep, *none).schema

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(model)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(texts):
                before = int(ends[at - 1]) if at else 0
                last = max(at + 1, int(np.searchsorted(ends, before + _AT_ONCE, "right")))
                ids = list(known.encode(texts.slice(at, last - at).to_pylist()))
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                decoded = pa.array(map(known.decode, ids), pa.string())
                kept = [c.slice(at, last - at) for c in batch.columns[:-1]]
                at = last
                yield pa.RecordBatch.from_arrays([*kept, lists, decoded], names=schema.fieldNames())
        release()

    return text_batches(docs).select(*keep, F.col(text).alias(fresh_name(docs, "__text"))).mapInArrow(convert, schema)
