"""Token-id files with an adaptive context-mixing range coder.

A file holds the ids of a run of documents, cut into blocks of ``BLOCK`` ids. Each id is coded
by mixing three predictions: the id last seen after the two ids before (order 2), the id last
seen after the one before (order 1), and the frequencies of ids in the file (order 0). How far
the first two are trusted is learnt while coding, by how often they were right at the same
confidence. Model and coder start afresh in every block, so a block is read on its own; each
has a checksum. The blocks of a file advance together, one numpy step per id position.

Layout: magic, header length, header (zlib-packed JSON: documents, blocks, checksums, id
counts), then the 16-bit code words of all blocks. Files follow each other in ascending key
order; a task writes one every ``FILE_IDS`` ids, so its memory does not grow with its input,
and the number of tasks follows the cluster, not the table.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorelake.llm.common import default_partitions, release, stored, text_batches

MAGIC = b"TIDS0002"
BLOCK = 1024
FILE_IDS = 5 << 20  # its blocks advance together, so more of them share the cost of a step
PARTITION_BYTES = 24 << 20
TASKS_PER_PARTITION = 8  # of the session's shuffle partitions, at most
SLOTS = 1024  # of a context table, per block
MIX_BITS = 12
LEAST_BITS = 20  # of the frequencies of a file; more where it has more distinct ids
_SURE = (1 << MIX_BITS) - 32
_FULL = np.uint64(1 << 48)
_TOP = np.uint64((1 << 64) - 1)
_MIX, _SHIFT, _FIRST = np.uint64(MIX_BITS), np.uint64(16), np.uint64(48)
_AT_ONCE = 10 << 20  # bytes of text whose words are looked up together
_REMEMBERED_BYTES = 48 << 20
_WORD_COST = 190  # bytes of memory that a remembered piece takes beside its characters and ids
_JOINED = 512


class Model:
    """The predictions of every block at one id position, for encoder and decoder alike."""

    def __init__(self, blocks: int):
        self.base, self.mixes = np.arange(blocks) * SLOTS, np.arange(blocks) * 32
        self.one, self.two = np.zeros(blocks * SLOTS, np.int32), np.zeros(blocks * SLOTS, np.int32)  # id << 2 | confidence
        confidence = np.arange(32)
        start2, start1 = np.array([40, 1200, 2400, 3600])[confidence >> 3], np.array([40, 500, 1000, 1800])[(confidence >> 1) & 3]
        self.trust = np.tile((start2 << MIX_BITS | start1).astype(np.int32), blocks)
        self.mixed, self.older, self.last = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the first n blocks: the ids of order 2 and 1, and the shares given to them."""
        mixed = self.mixed[:n]
        self.at1 = self.base[:n] + (mixed >> 1 & SLOTS - 1)
        self.at2 = self.base[:n] + ((mixed ^ self.older[:n]) & SLOTS - 1)
        self.entry1, self.entry2 = self.one.take(self.at1), self.two.take(self.at2)
        self.id1, self.id2 = self.entry1 >> 2, self.entry2 >> 2
        self.context = self.mixes[:n] + ((self.entry2 & 3) << 3 | (self.entry1 & 3) << 1 | (self.id1 == self.id2))
        trust = self.trust.take(self.context)
        self.share2, self.share1 = trust >> MIX_BITS, trust & (1 << MIX_BITS) - 1
        return self.id2, self.id1, self.share2, np.maximum(((1 << MIX_BITS) - self.share2) * self.share1 >> MIX_BITS, 1)  # a share of 0 could not be coded

    def update(self, n: int, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        share2 = self.share2 + (np.where(hit2, np.int32(_SURE), np.int32(32)) - self.share2 >> 4)
        share1 = self.share1 + np.where(hit2, np.int32(0), np.where(hit1, np.int32(_SURE), np.int32(32)) - self.share1 >> 4)
        self.trust[self.context] = share2 << MIX_BITS | share1
        fresh = ids << 2 | 1
        for table, at, entry, known in ((self.one, self.at1, self.entry1, self.id1), (self.two, self.at2, self.entry2, self.id2)):
            sure = entry & 3
            table[at] = np.where(known == ids, entry + (sure < 3), np.where(sure > 0, entry - 1, fresh))
        np.multiply(self.last[:n], 77, out=self.older[:n])
        self.last[:n] = ids
        np.multiply(self.last[:n], 403, out=self.mixed[:n])


def _frequencies(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Cumulative frequencies (first 0, last 1 << bits), at least 1 each, and bits."""
    bits = max(LEAST_BITS, len(counts).bit_length() + 2)
    if bits > 32:
        raise ValueError("more distinct ids in a file than the coder can tell apart")
    spare = (1 << bits) - len(counts)
    ends = np.cumsum(counts.astype(np.float64))
    scaled = np.floor(ends * (spare / max(ends[-1], 1.0))).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
    scaled[-1:] = spare
    return np.concatenate([[0], np.minimum(scaled, spare) + np.arange(1, len(counts) + 1)]).astype(np.uint64), bits


def encode_blocks(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 16-bit words of all blocks and how many each has; ids are places in the frequency table."""
    cumulative, bits = _frequencies(counts)
    frequency = np.uint64(bits)
    sizes = np.diff(cumulative)
    blocks = -(-len(ids) // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.int32)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    last = len(ids) - (blocks - 1) * BLOCK
    model = Model(blocks)
    low, width = np.zeros(blocks, np.uint64), np.full(blocks, _TOP)
    room = BLOCK * (MIX_BITS + bits) // 16 + 16
    first = np.arange(blocks) * room
    out, at = np.zeros(blocks * room, np.uint16), first.copy()

    def carry(some: np.ndarray) -> None:
        """One more in the words written last, as far as it carries."""
        place = at[some] - 1
        while len(place):
            out[place] += np.uint16(1)
            place = place[out[place] == 0] - 1

    def emit(some: np.ndarray) -> None:
        out[at[some]] = low[some] >> _FIRST
        at[some] += 1
        low[some] <<= _SHIFT
        width[some] <<= _SHIFT

    for step in range(BLOCK):
        n = blocks if step < last else blocks - 1
        if not n:
            break
        now = grid[step, :n]
        id2, id1, share2, share1 = model.predict(n)
        hit2 = now == id2
        hit1 = (now == id1) & ~hit2
        plain = np.flatnonzero(~(hit2 | hit1))
        both = share2 + share1
        start = np.where(hit2, np.int32(0), np.where(hit1, share2, both))
        size = np.where(hit2, share2, np.where(hit1, share1, (1 << MIX_BITS) - both))
        unit = width[:n] >> _MIX
        moved = low[:n] + start.astype(np.uint64) * unit
        over = np.flatnonzero(moved < low[:n])
        low[:n] = moved
        np.multiply(unit, size.astype(np.uint64), out=width[:n])
        if len(over):
            carry(over)
        if len(plain):
            mine = now[plain]
            unit = width[plain] >> frequency
            old = low[plain]
            moved = old + cumulative[mine] * unit
            low[plain] = moved
            width[plain] = unit * sizes[mine]
            over = plain[moved < old]
            if len(over):
                carry(over)
        short = np.flatnonzero(width[:n] < _FULL)
        while len(short):
            emit(short)
            short = short[width[short] < _FULL]
        model.update(n, now, hit2, hit1)
    every = np.arange(blocks)
    ended = (low + np.uint64((1 << 32) - 1)) >> np.uint64(32) << np.uint64(32)  # within the width, whatever words follow
    over = np.flatnonzero(ended < low)
    low[:] = ended
    carry(over)
    emit(every)
    emit(every)
    lengths = at - first
    return out.reshape(blocks, room)[np.arange(room) < lengths[:, None]], lengths


def decode_blocks(words: np.ndarray, lengths: np.ndarray, total: int, counts: np.ndarray) -> np.ndarray:
    """The ids of all blocks, as places in the frequency table."""
    cumulative, bits = _frequencies(counts)
    frequency, most = np.uint64(bits), np.uint64((1 << bits) - 1)
    sizes = np.diff(cumulative)
    table = np.repeat(np.arange(len(counts), dtype=np.int32), sizes.astype(np.int64))
    blocks = len(lengths)
    words = np.concatenate([words, np.zeros(8, words.dtype)])
    limit = len(words) - 1
    grid = np.zeros((BLOCK, blocks), np.int32)
    last = total - (blocks - 1) * BLOCK
    model = Model(blocks)
    at = np.cumsum(lengths) - lengths
    value = np.zeros(blocks, np.uint64)
    for _ in range(4):
        value = value << _SHIFT | words[np.minimum(at, limit)]
        at = at + 1
    width = np.full(blocks, _TOP)
    for step in range(BLOCK):
        n = blocks if step < last else blocks - 1
        if not n:
            break
        id2, id1, share2, share1 = model.predict(n)
        both = share2 + share1
        unit = width[:n] >> _MIX
        place = np.minimum(value[:n] // unit, np.uint64((1 << MIX_BITS) - 1)).astype(np.int32)
        hit2 = place < share2
        hit1 = ~hit2 & (place < both)
        plain = np.flatnonzero(place >= both)
        now = np.where(hit2, id2, id1)
        start = np.where(hit2, np.int32(0), np.where(hit1, share2, both))
        size = np.where(hit2, share2, np.where(hit1, share1, (1 << MIX_BITS) - both))
        value[:n] -= start.astype(np.uint64) * unit
        np.multiply(unit, size.astype(np.uint64), out=width[:n])
        if len(plain):
            unit = width[plain] >> frequency
            mine = value[plain]
            found = table.take(np.minimum(mine // np.maximum(unit, np.uint64(1)), most).astype(np.int64))
            now[plain] = found
            value[plain] = mine - cumulative[found] * unit
            width[plain] = unit * sizes[found]
        short = np.flatnonzero(width[:n] < _FULL)
        while len(short):
            value[short] = value[short] << _SHIFT | words[np.minimum(at[short], limit)]  # damaged words may ask for more than there are
            at[short] += 1
            width[short] = np.maximum(width[short], np.uint64(1)) << _SHIFT
            short = short[width[short] < _FULL]
        model.update(n, now, hit2, hit1)
        grid[step, :n] = now
    return np.ascontiguousarray(grid.T).reshape(-1)[:total]


def _places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids in order, the place of each id among them, and their counts."""
    if len(ids) and int(ids.max()) < 1 << 22:
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        rank = np.zeros(len(counts), np.int32)
        rank[values] = np.arange(len(values), dtype=np.int32)
        return values, rank[ids], counts[values]
    values, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
    return values.astype(np.int64), places, counts


def pack(keys: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A file of documents with these keys and lengths, whose ids follow each other."""
    values, places, counts = _places(ids)
    words, sizes = encode_blocks(places, counts) if len(ids) else (np.zeros(0, np.uint16), np.zeros(0, np.int64))
    plain = memoryview(ids.astype("<u4", copy=False)).cast("B")
    sums = [zlib.crc32(plain[b : b + 4 * BLOCK]) for b in range(0, len(plain), 4 * BLOCK)]
    header = {"keys": keys, "lengths": lengths, "ids": len(ids), "words": sizes.tolist(), "sums": sums, "values": np.diff(values, prepend=0).tolist(), "counts": counts.tolist()}
    packed = zlib.compress(json.dumps(header, separators=(",", ":")).encode(), 3)
    return b"".join((MAGIC, len(packed).to_bytes(8, "little"), packed, words.astype("<u2", copy=False).tobytes()))


def unpack(data: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    """Keys, lengths and ids of a file; an error if a block does not match its checksum."""
    if data[:8] != MAGIC:
        raise ValueError("not a token-id file")
    size = int.from_bytes(data[8:16], "little")
    header = json.loads(zlib.decompress(data[16 : 16 + size]))
    lengths = np.array(header["words"], dtype=np.int64)
    if len(data) - 16 - size != 2 * int(lengths.sum()):
        raise ValueError("a token-id file is cut off")
    words = np.frombuffer(data[16 + size :], "<u2")
    ids = np.zeros(0, np.uint32)
    if header["ids"]:
        places = decode_blocks(words, lengths, header["ids"], np.array(header["counts"]))
        ids = np.cumsum(header["values"]).astype(np.uint32)[places]
    plain = memoryview(ids.astype("<u4", copy=False)).cast("B")
    for block, known in enumerate(header["sums"]):
        if zlib.crc32(plain[4 * BLOCK * block : 4 * BLOCK * (block + 1)]) != known:
            raise ValueError(f"block {block} of a token-id file is damaged")
    return header["keys"], header["lengths"], ids


class Words:
    """A tokenizer whose pieces never span a space or line end, with a bounded memory of word pieces.

    Each distinct word of a run of texts is encoded once. Words of plain letters, digits and
    punctuation are lower-cased and parted by the tokenizer's own pattern first, and the parts
    encoded by its model, many joined by spaces at a time; all others go through the
    whole tokenizer, one by one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the threads
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        pattern, ends = _pattern(told)
        self.parts = regex.compile(f"{pattern}| ") if pattern else None
        self.plain = "^[!-~¡-¬®-į]*$"  # lower case of these is theirs alone, and they compose with nothing
        self.letters = "^[A-Za-zÀ-ÖØ-öø-į]+$"
        self.special = [a["content"] for a in told.get("added_tokens") or []]
        self.known: dict[str, bytes] = {}
        self.spent, self.full = 0, False
        if self.parts:
            told["normalizer"], told["added_tokens"] = None, []
            told["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
            self.model = Tokenizer.from_str(json.dumps(told))
            vocabulary = told["model"]["vocab"]
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(ends)]] = True

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of texts: how many ids each text has, and all ids."""
        texts = pc.fill_null(texts, "")
        size = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
        start = 0
        while start < len(texts):
            end = max(start + 1, int(np.searchsorted(size, size[start] + _AT_ONCE, "right")) - 1)
            yield self._run(texts.slice(start, end - start))
            start = end

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        flat = words.flatten().dictionary_encode()
        places, lists = self._lookup(flat.dictionary)
        found = lists.take(pa.array(places[flat.indices.to_numpy()]))
        offsets = words.offsets.to_numpy()
        ends = found.offsets.to_numpy()[offsets - offsets[0]]
        return np.diff(ends), found.values.to_numpy()[ends[0] : ends[-1]]

    def _lookup(self, words: pa.StringArray) -> tuple[np.ndarray, pa.ListArray]:
        """The ids of distinct words: the place of each in a list array."""
        kind = np.full(len(words), 2)  # 0: letters alone, one part; 1: plain; 2: all others
        if self.parts:
            plain = pc.match_substring_regex(words, self.plain)
            for special in self.special:
                plain = pc.and_not(plain, pc.match_substring(words, special))
            kind[plain.to_numpy(zero_copy_only=False)] = 1
            kind[pc.match_substring_regex(words, self.letters).to_numpy(zero_copy_only=False)] = 0
        order = np.argsort(kind, kind="stable")
        places = np.empty(len(words), np.int64)
        places[order] = np.arange(len(words))
        letters, plain, others = (words.take(pa.array(order[a:b])) for a, b in pairwise([0, *np.cumsum(np.bincount(kind, minlength=3)).tolist()]))
        whole = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) for w in others.to_pylist()]
        lists = [self._parted(part) for part in (pc.utf8_lower(letters).dictionary_encode(), plain) if len(part)]
        return places, pa.concat_arrays([*lists, pa.array(whole, pa.list_(pa.uint32()))])

    def _parted(self, words: pa.StringArray | pa.DictionaryArray) -> pa.ListArray:
        """The ids of every plain word: all are parted in one scan (unless they are parts already), and each distinct part is encoded once."""
        single = isinstance(words, pa.DictionaryArray)
        parts = words if single else pa.array(self.parts.findall(_joined(words, " ").lower()), pa.string()).dictionary_encode()
        distinct = _joined(parts.dictionary, "\n").split("\n") if len(parts) else []
        found = list(map(self.known.get, distinct))
        missing = np.fromiter((ids is None for ids in found), bool, len(found))
        space = distinct.index(" ") if " " in distinct else -1
        if space >= 0:
            missing[space] = False
            found[space] = b""
        old, new = np.flatnonzero(~missing), np.flatnonzero(missing)
        learnt, cuts = self._learn([distinct[i] for i in new.tolist()])
        self._remember(distinct, new, learnt, cuts)
        known = [ids for ids in found if ids is not None]
        ends = np.cumsum(np.fromiter(map(len, known), np.int64, len(known)) >> 2)
        every = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], ends, cuts[1:] + (ends[-1] if len(ends) else 0)]).astype(np.int32)),
            pa.array(np.concatenate([np.frombuffer(b"".join(known), "<u4"), learnt])),
        )
        places = np.empty(len(distinct), np.int64)
        places[old], places[new] = np.arange(len(old)), np.arange(len(old), len(distinct))
        codes = parts.indices.to_numpy()
        taken = every.take(pa.array(places[codes]))
        if single:
            return taken
        breaks = np.flatnonzero(codes == space)
        cuts = taken.offsets.to_numpy()[np.concatenate([[0], breaks, [len(codes)]])]
        return pa.ListArray.from_arrays(pa.array(cuts), taken.values)

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts and where each part begins and ends; many are joined by spaces at a time, the mark of a part's last piece tells them apart."""
        ids, counts = [np.zeros(0, "<u4")], []
        for cut in range(0, len(parts), _JOINED * 16):
            runs = [parts[a : a + _JOINED] for a in range(cut, min(cut + _JOINED * 16, len(parts)), _JOINED)]
            for run, encoding in zip(runs, self.model.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False), strict=True):
                found = np.array(encoding.ids, dtype="<u4")
                ends = np.flatnonzero(self.ends[found]) + 1
                if len(ends) != len(run):
                    raise ValueError("a part of a word has more than one end")
                ids.append(found)
                counts.append(np.diff(ends, prepend=0))
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)

    def _remember(self, distinct: list[str], new: np.ndarray, learnt: np.ndarray, cuts: np.ndarray) -> None:
        """Keep learnt parts, as far as the bound on bytes goes."""
        if self.full:
            return
        plain = learnt.tobytes()
        for at, start, end in zip(new.tolist(), (cuts[:-1] * 4).tolist(), (cuts[1:] * 4).tolist(), strict=True):
            cost = _WORD_COST + len(distinct[at]) + end - start
            self.full = self.spent + cost > _REMEMBERED_BYTES
            if self.full:
                break
            self.spent += cost
            self.known[distinct[at]] = plain[start:end]


def _joined(texts: pa.StringArray, by: str) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), by)[0].as_py()


def _pattern(told: dict) -> tuple[str | None, str]:
    """The pattern that parts words and the mark of a part's last piece, where the tokenizer is of the kind that ``Words`` can take apart."""
    steps = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    rules = [n.get("type") for n in (told.get("normalizer") or {}).get("normalizers") or []]
    suffix = told["model"].get("end_of_word_suffix")
    kinds = [s.get("type") for s in steps]
    fits = kinds == ["Split", "ByteLevel"] and steps[0].get("invert") and steps[0].get("behavior") == "Removed" and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
    if fits and suffix and rules == ["NFC", "Replace", "Lowercase"] and "Regex" in steps[0]["pattern"] and not told.get("post_processor"):
        return steps[0]["pattern"]["Regex"], suffix
    return None, ""


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches together, until their texts make one run of words."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= _AT_ONCE:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


_WORDS: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """One tokenizer per Python worker and path."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, append ``end_id``, and write the ids in ascending key order (null keys first).

    Returns the stored list of files: part, seq, file, ids, documents; files follow each other
    by part and seq. Null and empty texts have the end id alone. Rows that repeat a key (or
    have none) may be split over files and follow each other in no stated order. An empty table
    writes no file.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, min(-(-size // PARTITION_BYTES), TASKS_PER_PARTITION * default_partitions(docs.sparkSession)))
    named = text_batches(docs).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    ordered = named.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row")  # the row splits a key that many rows share
    schema = pa.schema([("seq", pa.int32()), ("file", pa.string()), ("ids", pa.int64()), ("documents", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        words = words_of(tokenizer)
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        lengths: list[int] = []
        total, seq = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal total, seq
            ids = np.concatenate(held)
            held.clear()
            store.create_dir(base, recursive=True)
            name = f"{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(pack(keys, lengths, ids))
            row = pa.RecordBatch.from_pydict({"seq": [seq], "file": [name], "ids": [total], "documents": [len(keys)]}, schema=schema)
            keys.clear(), lengths.clear()
            total, seq = 0, seq + 1
            return row

        for batch in _gathered(batches):
            known, done = batch.column(0).to_pylist(), 0
            for sizes, ids in words.encode(batch.column(1)):
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, np.uint32(end_id))
                ends = ends + np.arange(1, len(ends) + 1)
                first = 0
                while first < len(ends):
                    before = int(ends[first - 1]) if first else 0
                    last = min(len(ends), int(np.searchsorted(ends, before + FILE_IDS - total)) + 1)
                    keys += known[done + first : done + last]
                    lengths += (sizes[first:last] + 1).tolist()
                    held.append(ids[before : int(ends[last - 1])].astype(np.uint32))
                    total += int(ends[last - 1]) - before
                    first = last
                    if total >= FILE_IDS:
                        yield flush()
                done += len(sizes)
        if keys:
            yield flush()
        release()

    written = ordered.drop("row").mapInArrow(write, "seq int, file string, ids bigint, documents bigint")
    return stored(written.withColumn("part", F.spark_partition_id()), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """key, start, n_tokens and ids of every document, read back from the files."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.groupBy("part").agg(F.sum("ids").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))  # one row per written partition
    before = F.sum("ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("within", F.coalesce(before, F.lit(0))).join(offsets, "part")
    jobs = placed.select("file", (F.col("offset") + F.col("within")).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    keys, lengths, ids = unpack(f.read())
                sizes = np.array(lengths, dtype=np.int64)
                ends = np.cumsum(sizes)
                first = 0
                while first < len(keys):  # some 4 MB of ids at a time
                    at = int(ends[first] - sizes[first])
                    last = max(first + 1, int(np.searchsorted(ends, at + (1 << 20), "right")))
                    plain = ids[at : int(ends[last - 1])].astype("<u4", copy=False)
                    cuts = np.concatenate([[0], ends[first:last] - at]).astype(np.int32) * 4
                    column = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(plain.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[first:last], pa.int64()), pa.array(start + ends[first:last] - sizes[first:last]), pa.array(sizes[first:last]), column],
                        names=["key", "start", "n_tokens", "ids"],
                    )
                    first = last
        release()

    each = max(1, min(files.count(), TASKS_PER_PARTITION * default_partitions(spark)))
    return jobs.repartition(each, "file").mapInArrow(read, "key bigint, start bigint, n_tokens bigint, ids binary")
